"""Entity resolution on the analog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import fuzzy as Z
from touchline.operators import identity as I
from touchline.queries.base import query, t

_GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w)::BIGINT + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
_PAIRS = f"""WITH p AS (SELECT DISTINCT p_brand, p_name FROM part), g AS (SELECT *, {_GRAMS.format(c="p_name")} AS g FROM p),
s AS (SELECT a.p_brand, a.p_name AS a, b.p_name AS b, len(list_intersect(a.g, b.g))::DOUBLE / len(list_distinct(list_concat(a.g, b.g))) AS similarity FROM g a JOIN g b ON a.p_brand = b.p_brand AND a.p_name < b.p_name)"""


def _pairs(spark, sf, threshold: float, inclusive: bool):
    p = t(spark, sf, "part").select("p_brand", "p_name").distinct()
    out = Z.blocked_pairs(p.withColumnRenamed("p_name", "a"), p.withColumnRenamed("p_name", "b"), ["p_brand"], "a", "b", threshold, inclusive)
    return out.where("a < b")


@query("f01_trigram_similarity", _PAIRS + " SELECT p_brand, a, b, round(similarity, 6) AS similarity FROM s WHERE similarity > 0.3")
def blocked(spark, sf):
    """Trigram Jaccard within blocks, strictly above the threshold."""
    return _pairs(spark, sf, 0.3, False).select("p_brand", "a", "b", F.round("similarity", 6).alias("similarity"))


@query("j04_similar_distinct", _PAIRS + " SELECT DISTINCT a, b FROM s WHERE similarity >= 0.5")
def blocked_distinct(spark, sf):
    """At or above the threshold, distinct."""
    return _pairs(spark, sf, 0.5, True).select("a", "b").distinct()


@query("f02_trigram_index", f"WITH n AS (SELECT DISTINCT p_name AS a, {_GRAMS.format(c='p_name')} AS g FROM part), m AS (SELECT DISTINCT p_type || ' ' || split_part(p_name, ' ', 2) AS b FROM part), h AS (SELECT b, {_GRAMS.format(c='b')} AS g FROM m) SELECT a, b, round(len(list_intersect(n.g, h.g))::DOUBLE / len(list_distinct(list_concat(n.g, h.g))), 6) AS similarity FROM n, h WHERE len(list_intersect(n.g, h.g))::DOUBLE / len(list_distinct(list_concat(n.g, h.g))) > 0.3")
def indexed(spark, sf):
    """an unblocked fuzzy join by an inverted index."""
    p = t(spark, sf, "part")
    other = p.select(F.concat("p_type", F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("b")).distinct()
    return Z.similar_pairs(p.select(F.col("p_name").alias("a")).distinct(), other, "a", "b", 0.3).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("f03_jaro_winkler", _PAIRS + " SELECT p_brand, a, b, round(jaro_winkler_similarity(a, b), 6) AS jw, CASE WHEN jaro_winkler_similarity(a, b) = 1 THEN 'exact' WHEN jaro_winkler_similarity(a, b) >= 0.8 THEN 'high' WHEN jaro_winkler_similarity(a, b) >= 0.5 THEN 'review' ELSE 'low' END AS band FROM s WHERE similarity > 0.3")
def jaro_winkler(spark, sf):
    """Jaro-Winkler and bands."""
    s = _pairs(spark, sf, 0.3, False).withColumn("jw", Z.jaro_winkler("a", "b"))
    return s.select("p_brand", "a", "b", F.round("jw", 6).alias("jw"), Z.band("jw").alias("band"))


@query("f04_token_sort")
def token_sort(spark, sf):
    """All scores of the candidate pairs (the longest common subsequence is beyond SQL)."""
    return I.score_pairs(_pairs(spark, sf, 0.3, False), "a", "b").select("p_brand", "a", "b", F.round("token_sort", 6).alias("token_sort"), F.round("working_confidence", 6).alias("working_confidence"), "band", "match_hint")


@query(
    "p38_hints",
    _PAIRS
    + """, k AS (SELECT *, string_split(a, ' ') AS x, string_split(b, ' ') AS y FROM s WHERE similarity > 0.3)
 SELECT p_brand, a, b, CASE WHEN a = b THEN 'exact_after_normalize' WHEN contains(b, a) OR contains(a, b) THEN 'substring_match' WHEN len(x) >= 2 AND len(y) >= 2 AND x[1] = y[1] AND x[-1] = y[-1] THEN 'given_and_surname_match_extra_middle_token'
  WHEN x[-1] = y[-1] THEN 'same_surname_diff_given_name' WHEN x[1] = y[1] THEN 'same_given_name_diff_surname' WHEN list_sort(list_distinct(x)) = list_sort(list_distinct(y)) THEN 'same_tokens_reordered' ELSE 'other' END AS hint FROM k""",
)
def hints(spark, sf):
    """Seven hints, the first that holds."""
    return _pairs(spark, sf, 0.3, False).select("p_brand", "a", "b", Z.pair_hint("a", "b").alias("hint"))


@query("f08_reviewed", "SELECT n_name AS a, n_regionkey::VARCHAR AS b, CASE WHEN n_nationkey % 2 = 0 THEN 'ok' END AS notes, TRUE AS verified FROM nation WHERE n_nationkey % 3 = 0")
def reviewed(spark, sf):
    """decided matches."""
    q = t(spark, sf, "nation").select(F.col("n_name").alias("a"), F.col("n_regionkey").cast("string").alias("b"), F.when(F.col("n_nationkey") % 3 == 0, " Match ").otherwise("no").alias("decision"), F.when(F.col("n_nationkey") % 2 == 0, " ok ").otherwise("  ").alias("notes"))
    return I.reviewed_matches(q, "a", "b").select("a", "b", "notes", "verified")


@query("f10_contradictions", "WITH m AS (SELECT floor(c_acctbal / 10)::BIGINT AS a, c_custkey AS b FROM customer) SELECT a, b FROM m WHERE a NOT IN (SELECT a FROM m GROUP BY a HAVING count(DISTINCT b) > 1)")
def contradictions(spark, sf):
    """names with several partners are skipped."""
    m = t(spark, sf, "customer").select(F.floor(F.col("c_acctbal") / 10).alias("a"), F.col("c_custkey").alias("b"))
    return I.without_contradictions(m, "a", "b", both=False)


@query("f10_two_way", "WITH m AS (SELECT c_custkey AS a, floor(c_acctbal / 10)::BIGINT AS b FROM customer) SELECT a, b FROM m WHERE a NOT IN (SELECT a FROM m GROUP BY a HAVING count(DISTINCT b) > 1) AND b NOT IN (SELECT b FROM m GROUP BY b HAVING count(DISTINCT a) > 1)")
def two_way(spark, sf):
    """contradictions on either side are skipped."""
    m = t(spark, sf, "customer").select(F.col("c_custkey").alias("a"), F.floor(F.col("c_acctbal") / 10).alias("b"))
    return I.without_contradictions(m, "a", "b")


@query("f11_identity_upsert", "SELECT c_custkey AS player_id, c_name AS canonical_name FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT (SELECT max(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING') + row_number() OVER (ORDER BY c_name), c_name FROM customer WHERE c_mktsegment <> 'BUILDING'")
def identity_upsert(spark, sf):
    """Reuse ids by name, make new ones after the largest."""
    c = t(spark, sf, "customer")
    players = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("canonical_name"))
    cw = players.select("player_id", F.lit("x").alias("source"), F.col("canonical_name").alias("source_name"))
    m = c.select(F.col("c_name").alias("a"), F.lower("c_name").alias("b"))
    return I.identity_upsert(players, cw, m, "a", "b", ("x", "y"))[0]


@query("f14_gaps", "SELECT DISTINCT p_type AS source_name FROM part WHERE p_type NOT IN (SELECT upper(p_type) FROM part WHERE p_size < 0 UNION SELECT 'PROMO')")
def gaps(spark, sf):
    """Names without an alias."""
    alias = spark.createDataFrame([("PROMO",)], "source_name string")
    return t(spark, sf, "part").select(F.col("p_type").alias("source_name")).distinct().join(alias, "source_name", "left_anti")


@query("f15_history", "SELECT DISTINCT c_custkey AS player_id, n_nationkey AS club_id, year(o_orderdate)::INTEGER AS season_id FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 4 <> 0 OR year(o_orderdate) = 1997")
def history(spark, sf):
    """(player, club, season) through crosswalk and aliases, guarded by a known birth year."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    stats = o.select(F.col("c_name").alias("player_name"), F.col("n_name").alias("team"), F.year("o_orderdate").alias("season_id"), F.year("o_orderdate").alias("born"))
    cw = t(spark, sf, "customer").select(F.col("c_custkey").alias("player_id"), F.lit("x").alias("source"), F.col("c_name").alias("source_name"))
    al = t(spark, sf, "nation").select(F.col("n_nationkey").alias("club_id"), F.lit("x").alias("source"), F.col("n_name").alias("source_name"))
    pl = t(spark, sf, "customer").select(F.col("c_custkey").alias("player_id"), F.when(F.col("c_custkey") % 4 == 0, 1997).alias("canonical_born"))
    return I.history([("x", stats)], cw, al, pl)


@query("j05_loose_aliases", "WITH a AS (SELECT DISTINCT p_name AS s, lower(p_name) AS x FROM part), b AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS c, lower(split_part(p_name, ' ', 2)) AS y FROM part) SELECT s AS source_name, c AS club_name FROM a, b WHERE contains(x, y) OR contains(y, x)")
def loose_aliases(spark, sf):
    """Equality or containment after loosening, keyed by words instead of a nested loop."""
    p = t(spark, sf, "part")
    clubs = p.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("club_name")).distinct().withColumn("club_id", F.col("club_name"))
    return I.loose_alias_pairs(p.select(F.col("p_name").alias("source_name")), clubs).select("source_name", "club_name")
