"""Percentiles, archetypes, signals and schedules on the analog tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from touchline.operators import schedule as M
from touchline.plans import archetypes as A
from touchline.plans import percentiles as P
from touchline.plans import signals as S
from touchline.queries.base import query, t
from touchline.queries.sources import _folder


def _player_seasons(spark, sf):
    """Orders as player-seasons: counts and rates of the order's customer and year, a position by segment."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    by = o.groupBy(F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("season_id"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").cast("string").alias("team")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"), F.avg("o_totalprice").alias("m"))
    pos = F.when(F.col("seg") == "BUILDING", "DF").when(F.col("seg") == "MACHINERY", "MF,DF").otherwise("FW")
    base = by.select("player_id", "season_id", "team", pos.alias("fbref_position"), (F.col("n") * 5.0).alias("fbref_nineties"), (F.col("n") * 3 + F.floor(F.col("s")) % 7).cast("double").alias("fbref_shots"), *[F.lit(200).alias(c) for c in ("ws_passes", "ws_take_ons", "ws_aerials")])
    i = F.col("s")
    return base.join(by.select("player_id", "season_id", "s"), ["player_id", "season_id"]).select("*", *[F.round((i * (k + 3)) % 997, 2).alias(f) for k, f in enumerate(P.FEATURES) if f != "derived_shots_per90"]).drop("s")


@query("k01_build_percentiles")
def build_percentiles(spark, sf):
    """The whole percentile table; its rank formula is checked exactly by w03."""
    return P.build_percentiles(_player_seasons(spark, sf), strict=False)


@query("k05_split", "SELECT 'all' AS kind, count(*) AS n FROM embeddings WHERE len(embedding) = 64 UNION ALL SELECT 'none', count(*) FROM embeddings WHERE len(embedding) <> 64")
def split(spark, sf):
    """Complete and partial vectors."""
    e = t(spark, sf, "embeddings")
    full = F.forall("embedding", lambda x: x.isNotNull()) & (F.size("embedding") == 64)
    return e.agg(F.count_if(full).alias("a"), F.count_if(~full).alias("b")).select(F.explode(F.array(F.struct(F.lit("all").alias("kind"), F.col("a").alias("n")), F.struct(F.lit("none").alias("kind"), F.col("b").alias("n")))).alias("x")).select("x.*")


@query(
    "k11_nearest",
    """WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, 65)) AS i FROM embeddings), c AS (SELECT label, i, round(avg(x), 6) AS m FROM v GROUP BY 1, 2),
 d AS (SELECT v.vec_id, c.label, sqrt(sum((v.x - c.m) * (v.x - c.m))) AS d FROM v JOIN c ON c.i = v.i GROUP BY 1, 2) SELECT vec_id, (min_by(label, round(d, 7)))::INTEGER AS archetype_id, round(min(d), 3) AS distance FROM d GROUP BY 1""",
)
def nearest(spark, sf):
    """Nearest centroid over the features a row has."""
    e = t(spark, sf, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    c = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.round(F.avg("x"), 6).alias("m")).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p"))
    centres = c.select(F.col("label").alias("archetype_id"), F.transform("p", lambda s: s["m"]).alias("centre"))
    out = A.assign(e.select("vec_id", "v"), centres, np.ones(64), ["vec_id"])
    return out.select("vec_id", "archetype_id", F.round("distance", 3).alias("distance"))


@query(
    "k08_adjusted_rand",
    """WITH c AS (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL), s AS (SELECT sum(n * (n - 1) / 2.0::DOUBLE) AS cells, sum(n)::DOUBLE AS t FROM c), r AS (SELECT sum(n * (n - 1) / 2.0::DOUBLE) AS x FROM (SELECT sum(n) AS n FROM c GROUP BY quality)), k AS (SELECT sum(n * (n - 1) / 2.0::DOUBLE) AS y FROM (SELECT sum(n) AS n FROM c GROUP BY toxic))
 SELECT round((cells - x * y / (t * (t - 1) / 2)) / ((x + y) / 2 - x * y / (t * (t - 1) / 2)), 6) AS ari FROM s, r, k""",
)
def rand(spark, sf):
    """Adjusted Rand index from one contingency aggregate."""
    return A.adjusted_rand_frame(t(spark, sf, "labels"), "quality", "toxic").select(F.round("ari", 6).alias("ari"))


@query("k06_archetypes")
def archetypes(spark, sf):
    """Balanced weights, k-means, ids by size, partial rows assigned."""
    path = _folder(spark)
    P.build_percentiles(_player_seasons(spark, sf), strict=False).withColumn("season_id", F.col("season_id") + 20).write.parquet(path)
    return A.fit_archetypes(spark.read.parquet(path), 6, starts=3, scratch=_folder(spark))[0]


@query("k07_stability")
def stability(spark, sf):
    """Agreement by k over pairs of subsamples, one fit a task."""
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("player_id"), F.lit(2020).alias("season_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return A.stability(e)


@query("k12_ward")
def ward(spark, sf):
    """Ward linkage of all vectors, against k-means."""
    x = A.matrix(t(spark, sf, "embeddings").orderBy("vec_id"), "embedding")
    w, k = A.ward_labels(x, 5, spark), A.nearest(x, A.lloyd(x, 5, np.random.default_rng(0), 3)[0])
    return spark.createDataFrame([(5, float(A.adjusted_rand(w, k)), int(np.bincount(w).min()))], "k int, ari double, smallest int")


def _sales(spark, sf):
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return o.select(
        F.col("o_orderkey").alias("transfer_id"), F.col("o_custkey").alias("player_id"), (F.year("o_orderdate") + 20).alias("sale_season"), (F.col("o_totalprice") / 10000).alias("fee_amount"),
        (F.col("o_custkey") % 30 + 1985).alias("fbref_born"), F.col("c_nationkey").alias("seller_club_id"), F.col("c_acctbal").alias("balance"), F.log1p(F.abs("c_acctbal")).alias("log_balance"),
        (F.col("o_totalprice") / 10000 + F.col("c_acctbal") / 100).alias("style"), F.col("c_mktsegment").alias("buyer_league"),
    ).withColumn("log_fee", F.log1p("fee_amount"))


_ARMS = [S.Arm("controls", ("fbref_born", "balance"), ("buyer_league",)), S.Arm("style", ("fbref_born", "balance", "style"), ("buyer_league",))]


@query("k31_fee_signal")
def fee_signal(spark, sf):
    """Arms against the baseline by model and scheme, with bootstrap intervals."""
    out = S.compare(_sales(spark, sf), _ARMS, "controls", "log_fee", False)
    return spark.createDataFrame(out)


@query("k33_outgrew", "WITH o AS (SELECT o_orderkey AS transfer_id, year(o_orderdate)::INTEGER + 20 AS s, o_totalprice / 10000 AS f FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)), b AS (SELECT s, median(f) AS bar FROM o GROUP BY 1) SELECT transfer_id, (f >= bar)::INTEGER AS outgrew FROM o JOIN b USING (s)")
def outgrew(spark, sf):
    """Labels by the season's bar."""
    s = _sales(spark, sf)
    index = s.groupBy(F.col("sale_season").alias("season_id")).agg(F.median("fee_amount").alias("median_fee"), F.avg("fee_amount").alias("mean_fee"))
    return S.outgrew(s, index).select("transfer_id", "outgrew")


@query("k35_outgrew_signal")
def outgrew_signal(spark, sf):
    """The classifier's arms by log loss."""
    s = _sales(spark, sf)
    index = s.groupBy(F.col("sale_season").alias("season_id")).agg(F.median("fee_amount").alias("median_fee"))
    out = S.compare(S.outgrew(s, index), _ARMS[:1] + [S.Arm("style", ("fbref_born", "log_balance"), ())], "controls", "outgrew", True, seed=S.SEED_OUTGROW)
    return spark.createDataFrame(out)


@query(
    "k29_auc",
    "WITH r AS (SELECT quality AS y, doc_id % 97 AS s FROM labels), k AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r FROM r) SELECT round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc FROM k",
)
def auc(spark, sf):
    """Area under the curve by average ranks."""
    return S.auc_frame(t(spark, sf, "labels").select(F.col("quality").alias("y"), (F.col("doc_id") % 97).alias("s")), "y", "s").select(F.round("auc", 6).alias("auc"))


@query("k19_leakage", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS price, round(corr(l_quantity, l_tax), 6) AS tax FROM lineitem")
def leakage(spark, sf):
    """Correlations with the target in one aggregation."""
    return t(spark, sf, "lineitem").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("price"), F.round(F.corr("l_quantity", "l_tax"), 6).alias("tax"))


def _schedule(spark, sf):
    return t(spark, sf, "orders").select(F.year("o_orderdate").alias("season_id"), F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").alias("date"), (F.col("o_custkey") % 18).cast("string").alias("home_team"), (18 + F.col("o_custkey") % 17).cast("string").alias("away_team"), F.col("o_orderpriority").alias("stage"))


@query("w09_capped_assignment")
def capped(spark, sf):
    """Matches kept in date order while both clubs are below the cap."""
    return M.manifest(_schedule(spark, sf), 34)


@query("m05_off_stage", "WITH s AS (SELECT year(o_orderdate) AS y, o_orderkey, o_orderpriority AS p FROM orders), m AS (SELECT y, p, row_number() OVER (PARTITION BY y ORDER BY count(*) DESC, p) AS r FROM s GROUP BY 1, 2) SELECT o_orderkey AS game_id FROM s JOIN m ON m.y = s.y AND r = 1 WHERE s.p <> m.p")
def off_stage(spark, sf):
    """Matches off their season's modal stage."""
    return M.off_stage(M.stage_label(_schedule(spark, sf))).select("game_id")


@query("m06_diagnosis", "WITH s AS (SELECT year(o_orderdate)::INTEGER AS season_id, (o_custkey % 18)::VARCHAR AS h, (18 + o_custkey % 17)::VARCHAR AS w FROM orders) SELECT season_id, least(h, w) AS a, greatest(h, w) AS b, count(*) AS met FROM s GROUP BY ALL HAVING count(*) <> 2")
def diagnosis(spark, sf):
    """Pairs that met too often or too seldom."""
    return M.diagnose(_schedule(spark, sf))


@query("m04_duplicate_fixtures", "WITH s AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, o_custkey % 18 AS h, o_custkey % 17 AS w, o_orderkey AS game_id FROM orders) SELECT game_id, n, game_id % 2 = 0 AS has_file FROM (SELECT *, count(*) OVER (PARTITION BY y, p, h, w) AS n FROM s) WHERE n > 1")
def duplicate_fixtures(spark, sf):
    """Fixtures listed twice and which of them has a file."""
    files = t(spark, sf, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("game_id"))
    return M.duplicate_fixtures(_schedule(spark, sf), files).select("game_id", "n", "has_file")


@query("m09_stale", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def stale(spark, sf):
    """Rows that the latest run did not write, of play-off keys only."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rows = M.stale_rows(o, o.where("o_orderkey % 3 = 0"), ["o_orderkey", "o_custkey"])
    return rows.join(t(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey")
