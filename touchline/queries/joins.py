"""Joins, merges, set operations and top-k on the analog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import tables as O
from touchline.queries.base import query, t

_YEAR = "year(o_orderdate)"


@query("j01_outer_chain", "SELECT coalesce(a.k, b.k, c.k) AS k, orders, balance, suppliers FROM (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1) a FULL JOIN (SELECT c_custkey AS k, c_acctbal AS balance FROM customer) b ON a.k = b.k FULL JOIN (SELECT s_suppkey AS k, 1 AS suppliers FROM supplier) c ON coalesce(a.k, b.k) = c.k")
def outer_chain(spark, sf):
    """Full outer chain on shared keys."""
    a = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    b = t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"))
    return O.outer_chain([a, b, t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.lit(1).alias("suppliers"))], ["k"])


@query(
    "j07_wide",
    """SELECT o.o_orderkey, c.c_name AS cust_name, n.n_name AS nation, r.r_name AS region, l.lines AS line_count, round(l.total, 2) AS line_total
      FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND (o.o_orderstatus IS NULL OR o.o_orderstatus <> 'P') LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
      LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey""",
)
def wide(spark, sf):
    """A wide left-join view with conditions kept in the joins; dimensions broadcast by size."""
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("cust_name"), "c_nationkey")
    n = t(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("nation"), "n_regionkey")
    r = t(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("region"))
    lines = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("line_count"), F.round(F.sum("l_extendedprice"), 2).alias("line_total"))
    o = t(spark, sf, "orders")
    on = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") != "P"))
    out = o.join(c, on, "left").join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(r, F.col("r_regionkey") == F.col("n_regionkey"), "left").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return out.select("o_orderkey", "cust_name", "nation", "region", "line_count", "line_total")


@query(
    "j09_trailing",
    f"""WITH y AS (SELECT o_custkey, {_YEAR}::INTEGER AS season, o_totalprice AS fee FROM orders), k AS (SELECT DISTINCT o_custkey, season FROM y)
      SELECT k.o_custkey, k.season, round(sum(fee) FILTER (y.season >= k.season - 4), 2) AS trailing, count(fee) FILTER (y.season >= k.season - 4) AS trailing_n,
        round(coalesce(sum(fee) FILTER (y.season < k.season), 0), 2) AS prior5, count(fee) FILTER (y.season = k.season - 1) AS prior1_n
      FROM k JOIN y ON y.o_custkey = k.o_custkey AND y.season BETWEEN k.season - 5 AND k.season GROUP BY ALL""",
)
def trailing(spark, sf):
    """Value-based season windows over pre-summed seasons."""
    y = t(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("season"), F.col("o_totalprice").alias("fee"))
    w = lambda a, b, s, c: O.trailing(y, ["o_custkey"], "season", "fee", a, b, s, c)
    out = w(-4, 0, "trailing", "trailing_n").join(w(-5, -1, "prior5", "_p"), ["o_custkey", "season"]).join(w(-1, -1, "_s", "prior1_n"), ["o_custkey", "season"])
    return out.select("o_custkey", "season", F.round("trailing", 2).alias("trailing"), "trailing_n", F.round(F.coalesce("prior5", F.lit(0.0)), 2).alias("prior5"), F.coalesce("prior1_n", F.lit(0)).alias("prior1_n"))


@query(
    "w08_share",
    f"""WITH y AS (SELECT o_custkey, {_YEAR} AS s, sum(o_totalprice) AS t, count(*) AS n FROM orders GROUP BY 1, 2)
      SELECT o_orderkey, CASE WHEN y.n >= 3 THEN round(100.0::DOUBLE * o_totalprice / nullif(y.t, 0), 1) END AS share FROM orders o JOIN y ON y.o_custkey = o.o_custkey AND y.s = {_YEAR}""",
)
def share(spark, sf):
    """Shares with a floor on the number of fees."""
    o = t(spark, sf, "orders").withColumn("s", F.year("o_orderdate"))
    y = o.groupBy("o_custkey", "s").agg(F.sum("o_totalprice").alias("t"), F.count("*").alias("n"))
    return o.join(y, ["o_custkey", "s"]).select("o_orderkey", F.when(F.col("n") >= 3, F.round(100.0 * F.col("o_totalprice") / F.nullif(F.col("t"), F.lit(0.0)), 1)).alias("share"))


@query("j10_best_row", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def best_row(spark, sf):
    """The best row of each key under a total order."""
    return O.pick_best(t(spark, sf, "orders"), ["o_custkey"], [(F.col("o_orderstatus") == "F").desc(), F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "j12_season_offset",
    f"WITH y AS (SELECT o_custkey, {_YEAR}::INTEGER AS season, count(*) AS n FROM orders GROUP BY 1, 2) SELECT a.o_custkey, a.season, a.n, b.n AS prev_n FROM y a LEFT JOIN y b ON b.o_custkey = a.o_custkey AND b.season = a.season - 1",
)
def season_offset(spark, sf):
    """The row of the season before."""
    y = t(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(F.count("*").alias("n"))
    return O.season_offset_join(y, y, ["o_custkey"], "season", 1)


@query("j14_semi_anti", "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS has_open FROM customer WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)")
def semi_anti(spark, sf):
    """Semi, anti and flags."""
    c = t(spark, sf, "customer").join(t(spark, sf, "supplier"), F.col("s_suppkey") == F.col("c_custkey"), "left_anti")
    p = t(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("h", F.lit(True))
    return c.join(p, "c_custkey", "left").select("c_custkey", F.coalesce("h", F.lit(False)).alias("has_open"))


@query("j17_ordered_self", "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def ordered_self(spark, sf):
    """Ordered pairs within a key."""
    s = t(spark, sf, "supplier")
    a, b = s.select(F.col("s_suppkey").alias("a"), "s_nationkey"), s.select(F.col("s_suppkey").alias("b"), "s_nationkey")
    return a.join(b, "s_nationkey").where("a < b").select("a", "b")


@query("j18_grid", f"WITH g AS (SELECT n_nationkey, s AS season FROM nation, unnest(range(1995, 2002)) AS x(s)) SELECT g.n_nationkey, g.season::INTEGER AS season, count(o_orderkey) AS n FROM g LEFT JOIN (SELECT c_nationkey, {_YEAR} AS y, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey) o ON o.c_nationkey = g.n_nationkey AND o.y = g.season GROUP BY ALL")
def grid(spark, sf):
    """An expectation grid with what was found."""
    seasons = spark.range(1995, 2002).select(F.col("id").cast("int").alias("season"))
    g = O.expectation_grid(t(spark, sf, "nation").select("n_nationkey"), seasons)
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("season")).agg(F.count("*").alias("n"))
    return g.join(o, ["n_nationkey", "season"], "left").select("n_nationkey", "season", F.coalesce("n", F.lit(0)).alias("n"))


@query("j20_distinct_link", "SELECT o_custkey, c_name, count(*) AS n FROM orders JOIN (SELECT DISTINCT c_custkey, c_name FROM customer) ON c_custkey = o_custkey GROUP BY ALL")
def distinct_link(spark, sf):
    """A link table made distinct before it joins, and aggregation before the join."""
    n = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.join(t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name").distinct(), "o_custkey")


@query("j21_update_from", "SELECT c.c_custkey, c.c_name, coalesce(s.s_acctbal, c.c_acctbal) AS c_acctbal FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey")
def update_from(spark, sf):
    """Columns overwritten from another table."""
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return O.update_from(t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), s, ["c_custkey"], ["c_acctbal"])


@query("s14_insert_if_absent", "SELECT k, name FROM (SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier))")
def insert_if_absent(spark, sf):
    """ON CONFLICT DO NOTHING."""
    return O.insert_if_absent(t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), ["k"])


@query("s29_upsert", "SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT s_suppkey, s_name FROM supplier")
def upsert(spark, sf):
    """ON CONFLICT DO UPDATE, delete and reload."""
    return O.upsert(t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), ["k"])


@query("s37_review_queue", "SELECT n.n_nationkey, n.n_name, coalesce(CASE WHEN n.n_nationkey % 3 = 0 THEN 'match' END, '') AS decision FROM nation n")
def review_queue(spark, sf):
    """A rewritten queue keeps what people filled in."""
    new = t(spark, sf, "nation").select("n_nationkey", "n_name", F.lit("").alias("decision"))
    old = t(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, " match ").otherwise("  ").alias("decision"))
    return O.keep_human_columns(new, old, ["n_nationkey"], ["decision"])


@query("o03_top_k", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 25")
def top_k(spark, sf):
    """Top k under a total order, NULLs last."""
    return t(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey").limit(25)


@query("o05_union", "SELECT n_regionkey AS k, 'nation' AS kind FROM nation UNION SELECT r_regionkey, 'region' FROM region")
def union(spark, sf):
    """Set union."""
    return t(spark, sf, "nation").select(F.col("n_regionkey").alias("k"), F.lit("nation").alias("kind")).union(t(spark, sf, "region").select(F.col("r_regionkey"), F.lit("region"))).distinct()


@query("o07_symmetric_difference", "SELECT k, 'left' AS side FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000) UNION ALL SELECT k, 'right' FROM (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000 EXCEPT SELECT c_custkey FROM customer)")
def symmetric_difference(spark, sf):
    """Keys on one side only."""
    return O.symmetric_difference(t(spark, sf, "customer").select(F.col("c_custkey").alias("k")), t(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("k")), ["k"])


@query("j06_substring", "SELECT DISTINCT a.p_name AS short, b.p_type AS long FROM part a JOIN part b ON a.p_size = b.p_size AND lower(a.p_type) <> lower(b.p_type) AND contains(lower(b.p_type) || ' ' || b.p_name, a.p_name) AND a.p_brand = b.p_brand")
def substring_join(spark, sf):
    """Containment as a residual of an equi-join."""
    p = t(spark, sf, "part")
    a = p.select("p_size", "p_brand", F.col("p_name").alias("short"), F.col("p_type").alias("ta"))
    b = p.select("p_size", "p_brand", F.concat(F.lower("p_type"), F.lit(" "), "p_name").alias("full"), F.col("p_type").alias("long"))
    return a.join(b, ["p_size", "p_brand"]).where((F.lower("ta") != F.lower("long")) & F.contains("full", F.col("short"))).select("short", "long").distinct()


@query("j11_lateral_count", "SELECT p_partkey, n FROM (SELECT p_partkey, (SELECT count(DISTINCT b.p_type) FROM part b WHERE b.p_brand = a.p_brand) AS n FROM part a)")
def lateral_count(spark, sf):
    """A correlated aggregate as a grouped left join."""
    n = t(spark, sf, "part").groupBy("p_brand").agg(F.count_distinct("p_type").alias("n"))
    return t(spark, sf, "part").join(n, "p_brand", "left").select("p_partkey", "n")


@query("s13_column_map", "SELECT c_custkey AS id, c_name AS player, NULL::DOUBLE AS xg FROM customer")
def column_map(spark, sf):
    """Mapped columns, a missing source gives NULL."""
    from touchline.sources.files import column_mapped

    return column_mapped(t(spark, sf, "customer"), {"id": "c_custkey", "player": "c_name", "xg": "no_such_column"})


@query("s31_status_filter", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND year(o_orderdate) >= 1998")
def status_filter(spark, sf):
    """Rows from a season on whose keys the status set holds."""
    from touchline.sources.files import load_with_status

    o = t(spark, sf, "orders").withColumn("season_id", F.year("o_orderdate"))
    return load_with_status(o, t(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"], least=1998).select("o_orderkey")


@query("j23_moments", "WITH e AS (SELECT event_id, user_id % 2 AS team, date_trunc('hour', ts) AS h FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY h, team ORDER BY event_id) AS k FROM e) SELECT a.event_id AS event_a, b.event_id AS event_b FROM r a JOIN r b ON a.h = b.h AND a.k = b.k AND a.team < b.team")
def moments(spark, sf):
    """One-to-one pairs of two sides at one moment."""
    from touchline.operators.events import paired_at_moment

    e = t(spark, sf, "events").select("event_id", (F.col("user_id") % 2).alias("team_id"), F.date_trunc("hour", "ts").alias("game_id"), F.lit(0).alias("minute"), F.lit(0).alias("second"))
    return paired_at_moment(e).select("event_a", "event_b")


@query("q10_back_fill", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN coalesce(c.c_mktsegment, o_orderstatus) ELSE o_orderstatus END AS label FROM orders LEFT JOIN customer c ON c_custkey = o_custkey")
def back_fill(spark, sf):
    """Conditional overwrite by key."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("label"))
    return O.update_from(o, t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label")), ["o_custkey"], ["label"], F.col("o_orderkey") % 9 == 0).select("o_orderkey", "label")
