"""Audits on the analog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import audit as A
from touchline.queries.base import query, t

_VIEW = "(SELECT o_orderkey, year(o_orderdate)::INTEGER AS season, o_custkey % 18 AS team, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price, CASE WHEN year(o_orderdate) > 1996 THEN 7.0::DOUBLE END AS flat FROM orders)"


def _view(spark, sf):
    o = t(spark, sf, "orders")
    y = F.year("o_orderdate")
    return o.select("o_orderkey", y.alias("season"), (F.col("o_custkey") % 18).alias("team"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"), F.when(y > 1996, 7.0).alias("flat"))


_COLS = ["status", "price", "flat"]
_COVER = " UNION ALL ".join(f"SELECT {{g}}, '{c}' AS column_name, count(*) AS total, count({c}) AS non_null, round(100.0::DOUBLE * count({c}) / count(*), 1) AS pct FROM {_VIEW} GROUP BY {{k}}" for c in _COLS)


@query("a33_coverage_by_group", _COVER.format(g="season", k="season"))
def coverage_by_group(spark, sf):
    """Coverage of all columns per group, one scan."""
    return A.coverage(_view(spark, sf), ["season"], _COLS)


@query("a34_coverage", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS total, count({c}) AS non_null, round(100.0::DOUBLE * count({c}) / count(*), 1) AS pct FROM {_VIEW}" for c in _COLS))
def coverage(spark, sf):
    """Whole-table coverage."""
    return A.coverage(_view(spark, sf), [], _COLS)


@query("a35_cells", f"SELECT season, team, (count(status) + count(price) FILTER (team < 9))::BIGINT AS non_null_cells, (count(*) + count(*) FILTER (team < 9))::BIGINT AS total_cells, round(100.0::DOUBLE * (count(status) + count(price) FILTER (team < 9)) / (count(*) + count(*) FILTER (team < 9)), 1) AS pct FROM {_VIEW} GROUP BY 1, 2")
def cells(spark, sf):
    """Filled cells, a scoped column counted in its scope only."""
    return A.cell_coverage(_view(spark, sf), ["season", "team"], ["status", "price"], {"price": F.col("team") < 9})


@query("a38_density", f"WITH n AS (SELECT season, team, count(*) AS n FROM {_VIEW} WHERE NOT (team = 3 AND o_orderkey % 4 > 0) GROUP BY 1, 2) SELECT season, team, n, round(mean_n, 6) AS mean_n FROM (SELECT *, avg(n) OVER (PARTITION BY season) AS mean_n FROM n) WHERE n < 0.5 * mean_n")
def density(spark, sf):
    """Groups far below their season's mean size."""
    v = _view(spark, sf).where(~((F.col("team") == 3) & (F.col("o_orderkey") % 4 > 0)))
    return A.density(v, "season", "team").select("season", "team", "n", F.round("mean_n", 6).alias("mean_n"))


@query("a40_constants", f"SELECT season, 'flat' AS column_name, CASE WHEN count(flat) = 0 THEN 'empty' ELSE 'constant' END AS kind, CASE WHEN count(flat) > 0 THEN min(flat) END AS value FROM {_VIEW} GROUP BY 1")
def constants(spark, sf):
    """Empty, constant and sparse columns."""
    return A.constants(_view(spark, sf), "season", ["price", "flat"], 30)


@query("a41_findings", f"WITH f AS (SELECT season, CASE WHEN count(flat) = 0 THEN 'empty' ELSE 'constant' END AS kind FROM {_VIEW} GROUP BY 1) SELECT kind, array_to_string(list_sort(list(season)), ',') AS seasons, 'flat' AS columns FROM f GROUP BY kind")
def findings(spark, sf):
    """Columns with the same finding in the same seasons."""
    f = A.merge_findings(A.constants(_view(spark, sf), "season", ["price", "flat"], 30), "season")
    return f.select("kind", F.array_join(F.col("groups").cast("array<string>"), ",").alias("seasons"), F.array_join("columns", ",").alias("columns"))


@query("a44_best_worst", f"WITH n AS (SELECT season, avg((price IS NULL)::INTEGER) AS miss FROM {_VIEW} GROUP BY 1) SELECT round(avg(miss), 6) AS mean_missing, min_by(season, miss) AS best, max_by(season, miss) AS worst FROM n")
def best_worst(spark, sf):
    """The best and worst season of a column."""
    n = _view(spark, sf).groupBy("season").agg(F.avg(F.col("price").isNull().cast("int")).alias("miss"))
    return n.agg(F.round(F.avg("miss"), 6).alias("mean_missing"), F.min_by("season", "miss").alias("best"), F.max_by("season", "miss").alias("worst"))


@query("a39_ranges", "SELECT o_orderstatus, min(o_totalprice) AS low, max(o_totalprice) AS high, round(avg(o_totalprice), 4) AS mean, count(*) AS n FROM orders GROUP BY 1")
def ranges(spark, sf):
    """Ranges by kind."""
    return t(spark, sf, "orders").groupBy("o_orderstatus").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.round(F.avg("o_totalprice"), 4).alias("mean"), F.count("*").alias("n"))


_GAPS = "(SELECT n_name, CASE n_nationkey % 4 WHEN 0 THEN 'ws' WHEN 1 THEN 'fbref' WHEN 2 THEN 'tm' ELSE 'gk' END AS d, 2008 + o_orderkey % 12 AS s, (o_orderkey % 41) * 2.5::DOUBLE AS p, o_orderkey FROM orders JOIN nation ON n_nationkey = o_custkey % 25)"


def _gaps(spark, sf):
    o = t(spark, sf, "orders").join(t(spark, sf, "nation"), F.col("n_nationkey") == F.col("o_custkey") % 25)
    d = F.element_at(F.array(*[F.lit(x) for x in ("ws", "fbref", "tm", "gk")]), (F.col("n_nationkey") % 4 + 1).cast("int"))
    return o.select("o_orderkey", d.alias("d"), (2008 + F.col("o_orderkey") % 12).alias("s"), (F.col("o_orderkey") % 41 * 2.5).alias("p"))


@query(
    "q08_annotations",
    f"""SELECT o_orderkey, CASE WHEN d = 'ws' AND s < 2013 THEN 'explained' WHEN d = 'fbref' AND s BETWEEN 2010 AND 2017 AND p < 10 THEN 'likely_explained'
  WHEN d = 'ws' AND s >= 2013 AND p BETWEEN 20 AND 60 THEN 'likely_explained' WHEN p < 80 THEN 'unexplained' END AS tier FROM {_GAPS}""",
)
def annotations(spark, sf):
    """Q08: known gaps by season, the first tier that holds."""
    return _gaps(spark, sf).select("o_orderkey", A.gap_tier(F.col("d"), F.col("s"), F.col("p"))["tier"].alias("tier"))


@query("q09_blended", f"SELECT o_orderkey, CASE WHEN d IN ('ws', 'fbref') AND p < 80 THEN 'unexplained_blended' END AS tier FROM {_GAPS}")
def blended(spark, sf):
    """Q09: coverage over all seasons is only marked as low."""
    return _gaps(spark, sf).select("o_orderkey", A.blended_tier(F.col("d"), F.col("p")).alias("tier"))


_LINES = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, year(l_shipdate) AS y, l_extendedprice AS v, l_discount AS d, l_tax AS x FROM lineitem)"


def _far(spark, sf, **more):
    l = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("q"), F.year("l_shipdate").alias("y"), F.col("l_extendedprice").alias("v"), F.col("l_discount").alias("d"), F.col("l_tax").alias("x"))  # noqa: E741
    return A.outliers(l, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q"], "y", ["v", "d", "x"], 1.5, **more)


@query(
    "a31_floors",
    f"WITH s AS (SELECT y, avg(v) AS mv, stddev_samp(v) AS sv, avg(d) AS md, stddev_samp(d) AS sd FROM {_LINES} GROUP BY 1) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'v' AS column_name FROM {_LINES} JOIN s USING (y) WHERE q >= 5 AND abs((v - mv) / sv) > 1.5"
    f" UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'd' FROM {_LINES} JOIN s USING (y) WHERE q >= 5 AND l_linenumber >= 3 AND abs((d - md) / sd) > 1.5",
)
def floors(spark, sf):
    """Flags need the least sample and their column's own floor; a column without a usable spread has none."""
    return _far(spark, sf, least=("q", 5.0), floors={"d": ("l_linenumber", 3)}, excluded=("x",)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "column_name")


@query("a32_noise", f"WITH s AS (SELECT y, avg(v) AS mv, stddev_samp(v) AS sv FROM {_LINES} GROUP BY 1) SELECT 'v' AS column_name, count(*) FILTER (q < 45) AS excluded FROM {_LINES} JOIN s USING (y) WHERE abs((v - mv) / sv) > 1.5")
def noise(spark, sf):
    """How many far values the least sample keeps from being flagged."""
    l = t(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").alias("q"), F.year("l_shipdate").alias("y"), F.col("l_extendedprice").alias("v"))  # noqa: E741
    return A.excluded_noise(l, ["l_orderkey", "q"], "y", ["v"], ("q", 45.0), 1.5)


@query("q07_flags", "SELECT c_custkey, c_custkey % 10 = 0 AS reviewed, CASE WHEN c_custkey % 10 = 0 THEN 'known' END AS explanation FROM customer WHERE c_custkey % 10 = 0 OR c_acctbal < 0")
def flags(spark, sf):
    """Q07: reviewed flags stay, others are replaced."""
    c = t(spark, sf, "customer")
    old = c.where("c_custkey % 5 = 0").select("c_custkey", (F.col("c_custkey") % 10 == 0).alias("reviewed"), F.lit("known").alias("explanation"))
    return A.merge_flags(old, c.where("c_acctbal < 0").select("c_custkey"), ["c_custkey"])


_CHECKS = [
    A.where("price_positive", "error", "o_totalprice <= 0", table="orders"),
    A.where("priority_known", "warn", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')", table="orders"),
    A._having("one_status", "error", ["o_custkey"], lambda: [F.count_distinct("o_orderstatus").alias("n")], "n > 2", "orders"),
    A._missing("orders_have_customers", "orders", "customer", ["o_custkey"]),
    A.where("absent_table", "error", "x > 0", table="no_such_table"),
]


@query(
    "q02_check_engine",
    """SELECT * FROM (VALUES ('absent_table', 'SKIPPED', NULL::BIGINT)) v(name, status, violations)
 UNION ALL SELECT 'price_positive', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT count(*) AS n FROM orders WHERE o_totalprice <= 0)
 UNION ALL SELECT 'priority_known', CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END, n FROM (SELECT count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))
 UNION ALL SELECT 'one_status', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 2))
 UNION ALL SELECT 'orders_have_customers', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))""",
)
def check_engine(spark, sf):
    """Q01-Q06, Q18: checks run and graded."""
    found = A.run_checks(_CHECKS, {"orders": t(spark, sf, "orders"), "customer": t(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")})
    return spark.createDataFrame([(r["name"], r["status"], r["violations"]) for r in found], "name string, status string, violations long")


@query("q14_direction", "SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') THEN 'found' WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN 'flipped' ELSE 'not found' END AS direction FROM orders")
def direction(spark, sf):
    """Q14: found as expected, the other way round, or not at all; lines are summed per key before the join."""
    l = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max((F.col("l_returnflag") == "A").cast("int")).alias("a"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("r"))  # noqa: E741
    return t(spark, sf, "orders").join(l, "o_orderkey", "left").select("o_orderkey", F.when(F.col("a") == 1, "found").when(F.col("r") == 1, "flipped").otherwise("not found").alias("direction"))


@query("r09_row_diff", "SELECT column_name, l AS left, r AS right FROM (VALUES ('n_name', (SELECT n_name FROM nation WHERE n_nationkey = 1), (SELECT n_name FROM nation WHERE n_nationkey = 2)), ('n_regionkey', (SELECT n_regionkey::VARCHAR FROM nation WHERE n_nationkey = 1), (SELECT n_regionkey::VARCHAR FROM nation WHERE n_nationkey = 2))) v(column_name, l, r) WHERE l IS DISTINCT FROM r")
def row_diff(spark, sf):
    """Columns in which two rows differ."""
    from touchline.operators.tables import row_diff as diff

    return diff(t(spark, sf, "nation"), "n_nationkey", 1, 2)


@query("r14_first_rows", "SELECT y AS season, count(*) FILTER (o_orderstatus = 'F') AS usable, count(*) AS n FROM (SELECT year(o_orderdate)::INTEGER AS y, o_orderstatus, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r <= 10 GROUP BY 1")
def first_rows(spark, sf):
    """Coverage of each season's first ten."""
    from pyspark.sql import Window

    o = t(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))
    o = o.withColumn("r", F.row_number().over(Window.partitionBy("season").orderBy("o_orderdate", "o_orderkey"))).where("r <= 10")
    return o.groupBy("season").agg(F.count_if(F.col("o_orderstatus") == "F").alias("usable"), F.count("*").alias("n"))
