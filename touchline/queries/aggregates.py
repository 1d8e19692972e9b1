"""Aggregations and windows on the analog tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.functions.core import unpivot
from touchline.operators import spend as S
from touchline.operators import tables as O
from touchline.plans.percentiles import rank_long
from touchline.queries.base import query, t


@query("a21_ranking", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 50")
def ranking(spark, sf):
    """Ranked sums, ties by key."""
    return t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high")).orderBy(F.desc("total"), "o_custkey").limit(50)


@query("a22_filter_aggregates", "SELECT l_returnflag, count(*) FILTER (l_discount > 0.05) AS many, round(sum(l_extendedprice) FILTER (l_linestatus = 'O'), 2) AS open_total FROM lineitem GROUP BY 1")
def filter_aggregates(spark, sf):
    """FILTER clauses."""
    return t(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_discount") > 0.05).alias("many"), F.round(F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))), 2).alias("open_total"))


@query("a23_median", "SELECT year(o_orderdate)::INTEGER AS season_id, round(median(o_totalprice), 6) AS median_fee, round(avg(o_totalprice), 6) AS mean_fee FROM orders GROUP BY 1")
def median(spark, sf):
    """The market index, exact median and mean per season."""
    m = S.market_index(t(spark, sf, "orders").select(F.year("o_orderdate").alias("season_id"), F.col("o_totalprice").alias("fee_amount")))
    return m.select("season_id", F.round("median_fee", 6).alias("median_fee"), F.round("mean_fee", 6).alias("mean_fee"))


@query("a24_share", "SELECT l_returnflag, round(100 * avg((l_linestatus = 'O')::INTEGER), 1) AS share FROM lineitem GROUP BY 1")
def flag_share(spark, sf):
    """The average of a flag."""
    return t(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(100 * F.avg((F.col("l_linestatus") == "O").cast("int")), 1).alias("share"))


@query("a25_rollup", "SELECT coalesce(year(o_orderdate)::VARCHAR, 'ALL') AS season, count(*) AS n, count(DISTINCT o_custkey) AS buyers FROM orders GROUP BY ROLLUP (year(o_orderdate))")
def rollup_all(spark, sf):
    """A rollup with an ALL row."""
    y = t(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    return y.rollup("y").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("buyers"), F.grouping("y").alias("g")).select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("y").cast("string")).alias("season"), "n", "buyers")


@query("a26_agreement", "SELECT round(avg(l_tax - l_discount), 6) AS mean_diff, round(avg(abs(l_tax - l_discount)), 6) AS abs_diff, round(corr(l_tax, l_discount), 6) AS r, count(*) FILTER (l_tax = l_discount) AS same FROM lineitem")
def agreement(spark, sf):
    """How two sources agree."""
    d = F.col("l_tax") - F.col("l_discount")
    return t(spark, sf, "lineitem").agg(F.round(F.avg(d), 6).alias("mean_diff"), F.round(F.avg(F.abs(d)), 6).alias("abs_diff"), F.round(F.corr("l_tax", "l_discount"), 6).alias("r"), F.count_if(F.col("l_tax") == F.col("l_discount")).alias("same"))


@query("a27_difference_histogram", "SELECT abs(round(l_tax * 100)::INTEGER - round(l_discount * 100)::INTEGER) AS diff, count(*) AS n FROM lineitem GROUP BY 1")
def histogram(spark, sf):
    """Groups by a computed difference."""
    return t(spark, sf, "lineitem").groupBy(F.abs(F.round(F.col("l_tax") * 100).cast("int") - F.round(F.col("l_discount") * 100).cast("int")).alias("diff")).agg(F.count("*").alias("n"))


@query("a28_collisions", "SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '|') AS found FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def collisions(spark, sf):
    """Keys with several values, in order."""
    from touchline.operators.identity import collisions as find

    return find(t(spark, sf, "orders"), "o_custkey", "o_orderpriority").select("o_custkey", F.array_join("found", "|").alias("found"))


@query("a29_having", "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def having(spark, sf):
    """Repeated keys."""
    return O.duplicated(t(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    "a46_profile",
    "WITH e AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b, quantile_cont(o_totalprice, 0.75) AS c FROM orders) SELECT CASE WHEN o_totalprice <= a THEN 1 WHEN o_totalprice <= b THEN 2 WHEN o_totalprice <= c THEN 3 ELSE 4 END AS quartile, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders, e GROUP BY 1",
)
def profile(spark, sf):
    """Counts and sums by quartile; exact edges."""
    from touchline.plans.signals import quantile_bins

    return quantile_bins(t(spark, sf, "orders"), "o_totalprice", 4, "quartile").groupBy("quartile").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a50_additive_merge", "SELECT l_orderkey, sum(l_quantity) AS quantity, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / nullif(sum(l_quantity), 0) AS price FROM lineitem GROUP BY 1")
def additive_merge(spark, sf):
    """Duplicates summed, rates recomputed."""
    return t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.nullif(F.sum("l_quantity"), F.lit(0.0))).alias("price"))


@query("a51_sales_by_class", "SELECT c_mktsegment, count(o_orderkey) AS n, round(avg(o_totalprice), 4) AS mean_fee, round(median(o_totalprice), 4) AS median_fee, round(100.0::DOUBLE * count(*) FILTER (n_regionkey = 1) / count(*), 1) AS region_share FROM customer LEFT JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def sales_by_class(spark, sf):
    """Left joins, mean, median, share."""
    c = t(spark, sf, "customer").join(t(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return c.groupBy("c_mktsegment").agg(F.count("o_orderkey").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_fee"), F.round(F.median("o_totalprice"), 4).alias("median_fee"), F.round(100.0 * F.count_if(F.col("n_regionkey") == 1) / F.count("*"), 1).alias("region_share"))


@query("a52_report", "SELECT count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS negative, count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS other, count(DISTINCT c_nationkey) AS nations FROM customer")
def report(spark, sf):
    """One aggregation for a whole report."""
    return t(spark, sf, "customer").agg(F.count("*").alias("rows"), F.count_if(F.col("c_acctbal") < 0).alias("negative"), F.count_if(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).alias("other"), F.count_distinct("c_nationkey").alias("nations"))


_RANK = """WITH x AS (SELECT p_partkey, p_type, p_size, p_retailprice, rank() OVER (PARTITION BY p_type ORDER BY p_size) AS r, count(*) OVER (PARTITION BY p_type, p_size) AS ties, count(*) OVER (PARTITION BY p_type) AS n FROM part)
SELECT p_partkey, p_type, round_even((r - 1 + ties / 2.0::DOUBLE) / n * 100, 1) AS pct FROM x WHERE n >= 30"""


@query("w03_percentile_rank", _RANK)
def percentile_rank(spark, sf):
    """Mean percentile rank with group guards."""
    return rank_long(t(spark, sf, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("value")), ["p_type"]).where("pct is not null").select("p_partkey", "p_type", "pct")


@query("w04_group_stats", "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) AS n, (min(p_size) OVER (PARTITION BY p_brand) = max(p_size) OVER (PARTITION BY p_brand)) AS constant FROM part")
def group_stats(spark, sf):
    """Group statistics on rows."""
    w = Window.partitionBy("p_brand")
    return t(spark, sf, "part").select("p_partkey", F.count("*").over(w).alias("n"), (F.min("p_size").over(w) == F.max("p_size").over(w)).alias("constant"))


@query("w12_islands", "WITH e AS (SELECT user_id, event_id, event_type, event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), r AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM e) SELECT user_id, event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS rows FROM r GROUP BY user_id, run, event_type")
def islands(spark, sf):
    """Runs of equal values."""
    return O.islands(t(spark, sf, "events"), ["user_id"], "event_id", "event_type")


@query("w13_continuity", "WITH m AS (SELECT DISTINCT n_regionkey AS league_code, c_custkey AS club_id, year(o_orderdate)::INTEGER AS season_id FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) SELECT a.league_code, a.season_id, count(b.club_id) AS retained, count(*) FILTER (b.club_id IS NULL) AS new FROM m a LEFT JOIN m b ON b.league_code = a.league_code AND b.club_id = a.club_id AND b.season_id = a.season_id - 1 GROUP BY 1, 2")
def continuity(spark, sf):
    """Members kept from the season before."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return S.continuity(o.select(F.col("n_regionkey").alias("league_code"), F.col("c_custkey").alias("club_id"), F.year("o_orderdate").alias("season_id")))


@query("w14_relabel", "SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand)::INTEGER AS label FROM part GROUP BY 1")
def relabel(spark, sf):
    """Ids by size; the window runs over one row a class."""
    n = t(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return n.select("p_brand", F.row_number().over(Window.orderBy(F.desc("n"), "p_brand")).alias("label"))


@query("a30_z_scores", "WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year(l_shipdate) AS y, l_extendedprice AS v FROM lineitem), s AS (SELECT y, avg(v) AS m, stddev_samp(v) AS sd FROM l GROUP BY 1) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((v - m) / sd, 6) AS z FROM l JOIN s USING (y) WHERE sd > 0 AND abs((v - m) / sd) > 1.7")
def z_scores(spark, sf):
    """Deviations from the season's mean."""
    from touchline.operators.audit import outliers

    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return outliers(t(spark, sf, "lineitem").withColumn("y", F.year("l_shipdate")), ids, "y", ["l_extendedprice"], 1.7).select(*ids, F.round("z", 6).alias("z"))


@query("k01_unpivot", "UNPIVOT (SELECT c_custkey, c_acctbal::DOUBLE AS acctbal, c_nationkey::DOUBLE AS nationkey FROM customer) ON acctbal, nationkey INTO NAME column_name VALUE value")
def unpivoted(spark, sf):
    """Wide to long in one scan."""
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nationkey"))
    return unpivot(c, ["c_custkey"], ["acctbal", "nationkey"])


_SALES = """WITH tr AS (SELECT l_orderkey * 10 + l_linenumber AS transfer_id, l_partkey AS player_id, l_suppkey AS own_club_id, l_suppkey % 7 AS counterparty_club_id, year(l_shipdate)::INTEGER AS season_id, l_extendedprice AS fee_amount, CASE l_returnflag WHEN 'A' THEN 'in' ELSE 'out' END AS direction, CASE l_linestatus WHEN 'F' THEN 'permanent_transfer' ELSE 'unpaid_loan' END AS fee_type FROM lineitem), """


def _transfers(spark, sf):
    l = t(spark, sf, "lineitem")  # noqa: E741
    return l.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transfer_id"), F.col("l_partkey").alias("player_id"), F.lit("p").alias("player_name"), F.col("l_suppkey").alias("own_club_id"), (F.col("l_suppkey") % 7).alias("counterparty_club_id"), F.lit("c").alias("counterparty_club_name"), F.year("l_shipdate").alias("season_id"), F.col("l_extendedprice").alias("fee_amount"), F.when(F.col("l_returnflag") == "A", "in").otherwise("out").alias("direction"), F.when(F.col("l_linestatus") == "F", "permanent_transfer").otherwise("unpaid_loan").alias("fee_type"))


@query(
    "v_transfer_spend_context",
    _SALES
    + """f AS (SELECT * FROM tr WHERE direction = 'in' AND fee_type IN ('permanent_transfer', 'paid_loan')), k AS (SELECT DISTINCT own_club_id, season_id FROM f),
  w AS (SELECT k.own_club_id, k.season_id, sum(f.fee_amount) AS s, count(*) AS n FROM k JOIN f ON f.own_club_id = k.own_club_id AND f.season_id BETWEEN k.season_id - 4 AND k.season_id GROUP BY 1, 2)
  SELECT transfer_id, f.player_id, f.own_club_id, f.season_id, round(s, 2) AS trailing, n AS trailing_n, CASE WHEN n >= 3 THEN round(100.0::DOUBLE * fee_amount / nullif(s, 0), 1) END AS share FROM f JOIN w ON w.own_club_id = f.own_club_id AND w.season_id = f.season_id""",
)
def spend_context(spark, sf):
    """The transfer-spend view."""
    return S.transfer_spend_context(_transfers(spark, sf)).select("transfer_id", "player_id", "own_club_id", "season_id", F.round("trailing_5yr_spend", 2).alias("trailing"), F.col("trailing_5yr_transfer_count").alias("trailing_n"), F.col("pct_of_5yr_club_spend").alias("share"))


@query(
    "v_buyer_spend_context",
    _SALES
    + """b AS (SELECT * FROM tr WHERE direction = 'in' AND fee_type = 'permanent_transfer'), s AS (SELECT transfer_id, player_id, own_club_id AS seller, counterparty_club_id AS buyer, season_id, fee_amount FROM tr WHERE direction = 'out' AND fee_type = 'permanent_transfer'),
  p AS (SELECT s.transfer_id, b.fee_amount AS page, row_number() OVER (PARTITION BY s.transfer_id ORDER BY (b.fee_amount = s.fee_amount) DESC, b.transfer_id) AS r FROM s JOIN b ON b.own_club_id = s.buyer AND b.player_id = s.player_id AND b.season_id = s.season_id AND b.counterparty_club_id = s.seller),
  k AS (SELECT DISTINCT own_club_id, season_id FROM b), w AS (SELECT k.own_club_id, k.season_id, sum(fee_amount) FILTER (b.season_id = k.season_id) AS one, coalesce(sum(fee_amount) FILTER (b.season_id < k.season_id), 0) AS prior FROM k JOIN b ON b.own_club_id = k.own_club_id AND b.season_id BETWEEN k.season_id - 5 AND k.season_id GROUP BY 1, 2)
  SELECT s.transfer_id, s.buyer, round(page, 2) AS page, round(one, 2) AS season_total, round(prior, 2) AS prior_total, (page IS NOT NULL AND one IS NOT NULL) AS available FROM s LEFT JOIN p ON p.transfer_id = s.transfer_id AND r = 1 LEFT JOIN w ON w.own_club_id = s.buyer AND w.season_id = s.season_id""",
)
def buyer_context(spark, sf):
    """The buyer-spend view (J10, J11, W07, T18); sums and windows recomputed another way in the oracle (Q12)."""
    tr = _transfers(spark, sf)
    out = S.buyer_spend_context(tr, tr)
    return out.select("transfer_id", F.col("buyer_club_id").alias("buyer"), F.round("buyer_page_fee", 2).alias("page"), F.round("season_paid_total", 2).alias("season_total"), F.round("prior_5yr_paid_total", 2).alias("prior_total"), F.col("buyer_context_available").alias("available"))


@query(
    "v_buyer_league_context",
    _SALES
    + """sp AS (SELECT transfer_id, counterparty_club_id AS buyer_club_id, season_id FROM tr WHERE direction = 'out' AND fee_type = 'permanent_transfer'), lg AS (SELECT DISTINCT s_suppkey AS club_id, y AS season_id, 'L' || (s_nationkey % 3)::VARCHAR AS code FROM supplier, unnest(range(1996, 2001)) AS g(y) WHERE s_suppkey % 2 = 0),
  hm AS (SELECT s_suppkey AS club_id FROM supplier WHERE s_suppkey % 3 = 0)
  SELECT transfer_id, coalesce(a.code, CASE WHEN h.club_id IS NOT NULL THEN 'NL1' END, 'OTHER') AS that_league, CASE WHEN sp.season_id - 1 >= 1996 THEN coalesce(b.code, CASE WHEN h.club_id IS NOT NULL THEN 'NL1' END, 'OTHER') END AS prev_league, a.code IS NOT NULL AS big5
  FROM sp LEFT JOIN lg a ON a.club_id = buyer_club_id AND a.season_id = sp.season_id LEFT JOIN lg b ON b.club_id = buyer_club_id AND b.season_id = sp.season_id - 1 LEFT JOIN hm h ON h.club_id = buyer_club_id""",
)
def league_context(spark, sf):
    """The buyer-league view."""
    sp = _transfers(spark, sf).where("direction = 'out' and fee_type = 'permanent_transfer'").select("transfer_id", F.col("counterparty_club_id").alias("buyer_club_id"), "season_id")
    s = t(spark, sf, "supplier")
    seasons = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b))).alias("season_id")
    lg = s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("club_id"), seasons(1996, 2000), F.concat(F.lit("L"), (F.col("s_nationkey") % 3).cast("string")).alias("league_code"))
    st = s.select(F.col("s_suppkey").alias("club_id"), seasons(1990, 2005), (F.col("s_suppkey") % 3 == 0).alias("was_home"))
    return S.buyer_league_context(sp, lg, st).select("transfer_id", F.col("buyer_league_that_season").alias("that_league"), F.col("buyer_league_prev_season").alias("prev_league"), F.col("buyer_in_big5_that_season").alias("big5"))
