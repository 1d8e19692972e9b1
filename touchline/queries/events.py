"""Event statistics and scalar operators on the analog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import core as C
from touchline.operators import tables as O
from touchline.queries.base import query, t

_PCT = "CASE WHEN {b} > 0 THEN round_even(100.0::DOUBLE * {a} / {b}, 1) END"


@query(
    "a02_event_stats",
    f"""SELECT user_id, count(*) AS n, count(value) AS touches, count(*) FILTER (event_type = 'purchase') AS purchases,
      count(*) FILTER (event_type IN ('click', 'view')) AS views, count(*) FILTER (value <= 33.3) AS low, count(*) FILTER (value > 33.3 AND value <= 66.6) AS mid,
      count(*) FILTER (NOT coalesce(value <= 66.6, FALSE)) AS high, {_PCT.format(a="count(*) FILTER (event_type = 'purchase')", b="count(*) FILTER (event_type IN ('click', 'view'))")} AS purchase_pct
      FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
)
def event_stats(spark, sf):
    """One scan, conditional counts, NULL-safe percentages."""
    e = C.drop_null_keys(t(spark, sf, "events"), ["user_id"])
    n = lambda p: F.count_if(F.coalesce(p, F.lit(False)))
    agg = e.groupBy("user_id").agg(
        F.count("*").alias("n"), F.count("value").alias("touches"), n(F.col("event_type") == "purchase").alias("purchases"), n(F.col("event_type").isin("click", "view")).alias("views"),
        n(C.third("value") == "def").alias("low"), n(C.third("value") == "mid").alias("mid"), n(C.third("value") == "att").alias("high"),
    )
    return agg.withColumn("purchase_pct", C.pct("purchases", "views"))


@query(
    "a14_rollup",
    f"""WITH d AS (SELECT user_id, event_type, ts::DATE AS day, count(*) AS n, count(*) FILTER (value > 50) AS big FROM events GROUP BY ALL),
      s AS (SELECT user_id, sum(n)::BIGINT AS n, sum(big)::BIGINT AS big, count(DISTINCT day) AS days FROM d GROUP BY user_id),
      f AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM d GROUP BY user_id, event_type)
      SELECT s.user_id, n, big, days, event_type AS commonest, {_PCT.format(a="big", b="n")} AS big_pct FROM s JOIN f ON s.user_id = f.user_id AND r = 1""",
)
def rollup(spark, sf):
    """Per user and day, then per user; percentages recomputed from sums; the commonest label."""
    d = t(spark, sf, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("value") > 50, F.lit(False))).alias("big"))
    s = d.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("big").alias("big"), F.count_distinct("day").alias("days"))
    top = O.most_frequent(d, ["user_id"], "event_type").withColumnRenamed("event_type", "commonest")
    return s.join(top, "user_id").withColumn("big_pct", C.pct("big", "n"))


@query("s03_json_props", "SELECT event_id, (props->>'$.k')::BIGINT AS k, (props->>'$.k')::BIGINT >= 50 AS has_high FROM events")
def json_props(spark, sf):
    """Nested feed fields by a declared schema, existence over an array."""
    p = F.from_json("props", "k long")
    return t(spark, sf, "events").select("event_id", p["k"].alias("k"), F.exists(F.array(p["k"]), lambda x: x >= 50).alias("has_high"))


@query("p01_filters", "SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, (o_orderstatus = 'F' AND o_totalprice > 200000) AS big_done FROM orders WHERE o_orderstatus IN ('F', 'O')")
def filters(spark, sf):
    """IN-list filters and compound booleans."""
    return t(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"), ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)).alias("big_done"))


@query(
    "p03_zones",
    """SELECT event_id, CASE WHEN value <= 33.3 THEN 'def' WHEN value <= 66.6 THEN 'mid' ELSE 'att' END AS third, coalesce(value <= 17.0 AND (event_id % 100) BETWEEN 21.1 AND 78.9, FALSE) AS own_box,
      coalesce(value >= 83.0 AND (event_id % 100) BETWEEN 21.1 AND 78.9, FALSE) AS far_box, coalesce(value > 66.6, FALSE) AS final_third FROM events""",
)
def zones(spark, sf):
    """Pitch thirds and box predicates, NULL to false."""
    y = (F.col("event_id") % 100).cast("double")
    return t(spark, sf, "events").select("event_id", C.third("value").alias("third"), C.in_box("value", y, False).alias("own_box"), C.in_box("value", y, True).alias("far_box"), C.enters_final_third("value").alias("final_third"))


@query("s05_codes", "SELECT o_orderkey, (substr(s, 3, 2) || substr(s, 6, 2)) AS code, split_part(s, '-', 1)::INTEGER AS start FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y') || '-' || strftime(o_orderdate, '%m') AS s FROM orders)")
def codes(spark, sf):
    """Season codes and start years."""
    s = t(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("s"))
    return s.select("o_orderkey", C.season_code("s").alias("code"), C.season_start("s").alias("start"))


_FEES = ["€15.00m", "€500k", "free transfer", "loan transfer", "End of loan", "?", "-", "", "Loan fee €2.50m", "Loan fee", "€abc", "swap deal"]
_FEE_SQL = " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_FEES))


@query(
    "p12_fee_parser",
    f"""WITH r AS (SELECT p_partkey, CASE p_partkey % {len(_FEES)} {_FEE_SQL} END AS raw FROM part),
      m AS (SELECT *, trim(raw) AS s, trim(replace(trim(replace(trim(raw), 'Loan fee', '')), '€', '')) AS bare FROM r),
      v AS (SELECT *, CASE WHEN bare LIKE '%m' THEN try_cast(left(bare, length(bare) - 1) AS DOUBLE) WHEN bare LIKE '%k' THEN try_cast(left(bare, length(bare) - 1) AS DOUBLE) / 1000 END AS mv FROM m)
      SELECT p_partkey, CASE WHEN raw IS NULL OR raw = '' OR s IN ('-', '?') OR lower(s) IN ('end of loan', 'loan transfer') THEN NULL WHEN lower(s) = 'free transfer' THEN 0.0 ELSE mv END::DOUBLE AS fee_amount,
        CASE WHEN raw IS NULL OR raw = '' THEN 'empty_cell' WHEN s = '-' THEN 'unknown' WHEN s = '?' THEN 'unknown_historical' WHEN lower(s) = 'end of loan' THEN 'loan_ended' WHEN lower(s) = 'free transfer' THEN 'free_transfer'
          WHEN lower(s) = 'loan transfer' THEN 'unpaid_loan' WHEN lower(s) LIKE 'loan fee%' AND mv IS NOT NULL THEN 'paid_loan' WHEN lower(s) LIKE 'loan fee%' THEN 'paid_loan_undisclosed'
          WHEN mv IS NOT NULL THEN 'permanent_transfer' ELSE 'unrecognized: ' || s END AS fee_type FROM v""",
)
def fee_parser(spark, sf):
    """Fee cells to amount and kind, without a UDF."""
    raw = F.element_at(F.array(*[F.lit(f) for f in _FEES]), (F.col("p_partkey") % len(_FEES) + 1).cast("int"))
    return t(spark, sf, "part").select("p_partkey", C.fee(raw).alias("f")).select("p_partkey", F.col("f.amount").alias("fee_amount"), F.col("f.type").alias("fee_type"))


@query(
    "p13_club_flags",
    r"""WITH c AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Alpha U21' WHEN 1 THEN 'Beta B' WHEN 2 THEN 'Jong Gamma' WHEN 3 THEN 'FC Delta-Stad' WHEN 4 THEN 'Epsilon II' ELSE 'SC  Zeta fc' END AS club FROM customer)
      SELECT c_custkey, regexp_matches(club, '\b(U1[6-9]|U2[0-3])\b') AS promotion, regexp_matches(club, '\b(U1[6-9]|U2[0-3])\b|\s(B|II)$|^Jong\s') AS reserve,
        trim(regexp_replace(regexp_replace(replace(lower(club), '-', ' '), '\s+', ' ', 'g'), '\b(fc|sc|vv)\b', '', 'g')) AS loose FROM c""",
)
def club_flags(spark, sf):
    """Youth, reserve and loosened club names."""
    names = F.array(*[F.lit(x) for x in ("Alpha U21", "Beta B", "Jong Gamma", "FC Delta-Stad", "Epsilon II", "SC  Zeta fc")])
    c = t(spark, sf, "customer").select("c_custkey", F.element_at(names, (F.col("c_custkey") % 6 + 1).cast("int")).alias("club"))
    return c.select("c_custkey", C.internal_promotion("club").alias("promotion"), C.reserve_side("club").alias("reserve"), C.loose_club("club").alias("loose"))


@query("p15_cascade", "SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'home' WHEN c_acctbal < 1000 THEN 'small' WHEN c_mktsegment = 'BUILDING' THEN 'segment' ELSE 'keep' END AS reason FROM customer")
def cascade(spark, sf):
    """The first rule that holds names the reason."""
    return t(spark, sf, "customer").select("c_custkey", C.first_match([(F.col("c_nationkey") == 3, "home"), (F.col("c_acctbal") < 1000, "small"), (F.col("c_mktsegment") == "BUILDING", "segment")], "keep").alias("reason"))


@query("p16_href_ids", r"SELECT page_id, nullif(regexp_extract(url, '/(?:en|de|fr|es)/([0-9]+)', 1), '')::BIGINT AS doc, nullif(regexp_extract(url, '/en/([0-9]+)', 1), '')::BIGINT AS en_doc FROM pages")
def href_ids(spark, sf):
    """Numbers out of links."""
    return t(spark, sf, "pages").select("page_id", C.href_id("url", "(?:en|de|fr|es)").alias("doc"), C.href_id("url", "en").alias("en_doc"))


@query("p17_names", "SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '\\s+', ' ', 'g')) AS name FROM documents")
def names(spark, sf):
    """Accents folded by one translate, blanks collapsed, in whole texts."""
    return t(spark, sf, "documents").select("doc_id", C.plain_name("text").alias("name"))


@query(
    "p20_positions",
    "SELECT p_partkey, nullif(upper(trim(split_part(s, ',', 1))), '') AS pos FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'fw,mf' WHEN 1 THEN ' df ' WHEN 2 THEN '' ELSE 'GK,DF' END AS s FROM part)",
)
def positions(spark, sf):
    """P20: the first position."""
    s = F.element_at(F.array(F.lit("fw,mf"), F.lit(" df "), F.lit(""), F.lit("GK,DF")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t(spark, sf, "part").select("p_partkey", C.primary_position(s).alias("pos"))


@query(
    "p21_rates",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif((l_quantity - 1) * 0.9973::DOUBLE, 0), 2) AS per_unit, CASE WHEN l_quantity >= 10 THEN l_discount END AS guarded, CASE WHEN l_tax BETWEEN 0.02 AND 0.06 THEN l_tax END AS tax_ok FROM lineitem""",
)
def rates(spark, sf):
    """Per-unit rates, attempt guards, range guards."""
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", C.per90("l_extendedprice", (F.col("l_quantity") - 1) * 0.9973).alias("per_unit"), C.guarded("l_discount", "l_quantity", 10).alias("guarded"), C.within("l_tax", 0.02, 0.06).alias("tax_ok"))


@query("p31_text_predicates", "SELECT p_partkey, p_name ILIKE '%RED%' AS red, regexp_matches(p_brand, '^Brand#[0-9]$') AS short_brand, (p_type IS DISTINCT FROM 'PROMO') AS not_promo, greatest(2, 0.02 * p_size)::DOUBLE AS tolerance FROM part")
def text_predicates(spark, sf):
    """ILIKE, regex match, null-safe inequality, tolerance."""
    return t(spark, sf, "part").select("p_partkey", F.col("p_name").ilike("%RED%").alias("red"), F.col("p_brand").rlike("^Brand#[0-9]$").alias("short_brand"), (~F.col("p_type").eqNullSafe("PROMO")).alias("not_promo"), F.greatest(F.lit(2.0), 0.02 * F.col("p_size")).alias("tolerance"))


@query("p28_features", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price, (o_custkey IN (1, 2, 3))::DOUBLE AS big3, coalesce(nullif(o_orderpriority, '5-LOW'), 'UNKNOWN') AS priority FROM orders")
def features(spark, sf):
    """Logs, flags and UNKNOWN categories."""
    return t(spark, sf, "orders").select("o_orderkey", F.round(F.log1p("o_totalprice"), 6).alias("log_price"), F.col("o_custkey").isin(1, 2, 3).cast("double").alias("big3"), F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("UNKNOWN")).alias("priority"))


@query("p10_numeric_names", "SELECT c_custkey, try_cast(n AS DOUBLE) IS NOT NULL AS numeric_name, coalesce('id:' || k::VARCHAR, 'name:' || n) AS identity FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR || '.5' ELSE c_name END AS n, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS k FROM customer)")
def numeric_names(spark, sf):
    """Names that read as numbers; identity with fallback."""
    c = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.col("c_custkey").cast("string"), F.lit(".5"))).otherwise(F.col("c_name")).alias("n"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("k"))
    return c.select("c_custkey", C.numeric_name("n").alias("numeric_name"), C.identity_key("k", "n").alias("identity"))


@query("p39_rounding", "SELECT p_partkey, round(p_size / 4.0::DOUBLE, 1) AS half_up, round_even(p_size / 4.0::DOUBLE, 1) AS half_even FROM part")
def rounding(spark, sf):
    """Half away from zero and half to even."""
    q = F.col("p_size") / 4.0
    return t(spark, sf, "part").select("p_partkey", F.round(q, 1).alias("half_up"), F.bround(q, 1).alias("half_even"))


@query("s27_heights", "SELECT c_custkey, round(replace(nullif(regexp_extract(h, '([0-9]+[,.][0-9]+)\\s*m', 1), ''), ',', '.')::DOUBLE * 100)::INTEGER AS cm FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE '1,' || (60 + c_custkey % 40)::VARCHAR || ' m' END AS h FROM customer)")
def heights(spark, sf):
    """Heights out of text."""
    h = F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.concat(F.lit("1,"), (60 + F.col("c_custkey") % 40).cast("string"), F.lit(" m")))
    return t(spark, sf, "customer").select("c_custkey", C.height_cm(h).alias("cm"))


@query("p08_cooccurrence", "WITH e AS (SELECT DISTINCT user_id, event_type FROM events) SELECT x.event_type AS a, y.event_type AS b, count(*) AS n FROM e x JOIN e y ON x.user_id = y.user_id AND x.event_type < y.event_type GROUP BY ALL")
def cooccurrence(spark, sf):
    """Pairs of tags on one key, from its sorted distinct tags."""
    e = t(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("t"))
    one = e.select("t", F.explode("t").alias("a"))
    return one.select("a", F.explode("t").alias("b")).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


@query("a19_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    """Counts with NULL as a value."""
    return t(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("p09_lookup", "SELECT n_nationkey, CASE n_name WHEN 'NATION_1' THEN 'First' WHEN 'NATION_2' THEN 'Second' ELSE n_name END AS name FROM nation")
def lookup(spark, sf):
    """Rename by a broadcast map, identity otherwise."""
    m = spark.createDataFrame([("NATION_1", "First"), ("NATION_2", "Second")], "n_name string, new string")
    return t(spark, sf, "nation").join(F.broadcast(m), "n_name", "left").select("n_nationkey", F.coalesce("new", "n_name").alias("name"))
