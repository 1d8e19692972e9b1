"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Sources weigh 5, 2, 1, repeating, in code-point order with null last, and share the total size. A source's target
stops at MAX_EPOCHS times its size and the excess goes to the others by weight until none is above: that level is
found in closed form from sums over sources ordered by size per weight. A source then takes every document
floor(target / size) times, and one more time the documents that come first in a seeded order until the rest of the
target is used up. The cut in that order is found by narrowing: sizes are summed per source and hash bucket (two
levels of FAN buckets), and only the documents of the crossing bucket are ordered, so no source, however large, is
gathered or sorted whole.

Defined cases: null text has size 0 and is taken 0 words; sources of size 0 have target 0; repeated rows count each
and are taken alike; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.base import WORD, materialize, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS, SEED, FAN = 3, 17, 256


def with_order(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds _size (words) and _h, the seeded 60-bit place of a document in its source's order."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.withColumn("_size", size).withColumn("_h", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target): one row per source throughout."""
    every = Window.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    s = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * epochs)
    by_ratio = every.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = (
        s.withColumn("_total", F.sum("source_size").over(every))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    )
    # a source stays below its cap when the level of those from it on does; from the first such source on, all do
    open_ = F.col("_cap").cast("decimal(38,0)") * F.col("_weights") >= F.col("_left").cast("decimal(38,0)") * F.col("_w")
    s = s.withColumn("_level", F.when(open_, F.col("_left").cast("double") / F.col("_weights").cast("double")))
    s = s.withColumn("_first", F.min(F.when(open_, F.struct(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"), F.col("_level").alias("level")))).over(every))
    target = F.when(open_, F.col("_w").cast("double") * F.col("_first.level")).otherwise(F.col("_cap").cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def _crossing(sums: DataFrame, rest: DataFrame, key: str) -> DataFrame:
    """Of each source the bucket in which the running size passes the rest, and the size before it."""
    run = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    joined = sums.join(rest.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("_before", F.col("_base") + F.coalesce(F.sum("_n").over(run), F.lit(0)))
    last = F.max_by(F.struct(key, "_before"), key)
    return joined.where(2 * F.col("_before") <= 2 * F.col("_rest")).groupBy("source").agg(last.alias("at"), F.first("_rest").alias("_rest")).select("source", F.col(f"at.{key}").alias(key), F.col("at._before").alias("_base"), "_rest")


def plan(ordered: DataFrame) -> DataFrame:
    """Per source: source_size, target, whole repetitions, and the last (hash, id, size) that is taken once more."""
    sizes = materialize(ordered.groupBy("source").agg(F.sum("_size").alias("source_size")), "sizes")
    goal = materialize(targets(sizes), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("_rest", F.col("target") - F.col("whole") * F.col("source_size"))
    rest = goal.where("_rest > 0").select("source", "_rest", F.lit(0).cast("long").alias("_base"))
    rows = ordered.where("_size > 0").select("source", "_h", "_size", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"))
    step = 1 << 60
    for level in (1, 2):
        step //= FAN
        key = f"_b{level}"
        rows = rows.withColumn(key, F.floor(F.col("_h") / F.lit(step)).cast("long"))
        sums = rows.groupBy("source", key).agg(F.sum("_size").alias("_n"))
        if level > 1:
            inside = rest.select(F.col("source").alias("_s"), F.col(f"_b{level - 1}").alias("_pb"))
            rows = rows.join(inside, F.col("source").eqNullSafe(F.col("_s")) & (F.col(f"_b{level - 1}") == F.col("_pb"))).drop("_s", "_pb")
            sums = rows.groupBy("source", key).agg(F.sum("_size").alias("_n"))
        rest = materialize(_crossing(sums, rest.select("source", "_rest", "_base"), key), f"cross{level}")
    inside = rest.select(F.col("source").alias("_s"), F.col("_b2").alias("_pb"), "_rest", "_base")
    near = rows.join(inside, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b2") == F.col("_pb")))
    same = near.groupBy("source", "_h", "_id", "_size").agg(F.sum("_size").alias("_n"), F.first("_rest").alias("_rest"), F.first("_base").alias("_base"))
    run = Window.partitionBy("source").orderBy("_h", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    same = same.withColumn("_to", F.col("_base") + F.sum("_n").over(run))
    cut = same.groupBy("source").agg(
        F.max(F.when(2 * F.col("_to") - F.col("_n") <= 2 * F.col("_rest"), F.struct("_h", "_id", "_size"))).alias("_cut"), F.min(F.struct("_h", F.lit(-(2**63)).alias("_id"), F.lit(-1).cast("long").alias("_size"))).alias("_low"))
    # with no document of the last bucket within the rest, all before that bucket are
    cut = cut.select(F.col("source").alias("_s"), F.coalesce("_cut", "_low").alias("cut"))
    return materialize(goal.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "source_size", "target", "whole", "cut"), "mix")


def with_copies(ordered: DataFrame, mix: DataFrame) -> DataFrame:
    """Adds source_size, target and copies (0 to MAX_EPOCHS) to each row; mix has one row per source."""
    m = mix.select(F.col("source").alias("_s"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "whole", "cut")
    key = F.struct(F.col("_h").alias("_h"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"), F.col("_size").alias("_size"))
    once_more = F.when(F.col("cut").isNotNull() & (key <= F.col("cut")), 1).otherwise(0)
    return ordered.join(m, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("_copies", (F.col("whole") + once_more).cast("int")).drop("_s", "whole", "cut")


def ordered_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, source, _size, _h) of docs, written once so that later passes read no text."""
    return materialize(with_order(docs.select("doc_id", "source", "text")).drop("text"), "order")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixture itself: each row of docs as often as it is taken, with docs' own columns."""
    mix = plan(ordered_rows(docs))
    own = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), "doc_id", "source", "text")
    taken = with_copies(with_order(inner), mix).where("_copies > 0")
    return taken.select("row", F.explode(F.expr("sequence(1, _copies)"))).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordered_rows(table(spark, sf_dir, "documents"))
    out = with_copies(rows, plan(rows))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\x0C\r]+'))::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([{', '.join(map(str, WEIGHTS))}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight, sum(source_size) OVER () AS total FROM s),
fill AS (
  SELECT source, source_size, weight, total, FALSE AS capped, 0 AS round FROM w
  UNION ALL
  SELECT source, source_size, weight, total,
    capped OR weight * (total - coalesce(sum({MAX_EPOCHS} * source_size) FILTER (capped) OVER (), 0)) > {MAX_EPOCHS} * source_size * (sum(weight) FILTER (NOT capped) OVER ()), round + 1
  FROM fill WHERE round < (SELECT count(*) FROM s) + 1),
g AS (SELECT source, source_size, CASE WHEN capped THEN ({MAX_EPOCHS} * source_size)::DOUBLE
    ELSE weight::DOUBLE * ((total - coalesce(sum({MAX_EPOCHS} * source_size) FILTER (capped) OVER (), 0))::DOUBLE / (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE) END AS target
  FROM fill WHERE round = (SELECT max(round) FROM fill)),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM g),
o AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, size) AS upto, sum(size) OVER (PARTITION BY d.source, h, d.doc_id, size) AS own
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN rest > 0 AND 2 * upto - own <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""
