"""Table operators: merges, upserts, selections per key, set differences, grids; all by keys, none collects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and the rows of new whose key is not in it."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new rows replace old ones with the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def reload_partition(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Delete every old row of the partitions that new brings, then add new."""
    return upsert(old, new.select(*old.columns), keys) if new.columns else old


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], when: Column | None = None) -> DataFrame:
    """Columns of target overwritten by source's non-null values for the same key."""
    s = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(s, keys, "left")
    value = lambda c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) if when is None else F.when(when, F.coalesce(F.col(f"_new_{c}"), F.col(c))).otherwise(F.col(c))
    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in target.columns])


def keep_human_columns(new: DataFrame, old: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A rewritten review queue carries over what people filled in."""
    o = old.select(*keys, *[F.nullif(F.trim(c), F.lit("")).alias(f"_old_{c}") for c in columns])
    return new.join(o, keys, "left").select(*[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in new.columns])


def pick_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by order, which must be total."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def most_frequent(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The commonest value per key, ties to the smallest: two partial aggregations, no window."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return n.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def outer_chain(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of several sources with disjoint value columns."""
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)


def symmetric_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    left = a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti").withColumn("side", F.lit("left"))
    right = b.select(*keys).distinct().join(a.select(*keys), keys, "left_anti").withColumn("side", F.lit("right"))
    return left.unionByName(right)


def season_offset_join(df: DataFrame, other: DataFrame, keys: list[str], season: str, offset: int, prefix: str = "prev_") -> DataFrame:
    """df with other's row of `offset` seasons earlier, columns prefixed."""
    moved = other.select(*keys, (F.col(season) + offset).alias(season), *[F.col(c).alias(prefix + c) for c in other.columns if c not in (*keys, season)])
    return df.join(moved, [*keys, season], "left")


def trailing(df: DataFrame, keys: list[str], season: str, value: str, first: int, last: int, total: str, count: str) -> DataFrame:
    """Sum and count of value over seasons s+first..s+last by value, on rows summed per key and season first.

    A window over season rows, of which a key has as many as seasons; hot keys are summed before the shuffle.
    """
    by = df.groupBy(*keys, season).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    w = Window.partitionBy(*keys).orderBy(season).rangeBetween(first, last)
    return by.select(*keys, season, F.sum("_s").over(w).alias(total), F.sum("_c").over(w).alias(count))


def expectation_grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every combination of two short lists, such as leagues and seasons; the right one is broadcast."""
    return left.crossJoin(F.broadcast(right))


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def islands(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of equal value in order: (keys, value, first, last, rows)."""
    w = Window.partitionBy(*keys).orderBy(order)
    run = df.withColumn("_new", (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")).withColumn("_run", F.sum("_new").over(w))
    return run.groupBy(*keys, "_run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("rows")).drop("_run")


def row_diff(df: DataFrame, key: str, a, b) -> DataFrame:
    """(column_name, left, right) of the columns in which two rows differ."""
    cols = [c for c in df.columns if c != key]
    long = lambda v, name: df.where(F.col(key) == v).select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column_name", name)
    return long(a, "left").join(long(b, "right"), "column_name").where(~F.col("left").eqNullSafe(F.col("right")))
