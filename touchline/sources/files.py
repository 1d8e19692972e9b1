"""File sources and sinks: event feeds, per-match documents, manifests, CSV, resume-safe and per-partition writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.core import numeric_name


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Declared schema, malformed rows kept in _corrupt_record, the file's name in file_name."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(full).option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("file_name", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1))


def key_from_file(pattern: str, column: str = "file_name"):
    """A number in a file's name, such as 123_transfers.json or GB1_2019.json."""
    return F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")).cast("long")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_columns(spark: SparkSession, path: str, columns: list[str], numeric: list[str] = ()) -> DataFrame:
    """Only the needed columns reach the scan; numbers that don't parse become NULL."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in columns])


def column_mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """target: source columns; a source that is missing gives NULL."""
    return df.select(*[(F.col(s) if s in df.columns else F.lit(None).cast("double")).alias(t) for t, s in mapping.items()])


def flatten_names(df: DataFrame) -> DataFrame:
    """a.b struct columns become a_b."""
    out = []
    for f in df.schema.fields:
        out += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}" if g.name else f.name) for g in f.dataType.fields] if isinstance(f.dataType, T.StructType) else [F.col(f.name)]
    return df.select(*out)


def pending(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return ids.select(key).distinct().join(done.select(key), key, "left_anti")


def append_new(df: DataFrame, path: str, key: str, partition: str, spark: SparkSession) -> int:
    """Resume-safe sink: writes only keys that path does not hold yet; returns how many rows."""
    try:
        old = spark.read.parquet(path).select(key)
        df = df.join(old, key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    n = df.count()
    if n:
        df.write.mode("append").partitionBy(partition).parquet(path)
    return n


def reload(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that df brings and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").partitionBy("season_id").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Refuses when there is none, rather than counting every match."""
    try:
        return spark.read.schema("game_id string, status string, season_id int").json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no manifest at {path}") from e
        raise


def verify_batch(expected: DataFrame, found: DataFrame, key: str, required: list[str]) -> DataFrame:
    """(key, problem): missing, unexpected, malformed, or lacking a required part."""
    missing = expected.select(key).join(found.select(key), key, "left_anti").withColumn("problem", F.lit("missing"))
    extra = found.select(key).join(expected.select(key), key, "left_anti").withColumn("problem", F.lit("unexpected"))
    bad = found.where(F.col("_corrupt_record").isNotNull()).select(key).withColumn("problem", F.lit("malformed")) if "_corrupt_record" in found.columns else missing.limit(0)
    lacking = found.where(" or ".join(f"`{c}` is null" for c in required)).select(key).withColumn("problem", F.lit("lacks a part"))
    return missing.unionByName(extra).unionByName(bad).unionByName(lacking)


def numeric_names(df: DataFrame, name: str) -> DataFrame:
    return df.where(numeric_name(name))


def load_with_status(rows: DataFrame, status: DataFrame, keys: list[str], season: str = "season_id", least: int | None = None) -> DataFrame:
    """Rows with a season (from least on) whose keys the status table holds."""
    kept = rows.where(F.col(season).isNotNull() & (F.lit(True) if least is None else F.col(season) >= least))
    return kept.join(status.select(*keys).distinct(), keys, "left_semi")


def require_schema(df: DataFrame, columns: list[str]) -> DataFrame:
    if lost := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {lost}")
    return df
