"""Shared plumbing of the training-data operators: table reads, lineage cuts and Arrow batch mapping."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words are maximal runs of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES, ROW_GROUP = 8 << 20, 32 << 20
try:
    _MALLOC_TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _MALLOC_TRIM = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; always through Spark's reader, so any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where none is set, a temporary one in local mode only: other masters need a folder that all machines see.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    found = found or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="touchline-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df once to the shared folder and read it back, with file statistics for join planning.

    The table goes when discard() is called or, at the latest, when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/touchline-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table behind a frame that materialize returned, once nothing will read it again."""
    spark, path = df.sparkSession, getattr(df, "_written_at", None)
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def crc_mod(column: str, modulus: int):
    """crc32 of an id written as text, modulo modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def bound_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches hold at most BATCH_BYTES, unless the session sets its own bound.

    Spark's default bound suits executors with much more memory than a JVM and its Python workers share here.
    """
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))
    return df


def trim() -> None:
    """Give memory that a worker has freed back to the system, as workers outlive their tasks and share a machine with the JVM."""
    pa.default_memory_pool().release_unused()
    if _MALLOC_TRIM is not None:
        _MALLOC_TRIM(0)


def map_batches(df: DataFrame, fn: Callable[..., dict[str, pa.Array]], added: str, keep: list[str], inputs: list[str]) -> DataFrame:
    """Append computed columns to the kept ones, an Arrow batch at a time.

    fn gets the inputs as Arrow arrays and returns the added columns by name; added is their DDL. Only the inputs go to
    Python and only the added columns come back; the kept ones stay in the JVM. Memory is that of one batch
    (bounded in rows and bytes by Spark) and of what fn makes of it.
    """
    extra = StructType.fromDDL(added)
    names = [f.name for f in extra.fields]

    def run(*arrays: pa.Array) -> pa.Array:
        got = fn(*arrays)
        trim()
        return pa.StructArray.from_arrays([got[n] for n in names], names=names)

    # a deterministic one would be evaluated again in every filter on its result
    made = F.arrow_udf(run, extra).asNondeterministic()
    placed = bound_batches(df).select(*[F.col(f"`{k}`").alias(f"c{i}") for i, k in enumerate(keep)], made(*[F.col(f"`{k}`") for k in inputs]).alias("made"))
    return placed.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(keep)], *[F.col(f"made.{n}").alias(n) for n in names])
