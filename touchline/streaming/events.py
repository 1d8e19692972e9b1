"""Structured Streaming over event files: windowed counts with late data, and idempotent per-batch upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, schema: str = SCHEMA, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events, values and buyers per type and window; state older than the watermark is dropped."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("window.start").alias("start"), "event_type", "n", "total")
    )


def upsert_batches(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Writes each micro-batch under its own id, so a batch that runs again replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
