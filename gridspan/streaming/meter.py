"""Hourly panel from a stream of meter readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def hourly_stream(readings: DataFrame, entity: str, ts: str, value: str, unique: Sequence[str],
                  delay: str = "2 hours") -> DataFrame:
    """Sum per entity and hour of distinct readings; an hour is final once the watermark
    passes it.  State holds only the hours and keys inside the delay."""
    timed = readings.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    once = timed.dropDuplicatesWithinWatermark(list(unique))
    hours = once.groupBy(F.window("_at", "1 hour").alias("_w"), entity).agg(F.sum(value).alias("y"))
    return hours.select(F.col(entity).alias("entity"), F.col("_w.start").alias("ts"), "y")


def enrich_static(stream: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stream-static left join (station attributes, prices)."""
    return stream.join(dimension, list(keys), "left")


def write_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is available, then stop; a rerun continues from the checkpoint."""
    (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
