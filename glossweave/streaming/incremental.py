"""Incremental runs: Structured Streaming with a checkpoint in place of lists of processed ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(folder)


def dedup(stream: DataFrame, text: str = "text", arrived: str | None = None, within: str = "7 days") -> DataFrame:
    """Each text once, by its hash; with an arrival time, state is kept for `within` only."""
    hashed = stream.withColumn("text_hash", F.sha2(text, 256))
    if arrived:
        return hashed.withWatermark(arrived, within).dropDuplicatesWithinWatermark(["text_hash"])
    return hashed.dropDuplicates(["text_hash"])


def append(stream: DataFrame, out: str, checkpoint: str, partition_by: list[str] | None = None):
    """Processes what is new and stops; a run that fails goes on where it stopped, each row once."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.partitionBy(*partition_by) if partition_by else writer).trigger(availableNow=True).start()


def event_counts(stream: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts by event type in tumbling windows of event time."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"))
