"""Streaming extension: windowed counts with late data, and corrections where the last write wins.

The engine's batch families have no unbounded source; this serves an event feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENTS)
    return (r.option("maxFilesPerTrigger", files_at_once) if files_at_once else r).parquet(folder)


def tumbling(events: DataFrame, size: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Counts by type and (sliding) window; rows later than ``late`` are left out."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    d = events.withWatermark("ts", late) if events.isStreaming else events
    return d.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    """Sessions of a user, ended by a gap without events."""
    d = events.withWatermark("ts", late) if events.isStreaming else events
    s = d.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def last_wins(batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The latest row of each key of a micro-batch, to be merged into a table in ``foreachBatch``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
