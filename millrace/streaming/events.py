"""An addition: counts of an append-only event log by type and window, with late events dropped by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, end, kind, n, total) of finished windows; works on streams and on tables alike."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    counted = marked.groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n", "total")
