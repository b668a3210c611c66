"""Incremental runs: new files of a landing folder, curated batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def curate_stream(spark: SparkSession, landing: str, schema: str, checkpoint: str, each: Callable[[DataFrame, int], None], max_files: int | None = None):
    """Run each(batch, id) over what is new in landing (Parquet) and stop; state is in the tables that each writes, progress in checkpoint."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = reader.parquet(landing).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def rejection_windows(rejections: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts of a stream's (or a table's) rejections by window, stage and reason; rows later than late are left out of streams."""
    df = rejections.withWatermark("occurred_at", late) if rejections.isStreaming else rejections
    grouped = df.groupBy(F.window("occurred_at", width).alias("w"), "stage", "reason_code").agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").alias("window_start"), "stage", "reason_code", "n")
