"""What a stage returns, and how rows are routed by reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.scalars import present


class StageResult(NamedTuple):
    """kept and rejections are lazy frames; extras hold more of them by name."""

    kept: DataFrame
    rejections: DataFrame
    extras: dict[str, DataFrame] = {}

    def metrics(self) -> DataFrame:
        """metric and value: rows kept, and rows rejected by reason."""
        kept = self.kept.agg(F.lit("kept").alias("metric"), F.count("*").alias("value"))
        return kept.unionByName(self.rejections.groupBy(F.col("reason_code").alias("metric")).agg(F.count("*").alias("value")))


def rejection(df: DataFrame, stage: str, reason: Column, detail: Column) -> DataFrame:
    """Provenance of rejected rows; the source URL is the landing page, else the asset's URL."""
    has = set(df.columns)
    first = lambda *names: F.coalesce(*[present(F.col(n)) for n in names if n in has], F.lit(None).cast("string"))
    return df.select(
        F.lit(stage).alias("stage"), "source", "class_label", F.col("source_id").cast("string").alias("source_id"),
        first("landing_url", "source_url", "image_url", "origin_url").alias("source_url"), reason.alias("reason_code"), detail.alias("detail"),
    )


def route(df: DataFrame, stage: str, reason: Column, detail: Column | None = None) -> StageResult:
    """Rows whose reason is null are kept, the others rejected; reason is a CASE chain, so the first failing check wins."""
    marked = df.withColumn("_reason", reason).withColumn("_detail", F.lit(None).cast("string") if detail is None else detail)
    kept = marked.where("_reason is null").drop("_reason", "_detail")
    out = marked.where("_reason is not null")
    return StageResult(kept, rejection(out, stage, F.col("_reason"), F.col("_detail")))
