"""Reports on runs and on the curated set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import Source


def accumulate(metrics: DataFrame) -> DataFrame:
    """One value for each run, stage and metric: appended rows add up."""
    return metrics.groupBy("run_id", "stage", "metric").agg(F.sum("value").alias("value"))


def run_summary(runs: DataFrame, metrics: DataFrame, rejections: DataFrame, now: Column | None = None) -> DataFrame:
    """A row for each run. Trimmed rows are no rejections; both sides are aggregated before they are joined."""
    of = lambda m: F.sum(F.when(F.col("metric") == m, F.col("value")))
    m = metrics.groupBy("run_id").agg(of("fetched").alias("fetched"), of("downloaded").alias("downloaded"), of("kept").alias("kept"), of("near_duplicates").alias("near"))
    over = F.col("reason_code") == "OVER_TARGET"
    r = rejections.groupBy("run_id").agg(F.count_if(~over).alias("rejected"), F.count_if(over).alias("trimmed"))
    df = runs.join(m, "run_id", "left").join(r, "run_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    end = F.coalesce("finished_at", F.current_timestamp() if now is None else now)
    seconds = F.round((F.unix_micros(end.cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))).cast("decimal(20,0)") / 1000000, 1)
    # Whole-number arithmetic: halves away from zero, and no rounding before the last.
    rate = F.when(zero("fetched") > 0, F.expr("((2000 * coalesce(rejected, 0) + coalesce(fetched, 0)) div nullif(2 * coalesce(fetched, 0), 0)) / 10.0D"))
    return df.select(
        "run_id", "status", "started_at", "finished_at", seconds.cast("double").alias("duration_seconds"), zero("fetched").alias("fetched"),
        zero("downloaded").alias("downloaded"), zero("kept").alias("kept"), zero("rejected").alias("rejected"), zero("near").alias("near_duplicates_marked"),
        zero("trimmed").alias("trimmed_over_target"), rate.alias("rejection_rate_pct"), "error_message",
    )


def dataset_composition(images: DataFrame) -> DataFrame:
    mean = lambda c: F.expr(f"(2 * sum(cast({c} as bigint)) + count({c})) div (2 * count({c}))")
    live = images.where("duplicate_of is null and split is not null")
    return live.groupBy("class_label", "split").agg(F.count("*").alias("n_images"), mean("width").alias("avg_width"), mean("height").alias("avg_height"), F.count_distinct("source").alias("n_sources"))


def class_counts(images: DataFrame) -> DataFrame:
    return images.where("duplicate_of is null").groupBy("class_label").agg(F.count("*").alias("n"))


def rejection_breakdown(rejections: DataFrame) -> DataFrame:
    """stage, reason_code and n, the most frequent first."""
    return rejections.groupBy("stage", "reason_code").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "reason_code", "stage")


def quality_gate(classes: DataFrame, counts: DataFrame, cfg: Source, images_missing: int = 0) -> DataFrame:
    """One row: status (partial if any class is short or an image is missing), n_short and the least count."""
    df = classes.join(counts, "class_label", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    short = F.count_if(F.col("n") < cfg.minimum)
    return df.agg(F.when((short > 0) | F.lit(images_missing > 0), "partial").otherwise("success").alias("status"), short.alias("n_short"), F.min("n").alias("least"))


def empty_sources(asked: DataFrame, fetched: DataFrame) -> DataFrame:
    """Sources (source, needed) that were asked for something and gave nothing; fetched: source, one row a record."""
    want = asked.groupBy("source").agg(F.sum("needed").alias("needed")).where("needed > 0")
    return want.join(fetched.select("source").distinct(), "source", "left_anti").select("source")


def split_counts(rows: DataFrame) -> DataFrame:
    """class_label, train, val and the share of train in percent."""
    train = F.count_if(F.col("split") == "train")
    return rows.groupBy("class_label").agg(train.alias("train"), F.count_if(F.col("split") == "val").alias("val"), F.round(train.cast("decimal(20,0)") * 100 / F.count("*"), 1).cast("double").alias("train_pct"))
