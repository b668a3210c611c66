"""Stages on candidate and curated rows: ingest gap, exact dedup, validation, licences, selection, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.config import License, Source, Split, Validation
from gleaner.functions.licenses import license_elements, normalise_license, permits, requires_attribution
from gleaner.functions.scalars import EXTENSION_FORMATS, fetch_limit, lookup, present, split_score, stripped
from gleaner.operators.stage import StageResult, rejection, route


def ingest_gap(classes: DataFrame, counts: DataFrame, cfg: Source) -> DataFrame:
    """classes: class_label. Adds stored, needed and fetch_limit; classes at their target have needed 0. Every source is asked for the whole gap."""
    df = classes.join(counts.select("class_label", F.col("n").alias("stored")), "class_label", "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
    df = df.withColumn("needed", F.greatest(F.lit(0), F.lit(cfg.target) - F.col("stored")))
    return df.withColumn("fetch_limit", F.when(F.col("needed") > 0, fetch_limit(F.col("needed"), cfg.overfetch)).otherwise(0).cast("long"))


#: Ranges of scores that are ranked one by one; only their counts are ranked as a whole.
SCORE_RANGES = 1 << 12


def ranked_by_score(df: DataFrame, group: Column, ranges: int = SCORE_RANGES) -> DataFrame:
    """df with _rank (from 1, by _score and sha256 within the group) and _n, the group's rows. _score: 0 to 1, evenly spread.

    Rows are dealt by group and range of scores, so a class (or the whole table, as one group) is never one task; counts
    of ranges, at most `ranges` rows a group, are summed up in order.
    """
    df = df.withColumn("_group", F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")))
    df = df.withColumn("_range", F.least(F.floor(F.col("_score") * ranges), F.lit(ranges - 1)).cast("int"))
    upto = W.partitionBy("_group").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy("_group", "_range").agg(F.count("*").alias("_k"))
    sums = sums.select("_group", "_range", F.coalesce(F.sum("_k").over(upto), F.lit(0)).alias("_before"), F.sum("_k").over(W.partitionBy("_group")).alias("_n"))
    here = F.row_number().over(W.partitionBy("_group", "_range").orderBy("_score", "sha256"))
    return df.join(sums, ["_group", "_range"]).withColumn("_rank", F.col("_before") + here).drop("_group", "_range", "_before")


def reuse(records: DataFrame, stored: DataFrame, present_paths: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(reused, pending): records whose URL is stored, with sha256 and storage_path, and the rest. present_paths: storage_path of files with bytes."""
    known = stored.select(F.col("origin_url").alias("image_url"), "sha256", "storage_path").groupBy("image_url").agg(F.max_by("sha256", "sha256").alias("sha256"), F.max_by("storage_path", "sha256").alias("storage_path"))
    if present_paths is not None:
        known = known.join(present_paths.select("storage_path").distinct(), "storage_path", "left_semi").select("image_url", "sha256", "storage_path")
    return records.join(known, "image_url"), records.join(known, "image_url", "left_anti")


def exact_dedup(df: DataFrame, order: list[Column], silent: Column | None = None) -> StageResult:
    """One row for each sha256, the first in order; others are EXACT_DUPLICATE, but for those where silent holds, which only go. The winner is an aggregate, so copies are reduced before the shuffle."""
    rank = F.struct(*[c.alias(f"_{k}") for k, c in enumerate(order)])
    first = df.groupBy("sha256").agg(F.min(rank).alias("_first"))
    marked = df.withColumn("_rank", rank).join(first, "sha256")
    kept = marked.where("_rank = _first").drop("_rank", "_first")
    lost = marked.where("_rank <> _first")
    lost = lost if silent is None else lost.where(~silent)
    return StageResult(kept, rejection(lost, "download", F.lit("EXACT_DUPLICATE"), F.concat(F.lit("same bytes as another candidate: "), F.substring("sha256", 1, 12))))


def validation_reason(cfg: Validation) -> Column:
    """The first failing check of file_size_bytes, status (null, bomb, unreadable, truncated), format, extension, width and height."""
    small, large = F.least("width", "height"), F.greatest("width", "height")
    expected = lookup(EXTENSION_FORMATS, F.lower(F.regexp_replace("extension", r"^\.+", "")))
    return (
        F.when(F.col("file_size_bytes") < cfg.min_bytes, "FILESIZE_TOO_SMALL")
        .when((F.col("status") == "bomb") | (F.col("width").cast("long") * F.col("height") > 2 * cfg.max_pixels), "IMAGE_BOMB")
        .when(F.col("status") == "unreadable", "UNREADABLE_IMAGE")
        .when(F.col("status") == "truncated", "TRUNCATED_IMAGE")
        .when(~F.coalesce(F.col("format").isin(*cfg.formats), F.lit(False)), "UNSUPPORTED_FORMAT")
        .when(expected.isNotNull() & (expected != F.col("format")), "EXTENSION_MISMATCH")
        .when(small < cfg.min_dimension, "DIMENSIONS_TOO_SMALL")
        .when(large > cfg.max_dimension, "DIMENSIONS_TOO_LARGE")
        .when((small > 0) & (large / F.nullif(small, F.lit(0)) > cfg.max_aspect), "ASPECT_RATIO_EXTREME")
    )


def validate(df: DataFrame, cfg: Validation = Validation()) -> StageResult:
    return route(df, "validate", validation_reason(cfg), F.concat_ws(" ", F.col("format"), F.concat_ws("x", "width", "height"), F.concat("file_size_bytes", F.lit(" bytes"))))


def normalize(df: DataFrame, cfg: License = License()) -> StageResult:
    """Licences to SPDX; unreadable and forbidden ones go. A licence that asks for credit gets a placeholder where none is given. extras: placeholders."""
    df = df.withColumn("license", normalise_license(F.col("license_raw")))
    reason = F.when(F.col("license").isNull(), "UNRECOGNISED_LICENSE").when(~permits(F.col("license"), cfg.forbidden), "LICENSE_NOT_PERMITTED")
    bad = F.array_join(F.array_intersect(license_elements(F.col("license")), F.array(*map(F.lit, cfg.forbidden)).cast("array<string>")), ", ")
    out = route(df, "normalize", reason, F.when(F.col("license").isNull(), F.substring("license_raw", 1, 120)).otherwise(F.concat("license", F.lit(" carries "), bad)))
    given = present(F.col("attribution"))
    needs = requires_attribution(F.col("license")) & given.isNull()
    place = F.concat(F.lit("Unknown author (see "), F.coalesce(present(F.col("landing_url")), F.col("image_url")), F.lit(")"))
    kept = out.kept.withColumn("attribution", F.when(needs, place).otherwise(given)).withColumn("class_label", F.lower(stripped(F.col("class_label"))))
    return StageResult(kept, out.rejections, {"placeholders": kept.where(F.col("attribution").startswith("Unknown author (see "))})


def select_target(df: DataFrame, counts: DataFrame, stored: DataFrame, cfg: Source = Source(), split: Split = Split()) -> StageResult:
    """At most target rows a class, counting what is stored. counts: class_label and n; stored: sha256.

    Stored rows are kept and cost nothing; marked duplicates cost nothing but follow the row they point at; new rows are
    taken by split score. Ranks are found by ranges of scores, so no class is one task.
    """
    known = stored.select("sha256").distinct().withColumn("_known", F.lit(True))
    marked = df.join(known, "sha256", "left")
    duplicates = marked.where("duplicate_of is not null").drop("_known")
    again = marked.where("duplicate_of is null and _known").drop("_known")
    new = marked.where("duplicate_of is null and _known is null").drop("_known").withColumn("_score", split_score(F.col("sha256"), split.salt))
    ranked = ranked_by_score(new, F.col("class_label")).drop("_n").join(counts.select("class_label", F.col("n").alias("_n")), "class_label", "left")
    budget = F.greatest(F.lit(0), F.lit(cfg.target) - F.coalesce("_n", F.lit(0)))
    ranked = ranked.withColumn("_in", F.col("_rank") <= budget).drop("_rank", "_n", "_score")
    chosen, trimmed = ranked.where("_in").drop("_in"), ranked.where("not _in").drop("_in")
    surviving = stored.select("sha256").union(chosen.select("sha256")).distinct().withColumnRenamed("sha256", "duplicate_of")
    orphans = duplicates.join(surviving, "duplicate_of", "left_anti")
    kept = again.unionByName(chosen).unionByName(duplicates.join(surviving, "duplicate_of", "left_semi").select(*again.columns))
    over = F.lit("OVER_TARGET")
    lost = rejection(trimmed, "select", over, F.lit(f"no room left: {cfg.target} a class are wanted")).unionByName(rejection(orphans, "select", over, F.lit("its original found no room")))
    return StageResult(kept, lost, {"selected": chosen, "orphans": orphans})


def assign_split(df: DataFrame, cfg: Split = Split()) -> DataFrame:
    """Adds score and split. Rank strategy: of n rows a class, the first n * percent (halves to even) by score and sha256 are train, with one row at least on either side where n > 1."""
    df = df.withColumn("score", split_score(F.col("sha256"), cfg.salt))
    if cfg.strategy == "stable_bucket":
        return df.withColumn("split", F.when(F.col("score") < cfg.train_percent / 100, "train").otherwise("val"))
    group = F.col("class_label") if cfg.stratify else F.lit("all")
    df = ranked_by_score(df.withColumn("_score", F.col("score")), group).drop("_score")
    share = F.bround(F.col("_n") * cfg.train_percent / 100).cast("long")
    train = F.when(F.col("_n") > 1, F.greatest(F.lit(1), F.least(F.col("_n") - 1, share))).otherwise(F.col("_n"))
    return df.withColumn("split", F.when(F.col("_rank") <= train, "train").otherwise("val")).drop("_n", "_rank")


def resplit(images: DataFrame, cfg: Split = Split()) -> DataFrame:
    """sha256 and split of the rows whose split changes; duplicates keep none."""
    new = assign_split(images.where("duplicate_of is null").select("sha256", "class_label", F.col("split").alias("_old")), cfg)
    return new.where("not (split <=> _old)").select("sha256", "split")


def split_in_memory(df: DataFrame, cfg: Split = Split()) -> DataFrame:
    """All rows with their split; duplicates have none."""
    own = assign_split(df.where("duplicate_of is null").drop("split"), cfg).drop("score")
    rest = df.where("duplicate_of is not null").withColumn("split", F.lit(None).cast("string"))
    return own.unionByName(rest.select(*own.columns))
