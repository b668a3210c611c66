"""The exported data set: Parquet, CSV, manifest, attributions and the image tree."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import UTC, datetime

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.scalars import present, relative_path
from gleaner.plans.storage import materialize, partitions, system_of
from gleaner.schemas import EXPORT_COLUMNS

VERSION = "1.0"


def dataset_rows(images: DataFrame) -> DataFrame:
    """What is exported: no duplicates, with a split."""
    live = images.where("duplicate_of is null and split is not null")
    return live.withColumn("relative_path", relative_path(F.col("split"), F.col("class_label"), F.col("sha256"), F.col("format"), F.col("storage_path")))


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row: fingerprint, 16 hex digits of SHA-256 over sha:split:class of all rows in order of sha, joined by nothing.

    The definition is one digest over all rows, so their keys (80 bytes a row, no other columns) pass through one task; it
    sorts them on disk where they do not fit and digests them as they stream by, so their number has no limit.
    """
    keys = rows.select("sha256", F.concat_ws(":", "sha256", "split", "class_label").alias("key"))

    def run(batches):
        digest = hashlib.sha256()
        for b in batches:
            digest.update("".join(b.column(0).to_pylist()).encode())
        yield pa.record_batch([pa.array([digest.hexdigest()[:16]])], names=["fingerprint"])

    return keys.repartition(1).sortWithinPartitions("sha256", "key").select("key").mapInArrow(run, "fingerprint string")


def manifest_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("class_label", "split").agg(F.count("*").alias("n"))


def license_breakdown(rows: DataFrame) -> DataFrame:
    return rows.groupBy("license").agg(F.count("*").alias("n")).orderBy("license")


def attribution_lines(rows: DataFrame) -> DataFrame:
    """class_label, sha256 and the block of four lines for each image."""
    credit = F.coalesce(present(F.col("attribution")), F.lit("n/a"))
    source = F.coalesce(present(F.col("source_url")), F.col("origin_url"))
    block = F.concat_ws("\n", "relative_path", F.concat(F.lit("  license: "), "license"), F.concat(F.lit("  credit: "), credit), F.concat(F.lit("  source: "), source))
    return rows.select("class_label", "sha256", block.alias("block"))


def sample(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows of each class and split by checksum."""
    rank = F.row_number().over(W.partitionBy("class_label", "split").orderBy("sha256"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def manifest(rows: DataFrame, run_id: str, config: str, created: str | None = None) -> dict:
    """The manifest without its images, which manifest_lines() adds."""
    counts: dict[str, dict[str, int]] = {}
    for r in manifest_counts(rows).orderBy("class_label", "split").collect():  # a row for each class and split
        counts.setdefault(r["class_label"], {})[r["split"]] = r["n"]
    return {
        "schema_version": VERSION,
        "dataset_fingerprint": fingerprint(rows).first()[0],
        "run_id": run_id,
        "created_at": created or datetime.now(UTC).isoformat(),
        "n_images": sum(n for c in counts.values() for n in c.values()),
        "classes": sorted(counts),
        "splits": sorted({s for c in counts.values() for s in c}),
        "counts": counts,
        "licenses": {r["license"]: r["n"] for r in license_breakdown(rows).collect()},
        "config": json.loads(config) if config else {},
    }


def manifest_lines(rows: DataFrame, head: dict) -> DataFrame:
    """value: the lines of one JSON document, head with a last member images, an item for each row by class, split and checksum. The lines are in order over partitions that are ranges of it, so their files, one after another, are the document, and no task holds more than its range."""
    item = F.struct(
        F.col("relative_path").alias("path"), F.col("class_label").alias("label"), "split", "source", "source_url", "license", "attribution",
        F.struct(F.lit("sha256").alias("algorithm"), F.col("sha256").alias("value")).alias("checksum"), "width", "height",
    )
    place = F.struct(F.coalesce("class_label", F.lit("")).alias("label"), F.coalesce("split", F.lit("")).alias("split"), "sha256")
    items = rows.select(place.alias("place"), F.to_json(item, {"ignoreNullFields": "false"}).alias("value"))
    first = items.agg(F.min("place")).first()[0]
    is_first = (F.col("place.label") == first["label"]) & (F.col("place.split") == first["split"]) & (F.col("place.sha256") == first["sha256"]) if first else F.lit(True)
    items = items.select(F.lit(1).alias("part"), "place", F.concat(F.when(is_first, "    ").otherwise("  , "), "value").alias("value"))
    opening = json.dumps(head, indent=2, ensure_ascii=False).removesuffix("\n}") + ',\n  "images": ['
    edges = rows.sparkSession.createDataFrame([(0, opening), (2, "  ]\n}")], "part int, value string")
    edges = edges.select("part", F.lit(None).cast(items.schema["place"].dataType).alias("place"), "value")
    lines = items.unionByName(edges)
    return lines.repartitionByRange(partitions(rows), "part", "place").sortWithinPartitions("part", "place").select("value")


def joined(spark, parts: str, target: str) -> None:
    """One file of the part files of a folder, in order; the folder goes. One task streams them, a megabyte at a time."""

    def run(batches):
        for _ in batches:
            (system, folder), (_, out) = system_of(parts), system_of(target)
            files = sorted(x.path for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.base_name.startswith("part-"))
            if not files:  # a retried task meets what it has done
                yield pd.DataFrame({"n": [0]})
                return
            with system.open_output_stream(temp := f"{out}.{uuid.uuid4().hex}.tmp") as sink:
                for path in files:
                    with system.open_input_stream(path) as source:
                        while chunk := source.read(1 << 20):
                            sink.write(chunk)
            if system.get_file_info(out).type == fs.FileType.Directory:
                system.delete_dir(out)
            system.move(temp, out)
            system.delete_dir(folder)
            yield pd.DataFrame({"n": [len(files)]})

    spark.range(0, 1, 1, 1).mapInPandas(run, "n long").collect()


def _place(root: str):
    """Copies files of a partition's rows into the tree, whatever file systems hold them; counts by outcome."""

    def run(batches):
        for pdf in batches:
            out = []
            for src, rel in zip(pdf["storage_path"], pdf["relative_path"], strict=True):
                (there, source), (here, target) = system_of(str(src)), system_of(f"{root}/{rel}")
                have, placed = (s.get_file_info(p).type == fs.FileType.File for s, p in ((there, source), (here, target)))
                if have and not placed:
                    here.create_dir(target.rpartition("/")[0], recursive=True)
                    fs.copy_files(source, temp := f"{target}.{uuid.uuid4().hex}.part", source_filesystem=there, destination_filesystem=here)
                    here.move(temp, target)
                out.append("copied" if have else "present" if placed else "missing")
            yield pd.DataFrame({"outcome": out})

    return run


def listed(spark, root: str, tasks: int = 64) -> DataFrame:
    """path, under root, of all files in the image tree. Folders are listed by executors, a level a round; classes have many files, so a folder's files go on as they are listed."""
    at = spark.createDataFrame([("images",)], "path string")
    kind = "path string, folder boolean"

    def run(batches):
        for pdf in batches:
            for folder in pdf["path"]:
                system, place = system_of(f"{root}/{folder}")
                found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
                for k in range(0, len(found), 10_000):
                    part = found[k : k + 10_000]
                    yield pd.DataFrame({"path": [f"{folder}/{x.base_name}" for x in part], "folder": [x.type == fs.FileType.Directory for x in part]})

    files = None
    for _ in range(TREE_LEVELS):
        seen = materialize(at.repartition(tasks).mapInPandas(run, kind), "listing")
        here = seen.where("not folder").select("path")
        files, at = here if files is None else files.unionByName(here), seen.where("folder").select("path")
    return files


#: images, split and class.
TREE_LEVELS = 3


def copy_tree(rows: DataFrame, root: str) -> dict[str, int]:
    """Copy images under root (a path or URI that executors reach) and delete what no row claims: listing, copies and deletions are tasks' work, counts are all that comes back."""
    root = root.rstrip("/")
    done = rows.select("storage_path", "relative_path").mapInPandas(_place(root), "outcome string").groupBy("outcome").count().collect()
    counts = {r["outcome"]: r["count"] for r in done}

    def drop(batches):
        for pdf in batches:
            gone = 0
            for path in pdf["path"]:
                system, place = system_of(f"{root}/{path}")
                if system.get_file_info(place).type == fs.FileType.File:  # a retried task meets what it has deleted
                    system.delete_file(place)
                gone += 1
            yield pd.DataFrame({"n": [gone]})

    stale = materialize(listed(rows.sparkSession, root).join(rows.select(F.col("relative_path").alias("path")), "path", "left_anti"), "stale")
    pruned = materialize(stale.mapInPandas(drop, "n long"), "pruned").agg(F.sum("n")).first()[0] or 0
    if pruned:  # folders of a class or split that are empty now; a row each
        for folder in [r[0] for r in stale.select(F.regexp_extract("path", "^(.*)/", 1)).distinct().collect()]:
            while folder.count("/"):
                system, place = system_of(f"{root}/{folder}")
                if system.get_file_info(fs.FileSelector(place, allow_not_found=True)):
                    break
                system.delete_dir(place)
                folder = folder.rpartition("/")[0]
    return {"images_copied": counts.get("copied", 0), "images_missing": counts.get("missing", 0), "images_pruned": pruned}


def export(images: DataFrame, out: str, run_id: str, config: str = "", tree: str | None = None) -> dict:
    """Write all artefacts under out; tree: the local or shared folder for images, None to leave them. An empty set writes and prunes nothing."""
    rows = dataset_rows(images)
    if rows.isEmpty():
        return {"records": 0, "files": []}
    frame = rows.select(*EXPORT_COLUMNS)
    frame.write.mode("overwrite").option("compression", "snappy").parquet(f"{out}/dataset.parquet")
    frame.write.mode("overwrite").option("header", True).csv(f"{out}/dataset.csv")
    doc = manifest(rows, run_id, config)
    manifest_lines(rows, doc).write.mode("overwrite").text(f"{out}/manifest.parts")
    joined(rows.sparkSession, f"{out}/manifest.parts", f"{out}/manifest.json")
    attribution_lines(rows).orderBy("class_label", "sha256").select(F.col("block").alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(f"{out}/ATTRIBUTIONS.txt")
    copied = copy_tree(rows, tree) if tree else {"images_copied": 0, "images_missing": 0, "images_pruned": 0}
    return {"records": doc["n_images"], "fingerprint": doc["dataset_fingerprint"], "files": ["dataset.parquet", "dataset.csv", "manifest.json", "ATTRIBUTIONS.txt"], **copied}
