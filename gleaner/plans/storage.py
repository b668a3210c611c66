"""Materialised intermediates in the folder that all executors share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary folder is made only where it is unset and executors are threads of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gleaner/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here and no executor's loss undoes it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _tables(df: DataFrame) -> set[str]:
    return {f.rpartition("/")[0] for f in df.inputFiles() if "/gleaner/" in f}


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote for df; only for frames that nothing reads any more."""
    delete(df.sparkSession, _tables(df))


def delete(spark: SparkSession, tables: set[str] | list[str]) -> None:
    """Delete folders that materialize() wrote; what is gone already is left alone."""
    for table in tables:
        system, path = _folder(spark, table)
        system.delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of frames that are gone: it learns of them from the driver's garbage collection, which may be a long time off."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that materialize() writes in this block, those of blocks in it included."""
    outer, own = _WRITTEN.get(), []
    token = _WRITTEN.set(own)
    try:
        yield own
    finally:
        _WRITTEN.reset(token)
        if outer is not None:
            outer.extend(own)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables written in this block go at its end, but for those that the frames in the list read. After an error all stay."""
    keep: list[DataFrame] = []
    with recorded() as written:
        yield keep
        names = {table.rpartition("/")[2] for df in keep for table in _tables(df)}
        delete(spark, [table for table in written if table.rpartition("/")[2] not in names])


def written_after(df: DataFrame, tables: list[str]) -> bool:
    """Whether df reads none of the tables, and files only that were written after all of these. False if df reads no files; tables that are gone say nothing."""
    spark, names = df.sparkSession, {table.rpartition("/")[2] for table in tables}
    files = df.inputFiles()
    if not files or any(f.rpartition("/")[0].rpartition("/")[2] in names for f in files):
        return False
    stamps = [system.getFileStatus(path).getModificationTime() for system, path in (_folder(spark, t) for t in tables) if system.exists(path)]
    folders = {f.rpartition("/")[0] for f in files}
    return all(system.getFileStatus(path).getModificationTime() >= max(stamps, default=0) for system, path in (_folder(spark, f) for f in folders))


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that sorts and shuffles both sides, whatever Spark takes their sizes for.

    Spark takes what explode() makes for as large as its input, and a table for as large as its compressed files; so a
    table of keys that is 30 times the estimate would be broadcast, and the driver holds all of a broadcast.
    """
    return df.hint("merge")


def partitions(df: DataFrame, bytes_each: int = 32 << 20) -> int:
    """How many partitions a stage needs whose tasks hold their rows: spark.sql.shuffle.partitions, or more if df's files are larger than bytes_each for each of those. Frames of unknown size get the setting."""
    held = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return held if size >= 1 << 60 else max(held, -(-size // bytes_each))


def system_of(path: str):
    """The file system of a path or URI, and the path there."""
    if "://" not in path:
        path = "file://" + os.path.abspath(path.removeprefix("file:"))
    return fs.FileSystem.from_uri(path)
