"""Tables in hash buckets, of which a write touches only those that its rows fall into.

A table is a folder: v=N/_b=K hold the files of bucket K that version N wrote, _manifest-N says which versions hold each
bucket's files, and _CURRENT names the manifest that counts. It is written under another name and renamed over the old
one, so readers see one version or the other, and files that a manifest names are never changed. Only the manifest (a line
a bucket) passes the driver.

merge() replaces rows by key: buckets that hold a changed key are read, joined and written anew; the others' files go on
as they are. add() puts rows beside those that are there: a bucket gets another folder, and once it has MERGE_AT of them
they are written as one. When buckets hold over BUCKET_ROWS rows on average, their number is doubled, once for as many
rows as there are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new table, rows of a bucket above which there are more of them, and folders of a bucket before they become one.
FIRST, BUCKET_ROWS, MERGE_AT = 16, 1 << 20, 8


class Files:
    """Names under a root in any file system that Hadoop reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def system(self, name: str):
        return self.path(name).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def text(self, name: str) -> str | None:
        fs, path = self.system(name), self.path(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self.system(name).create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def replace(self, name: str, text: str) -> None:
        """Readers see the old text or the new one."""
        self.write(temp := f"{name}-{uuid.uuid4().hex}", text)
        fs, hadoop = self.system(name), self.spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self.path(temp).toUri(), self.spark._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(self.path(temp)), fs.makeQualified(self.path(name)), how)


class Buckets:
    def __init__(self, spark: SparkSession, root: str, schema: str, key: list[str]):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.files = Files(spark, root)

    def version(self) -> int | None:
        """The number of the current version, or None before the first."""
        text = self.files.text("_CURRENT")
        return None if text is None else int(text)

    def manifest(self) -> dict:
        """buckets: how many; held: for each the versions that hold its files; rows."""
        v = self.version()
        return {"buckets": FIRST, "held": {}, "rows": 0} if v is None else json.loads(self.files.text(f"_manifest-{v}"))

    def of(self, n: int) -> Column:
        """A row's bucket."""
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int")

    def _rows(self, manifest: dict, buckets=None) -> DataFrame:
        paths = [f"{self.root}/v={v}/_b={b}" for b, versions in manifest["held"].items() if buckets is None or int(b) in buckets for v in versions]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._rows(self.manifest())

    def _columns(self) -> list[str]:
        return [part.split()[0] for part in self.schema.split(", ")]

    def _write(self, df: DataFrame, v: int, n: int) -> dict[int, int]:
        """Rows by bucket of what was written as version v."""
        target = f"{self.root}/v={v}"
        dealt = df.select(*self._columns()).withColumn("_b", self.of(n))
        dealt.repartition(min(n, 4096), "_b").write.mode("overwrite").partitionBy("_b").parquet(target)
        if self.files.system(target).listStatus(self.files.path(f"v={v}")) is None:
            return {}
        written = self.spark.read.schema(f"{self.schema}, _b int").parquet(target)
        return {r["_b"]: r["count"] for r in written.groupBy("_b").count().collect()}  # a row a bucket

    def _publish(self, v: int, manifest: dict) -> int:
        self.files.write(f"_manifest-{v}", json.dumps(manifest))
        self.files.replace("_CURRENT", str(v))
        return v

    def replace(self, df: DataFrame, check=None) -> int:
        """df as the whole table. check: called with what was written, raises if it must not count."""
        v = self._next()
        n = self.manifest()["buckets"]
        counts = self._write(df, v, n)
        manifest = {"buckets": n, "held": {b: [v] for b in counts}, "rows": sum(counts.values())}
        if check:
            check(self._rows(manifest))
        return self._publish(v, manifest)

    def _next(self) -> int:
        return -1 + 1 if (v := self.version()) is None else v + 1

    def _touched(self, rows: DataFrame, n: int) -> set[int]:
        return {r[0] for r in rows.select(self.of(n)).distinct().collect()}  # n at most

    def merge(self, changes: DataFrame, check=None) -> int:
        """changes (one row a key) take the place of the rows of their keys; other buckets stay as they are."""
        manifest = self._grown(self.manifest())
        n, v = manifest["buckets"], self._next()
        touched = self._touched(changes, n)
        if not touched:
            return -1 if self.version() is None else v - 1
        there = self._rows(manifest, touched)
        before = there.count()
        counts = self._write(there.join(changes.select(*self.key), self.key, "left_anti").select(*self._columns()).unionByName(changes.select(*self._columns())), v, n)
        held = {b: versions for b, versions in manifest["held"].items() if int(b) not in touched} | {str(b): [v] for b in counts}
        after = {"buckets": n, "held": held, "rows": manifest["rows"] - before + sum(counts.values())}
        if check:
            check(self._rows({"held": {str(b): [v] for b in counts}}), self._rows(after))
        return self._publish(v, after)

    def add(self, rows: DataFrame) -> int:
        """rows beside those that are there."""
        manifest = self._grown(self.manifest())
        n, v = manifest["buckets"], self._next()
        counts = self._write(rows, v, n)
        held = {str(b): list(versions) for b, versions in manifest["held"].items()}
        for b in counts:
            held.setdefault(str(b), []).append(v)
        now = {"buckets": n, "held": held, "rows": manifest["rows"] + sum(counts.values())}
        v = self._publish(v, now)
        full = {b for b, versions in held.items() if len(versions) >= MERGE_AT}
        if full:
            merged = self._write(self._rows(now, {int(b) for b in full}), v + 1, n)
            v = self._publish(v + 1, now | {"held": held | {str(b): [v + 1] for b in merged}})
        return v

    def _grown(self, manifest: dict) -> dict:
        """manifest, or one with twice the buckets once they are full."""
        n = manifest["buckets"]
        if manifest["rows"] <= n * BUCKET_ROWS:
            return manifest
        v, rows = self._next(), self._rows(manifest)
        while manifest["rows"] > n * BUCKET_ROWS:
            n *= 2
        counts = self._write(rows, v, n)
        grown = {"buckets": n, "held": {str(b): [v] for b in counts}, "rows": manifest["rows"]}
        self._publish(v, grown)
        return grown

    def vacuum(self) -> int:
        """Delete the folders that the current version does not name; how many. Only while nobody reads an older one."""
        held = {(int(v), int(b)) for b, versions in self.manifest()["held"].items() for v in versions}
        fs, gone = self.files.system(""), 0
        for version in fs.globStatus(self.files.path("v=*/_b=*")) or []:
            at = version.getPath()
            v, b = int(at.getParent().getName()[2:]), int(at.getName()[3:])
            if (v, b) not in held:
                fs.delete(at, True)
                gone += 1
        return gone
