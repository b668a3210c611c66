"""The curated layer: versioned Parquet tables with an atomic pointer, and what writes them.

images stands in hash buckets (buckets.py): a write touches the buckets of its rows. pipeline_runs is a small table of whole
snapshots: folders v=N and _CURRENT, which names the one that counts. Audit tables are appended to. Every write is
checked for the rules of its table before it counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.plans.buckets import Buckets, Files
from gleaner.plans.storage import materialize
from gleaner.schemas import REASONS, RUN_STATUS, SOURCES, SPLITS, STAGES, TABLES, columns


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)
        self.images = Buckets(spark, f"{self.root}/images", TABLES["images"], ["sha256"])

    def version(self, table: str) -> int | None:
        if table == "images":
            return self.images.version()
        text = self.files.text(f"{table}/_CURRENT")
        return None if text is None else int(text)

    def init(self) -> None:
        """Folders of all tables; repeating it changes nothing."""
        for table in TABLES:
            self.files.system(table).mkdirs(self.files.path(table))

    def read(self, table: str) -> DataFrame:
        if table == "images":
            return self.images.read()
        schema = TABLES[table]
        if table == "pipeline_runs":
            v = self.version(table)
            path = f"{self.root}/{table}/v={v}" if v is not None else None
        else:
            fs = self.files.system(table)
            path = f"{self.root}/{table}" if fs.exists(self.files.path(table)) and fs.listStatus(self.files.path(table)) else None
        return self.spark.read.schema(schema).parquet(path) if path else self.spark.createDataFrame([], schema)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to an audit table; words outside the closed vocabularies are refused."""
        rows = materialize(df.select(*columns(TABLES[table])), f"to-{table}")
        _refuse(table, unknown_words({table: rows}))
        rows.write.mode("append").parquet(f"{self.root}/{table}")

    def publish(self, table: str, df: DataFrame) -> int:
        """df as the whole table: written as the next version, checked, and made the current one."""
        if table == "images":
            return self.images.replace(df, lambda rows: _refuse("images", constraint_violations(rows).where("n > 0")))
        v = (self.version(table) if self.version(table) is not None else -1) + 1
        target = f"{self.root}/{table}/v={v}"
        df.select(*columns(TABLES[table])).write.mode("overwrite").parquet(target)
        _refuse(table, unknown_words({table: self.spark.read.schema(TABLES[table]).parquet(target)}))
        self.files.replace(f"{table}/_CURRENT", str(v))
        return v

    def merge_images(self, changes: DataFrame) -> int:
        """changes take the place of the images with their sha256. Rules of a row and of its sha256 are checked in the buckets that are written, sources' ids over all rows."""

        def check(written: DataFrame, after: DataFrame) -> None:
            _refuse("images", constraint_violations(written, after).where("n > 0"))

        return self.images.merge(materialize(changes.select(*columns(TABLES["images"])), "changes"), check)


def _refuse(table: str, bad: DataFrame) -> None:
    if found := [tuple(r) for r in bad.collect()]:
        raise ValueError(f"{table} is not published: {found}")


#: Rules of a row of images: expressions that hold where a rule is broken.
ROW_RULES = {
    "sha256_not_null": "sha256 is null",
    "license_not_null": "license is null",
    "positive_width": "not coalesce(width > 0, false)",
    "positive_height": "not coalesce(height > 0, false)",
    "positive_size": "not coalesce(file_size_bytes > 0, false)",
    "split_known": f"split is not null and split not in ({', '.join(repr(x) for x in SPLITS)})",
    "not_own_duplicate": "duplicate_of = sha256",
    "duplicate_with_distance": "(duplicate_of is null) <> (duplicate_distance is null)",
}


def constraint_violations(images: DataFrame, all_images: DataFrame | None = None) -> DataFrame:
    """constraint and n, a row for each rule of the table; all n are 0 in a sound one. all_images: the whole table, if images are only those of some sha256s."""
    wide = images.agg(*[F.count(F.when(F.expr(rule), 1)).alias(name) for name, rule in ROW_RULES.items()])
    single = wide.select(F.explode(F.create_map(*[x for n in ROW_RULES for x in (F.lit(n), F.col(n))])).alias("constraint", "n"))
    repeats = lambda df, name, *keys: df.groupBy(*keys).count().where("count > 1").agg(F.lit(name).alias("constraint"), F.count("*").alias("n"))
    everything = images if all_images is None else all_images
    return single.unionByName(repeats(images, "sha256_unique", "sha256")).unionByName(repeats(everything, "source_id_unique", "source", "source_id"))


def vocabulary() -> list[tuple[str, str, list[str]]]:
    """Table, field and allowed words of every closed vocabulary."""
    reasons = [r for rs in REASONS.values() for r in rs]
    own = {"rejections": {"stage": STAGES, "reason_code": reasons, "source": SOURCES}, "pipeline_runs": {"status": RUN_STATUS}, "raw_records": {"source": SOURCES}, "images": {"split": SPLITS}}
    return [(t, f, words) for t, fields in own.items() for f, words in fields.items()]


def unknown_words(tables: dict[str, DataFrame]) -> DataFrame:
    """field, value and n of values outside the closed vocabularies of the given tables, by name."""
    out = None
    for t, f, words in vocabulary():
        if t in tables:
            found = tables[t].where(F.col(f).isNotNull() & ~F.col(f).isin(*words)).groupBy(F.lit(f"{t}.{f}").alias("field"), F.col(f).alias("value")).agg(F.count("*").alias("n"))
            out = found if out is None else out.unionByName(found)
    return next(iter(tables.values())).sparkSession.createDataFrame([], "field string, value string, n long") if out is None else out


def schema_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row on the tables by name: scalar sub-selects over the schema's baseline, what breaks a rule, and a verdict.

    tables_expected, tables_found and columns_found: the tables and columns of schemas.py that are there under their names
    and types; rules_broken: rules of images and closed vocabularies with at least one violation; orphans: rows of audit
    tables whose run is unknown, and marks whose original is; verdict: ok, or what is wrong first.
    """
    spark = next(iter(tables.values())).sparkSession
    want = [(t, c.split()[0], c.split()[1]) for t, schema in TABLES.items() for c in schema.split(", ")]
    have = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema]
    kind = "t string, c string, k string"
    simple = lambda k: {"long": "bigint"}.get(k, k)
    expected = spark.createDataFrame([(t, c, simple(k)) for t, c, k in want], kind)
    found = spark.createDataFrame(have, kind)
    broken = constraint_violations(tables["images"]).where("n > 0").select("n").unionByName(unknown_words(tables).select("n"))
    runs = tables["pipeline_runs"].select("run_id").distinct()
    lost = [tables[t].select("run_id").where("run_id is not null").join(runs, "run_id", "left_anti") for t in ("rejections", "run_stage_metrics", "raw_records")]
    marks = tables["images"].where("duplicate_of is not null").select("duplicate_of").join(tables["images"].select(F.col("sha256").alias("duplicate_of")), "duplicate_of", "left_anti").select(F.col("duplicate_of").alias("run_id"))
    orphans = lost[0].unionAll(lost[1]).unionAll(lost[2]).unionAll(marks)
    there = expected.join(found, ["t", "c", "k"], "left_semi")
    whole = expected.groupBy("t").count().join(there.groupBy("t").count(), ["t", "count"])
    one = lambda df, name: df.agg(F.count("*").alias(name))
    report = one(expected.select("t").distinct(), "tables_expected")
    for df, name in ((whole, "tables_found"), (expected, "columns_expected"), (there, "columns_found"), (broken, "rules_broken"), (orphans, "orphans")):
        report = report.select("*", one(df, name).scalar().alias(name))
    verdict = F.when(F.col("columns_found") < F.col("columns_expected"), "columns are missing").when(F.col("rules_broken") > 0, "rules are broken").when(F.col("orphans") > 0, "rows without their parent").otherwise("ok")
    return report.withColumn("verdict", verdict)


#: For every rule of images what a planted row has to break it, over a sound row's columns.
PLANTED = {
    "sha256_not_null": {"sha256": "null"}, "license_not_null": {"license": "null"}, "positive_width": {"width": "0"}, "positive_height": {"height": "-1"}, "positive_size": {"file_size_bytes": "0"},
    "split_known": {"split": "'holdout'"}, "not_own_duplicate": {"duplicate_of": "sha256", "duplicate_distance": "0"}, "duplicate_with_distance": {"duplicate_of": "'other'", "duplicate_distance": "null"},
    "sha256_unique": {"sha256": "_stored", "source_id": "'planted'"}, "source_id_unique": {"sha256": "'planted'"}, "sound": {},
}


def verify_schema(images: DataFrame, rejections: DataFrame, metrics: DataFrame, composition: DataFrame) -> DataFrame:
    """check_name, outcome (PASS or what went wrong), the tables' baseline counts, and in each row the verdict over all checks.

    For every rule a row that breaks it, and it alone, is planted beside the stored ones, and the rule has to find it and
    no other rule may; a sound row has to pass. Baseline counts are scalar sub-selects; tables are only read. Planted rows
    meet the stored ones by key, so the table is read once for its counts and once for those keys.
    """
    rules = [n for n in PLANTED if n != "sound"]
    seed = images.orderBy("sha256").limit(1).withColumns({"_stored": F.col("sha256"), "split": F.lit("train"), "duplicate_of": F.lit(None).cast("string"), "duplicate_distance": F.lit(None).cast("int")})
    seed = seed.withColumns({"license": F.coalesce("license", F.lit("CC0-1.0")), **{c: F.greatest(F.col(c), F.lit(1)) for c in ("width", "height", "file_size_bytes")}})
    planted = None
    for name, changed in PLANTED.items():
        fresh = {"sha256": F.lit(f"planted {name}"), "source_id": F.lit(f"planted {name}")} if name not in ("sha256_unique", "source_id_unique") else {}
        row = seed.withColumns(fresh)
        row = row.withColumns({c: F.expr(v).cast(images.schema[c].dataType) for c, v in changed.items()}).withColumn("check_name", F.lit(name))
        planted = row if planted is None else planted.unionByName(row)
    planted = materialize(planted, "planted")
    same = lambda *keys: planted.join(images.select(*keys), [*keys], "left_semi").select("check_name")
    single = planted.select("check_name", F.explode(F.array(*[F.when(F.expr(rule), F.lit(n)) for n, rule in ROW_RULES.items()])).alias("broken")).where("broken is not null")
    found = single.unionByName(same("sha256").withColumn("broken", F.lit("sha256_unique"))).unionByName(same("source", "source_id").withColumn("broken", F.lit("source_id_unique")))
    found = found.groupBy("check_name").agg(F.array_sort(F.collect_set("broken")).alias("broken"))  # a dozen rules
    want = planted.sparkSession.createDataFrame([(n, [n] if n in rules else []) for n in PLANTED], "check_name string, want array<string>")
    outcome = F.when(F.coalesce("broken", F.array().cast("array<string>")) == F.col("want"), "PASS").otherwise(F.concat(F.lit("broken: "), F.array_join(F.coalesce("broken", F.array().cast("array<string>")), ", ")))
    results = want.join(found, "check_name", "left").select("check_name", outcome.alias("outcome"))
    one = lambda df, value: df.agg(value.alias("n")).scalar()
    baseline = {"images": one(images, F.count("*")), "rejections": one(rejections, F.count("*")), "metrics": one(metrics, F.count("*")), "composition": one(composition, F.coalesce(F.sum("n_images"), F.lit(0)))}
    failed = one(results.where("outcome <> 'PASS'"), F.count("*"))
    verdict = F.when(failed == 0, F.lit(f"all {len(PLANTED)} checks passed")).otherwise(F.concat(failed.cast("string"), F.lit(" checks failed")))
    return results.select("check_name", "outcome", *[v.alias(k) for k, v in baseline.items()], verdict.alias("verdict"))


def upsert(images: DataFrame, batch: DataFrame, run_id: str, order: list, now=None) -> dict[str, DataFrame]:
    """images after batch, and counters. First writer wins: a known sha256 only gets last_seen_run_id and a split where the batch has one.

    A new sha256 whose (source, source_id) is taken by other bytes, stored or earlier in the batch, is conflicted and skipped.
    """
    now = F.current_timestamp() if now is None else now
    batch = batch.withColumn("_at", F.struct(*[c.alias(f"_{k}") for k, c in enumerate(order)]))
    first = batch.groupBy("sha256").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"), F.max_by("split", F.when(F.col("split").isNotNull(), F.col("_at"))).alias("_split"))
    met = images.select("sha256").join(first.select("sha256", "_n"), "sha256")
    seen = images.join(first.select("sha256", "_split", F.lit(True).alias("_hit")), "sha256", "left")
    hit = F.coalesce("_hit", F.lit(False))
    updated = seen.withColumn("split", F.when(hit, F.coalesce("_split", "split")).otherwise(F.col("split"))).withColumn("last_seen_run_id", F.when(hit, F.lit(run_id)).otherwise(F.col("last_seen_run_id"))).withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at"))).select(*images.columns)
    new = batch.join(first.select("sha256", "_first", "_n"), "sha256").where("_at = _first").dropDuplicates(["sha256"]).join(images.select("sha256"), "sha256", "left_anti")
    taken = new.join(images.select("source", "source_id").distinct(), ["source", "source_id"], "left_semi")
    free = new.join(images.select("source", "source_id").distinct(), ["source", "source_id"], "left_anti")
    winner = free.groupBy("source", "source_id").agg(F.min("_at").alias("_win"))
    free = free.join(winner, ["source", "source_id"])
    inserted = free.where("_at = _win")
    lost = taken.select("source", "source_id", "sha256", "_n").unionByName(free.where("_at <> _win").select("source", "source_id", "sha256", "_n"))
    have = set(batch.columns)
    fill = {"first_seen_run_id": F.lit(run_id), "last_seen_run_id": F.lit(run_id), "created_at": now, "updated_at": now}
    none = {"duplicate_of", "duplicate_distance"}  # marks are set by mark_duplicates, once both rows exist
    rows = inserted.select(*[fill[c].alias(c) if c in fill else F.col(c) if c in have and c not in none else F.lit(None).cast(images.schema[c].dataType).alias(c) for c in images.columns])
    counters = (
        rows.agg(F.lit("inserted").alias("metric"), F.count("*").alias("value"))
        .unionByName(met.select("_n").unionByName(inserted.select((F.col("_n") - 1).alias("_n"))).agg(F.lit("already_known").alias("metric"), F.coalesce(F.sum("_n"), F.lit(0)).alias("value")))
        .unionByName(lost.agg(F.lit("conflicted").alias("metric"), F.coalesce(F.sum("_n"), F.lit(0)).alias("value")))
    )
    return {"images": updated.unionByName(rows), "counters": counters, "conflicts": lost.drop("_n")}


def mark_duplicates(images: DataFrame, marks: DataFrame, now=None) -> DataFrame:
    """images with marks applied (sha256, duplicate_of, distance): only where both rows exist and differ; split is cleared."""
    now = F.current_timestamp() if now is None else now
    valid = marks.where("sha256 <> duplicate_of").join(images.select(F.col("sha256").alias("duplicate_of")), "duplicate_of", "left_semi")
    valid = valid.groupBy("sha256").agg(F.min(F.struct("distance", "duplicate_of")).alias("_m"))
    df = images.join(valid, "sha256", "left")
    hit = F.col("_m").isNotNull()
    changed = {
        "duplicate_of": F.when(hit, F.col("_m.duplicate_of")).otherwise(F.col("duplicate_of")),
        "duplicate_distance": F.when(hit, F.col("_m.distance").cast("int")).otherwise(F.col("duplicate_distance")),
        "split": F.when(~hit, F.col("split")),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
    }
    return df.withColumns({c: v for c, v in changed.items() if c in images.columns}).select(*images.columns)


def set_splits(images: DataFrame, new: DataFrame, now=None) -> DataFrame:
    """images with the splits of new (sha256, split); duplicates keep none."""
    now = F.current_timestamp() if now is None else now
    df = images.join(new.select("sha256", F.col("split").alias("_split")), "sha256", "left")
    hit = F.col("_split").isNotNull() & F.col("duplicate_of").isNull()
    return df.withColumn("split", F.when(hit, F.col("_split")).otherwise(F.col("split"))).withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at"))).select(*images.columns)


def delete_runs(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Tables after runs (run_id) are deleted: their audit rows go, images stay and forget them."""
    gone = gone.select("run_id").distinct()
    out = {t: df.join(gone, "run_id", "left_anti").select(*df.columns) for t, df in tables.items() if t != "images"}
    if "images" in tables:
        df = tables["images"]
        for c in ("first_seen_run_id", "last_seen_run_id"):
            df = df.join(gone.select(F.col("run_id").alias("_gone")), F.col(c) == F.col("_gone"), "left").withColumn(c, F.when(F.col("_gone").isNull(), F.col(c))).drop("_gone")
        out["images"] = df
    return out


def latest_runs(runs: DataFrame, n: int) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc()).limit(n)


def known_urls(images: DataFrame) -> DataFrame:
    """origin_url to sha256 and storage_path; of rows that share a URL the latest."""
    rank = F.row_number().over(W.partitionBy("origin_url").orderBy(F.col("created_at").desc(), "sha256"))
    return images.withColumn("_r", rank).where("_r = 1").select("origin_url", "sha256", "storage_path")


def known_hashes(images: DataFrame) -> DataFrame:
    """All stored hashes, marked duplicates among them."""
    return images.select("sha256")


def split_candidates(images: DataFrame) -> DataFrame:
    return images.where("duplicate_of is null").select("sha256", "class_label")


def duplicates_with_originals(images: DataFrame) -> DataFrame:
    """Each marked row with the class and size of what it points at."""
    original = images.select(F.col("sha256").alias("duplicate_of"), F.col("class_label").alias("original_class"), F.col("width").alias("original_width"))
    return images.where("duplicate_of is not null").select("sha256", "class_label", "duplicate_of", "duplicate_distance").join(original, "duplicate_of")
