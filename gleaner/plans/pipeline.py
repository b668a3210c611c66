"""A run from landed candidates to the export, each stage published before the next."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.operators import curate, neardup
from gleaner.plans import views
from gleaner.plans.codeindex import CodeIndex
from gleaner.plans.export import export
from gleaner.plans.storage import materialize
from gleaner.plans.store import Store, mark_duplicates, set_splits, upsert
from gleaner.schemas import CANDIDATE, RUN, SOURCES, columns
from gleaner.sources.api import per_class_limit
from gleaner.sources.http import download, existing_paths
from gleaner.sources.images import read_assets
from gleaner.sources.ingest import from_sources

#: How far the clocks of driver and file system may be apart.
CLOCKS = timedelta(minutes=10)


@dataclass
class Report:
    run_id: str
    status: str
    metrics: dict = field(default_factory=dict)
    rejections: dict = field(default_factory=dict)
    export: dict = field(default_factory=dict)


class Runner:
    """candidates: the CANDIDATE columns, or None to ask the sources; assets: image_url, sha256, file_size_bytes, storage_path, extension, format, width, height, status and phash of what was fetched, or None to fetch what candidates name into data_dir/images (a path or URI that all executors reach)."""

    def __init__(self, spark: SparkSession, store: Store, cfg: Settings = Settings()):
        self.spark, self.store, self.cfg = spark, store, cfg

    def _audit(self, report: Report, stage: str, metrics: dict, rejections: DataFrame | None = None) -> None:
        report.metrics[stage] = metrics
        rows = [(report.run_id, stage, k, int(v)) for k, v in metrics.items()]
        if rows:
            self.store.append("run_stage_metrics", self.spark.createDataFrame(rows, "run_id string, stage string, metric string, value long"))
        if rejections is not None:
            full = rejections.withColumns({"run_id": F.lit(report.run_id), "occurred_at": F.current_timestamp()})
            full = materialize(full, "rejections")
            self.store.append("rejections", full)
            for r in full.groupBy("reason_code").count().collect():
                key = f"{stage}/{r['reason_code']}"
                report.rejections[key] = report.rejections.get(key, 0) + r["count"]

    def execute(self, candidates: DataFrame | None, assets: DataFrame | None, out: str, ingest_rejections: DataFrame | None = None, tree: str | None = None) -> Report:
        self.store.init()
        run_id, started = str(uuid.uuid4()), datetime.now(UTC).replace(tzinfo=None)
        report = Report(run_id, "running")
        self._run_row(report, started)
        try:
            self._stages(report, candidates, assets, out, ingest_rejections, tree)
        except Exception as e:
            report.status = "failed"
            self._run_row(report, started, f"{type(e).__name__}: {e}"[:500])
            raise
        self._run_row(report, started)
        return report

    def _run_row(self, report: Report, started, error: str | None = None) -> None:
        ended = None if report.status == "running" else datetime.now(UTC).replace(tzinfo=None)
        row = self.spark.createDataFrame([(report.run_id, started, ended, report.status, "manual", self.cfg.snapshot(), None, error, None)], RUN)
        rest = self.store.read("pipeline_runs").where(F.col("run_id") != report.run_id)
        self.store.publish("pipeline_runs", rest.select(*columns(RUN)).unionByName(row))

    def _downloaded(self, pending: DataFrame) -> tuple[DataFrame, DataFrame]:
        """pending with what its bytes measure, and rejections. Bytes are stored by their hash and measured where they lie; what was written before this run is not looked at."""
        root, since = f"{self.cfg.data_dir.rstrip('/')}/images", datetime.now(UTC) - CLOCKS
        done = download(pending, root, self.cfg.http, self.cfg.workers)
        kept = materialize(done.kept, "fetched-bytes")
        if kept.isEmpty():
            empty = kept.withColumns({c: F.lit(None).cast(t) for c, t in (("extension", "string"), ("format", "string"), ("width", "int"), ("height", "int"), ("status", "string"), ("phash", "string"))})
            return empty, done.rejections
        measured = read_assets(self.spark, root, since).drop("storage_path", "file_size_bytes").dropDuplicates(["sha256"])
        return kept.join(measured, "sha256"), done.rejections

    def _stages(self, report: Report, candidates: DataFrame | None, assets: DataFrame | None, out: str, ingest_rejections, tree) -> None:
        cfg, store, run_id = self.cfg, self.store, report.run_id
        images = materialize(store.read("images"), "images")
        classes = self.spark.createDataFrame([(c,) for c in cfg.source.classes], "class_label string")
        gap = curate.ingest_gap(classes, views.class_counts(images), cfg.source)
        gap = materialize(gap, "gap")  # a row a class
        if candidates is None:
            fetched, ingest_rejections = from_sources(gap, cfg)[:2]
        else:  # landed ones are limited like those that sources are asked for
            fetched = materialize(per_class_limit(candidates, gap, ["fetched_at", "source_id", "image_url"]).select(columns(CANDIDATE)), "fetched")
        store.append("raw_records", fetched.withColumn("run_id", F.lit(run_id)))
        full = gap.where("needed = 0").count()
        needed = gap.agg(F.sum("needed")).first()[0] or 0
        asked = self.spark.createDataFrame([(x, needed) for x in SOURCES], "source string, needed long")
        empty = views.empty_sources(asked, fetched).count()
        self._audit(report, "ingest", {"fetched": fetched.count(), "classes_at_target": full, "sources_empty": empty}, ingest_rejections)

        if not cfg.refetch:  # what is stored under a URL is not fetched again
            urls = fetched.select(F.col("image_url").alias("origin_url")).distinct()
            stored = images.join(urls, "origin_url", "left_semi").where("storage_path is not null")
            reused, pending = curate.reuse(fetched, stored, materialize(existing_paths(stored), "present"))
            held = images.select("sha256", "file_size_bytes", "format", "width", "height", "phash")
            reused = reused.join(held, "sha256").withColumns({"status": F.lit(None).cast("string"), "extension": F.regexp_extract("storage_path", r"(\.[^./]+)$", 1), "reused": F.lit(True)})
        else:
            reused, pending = None, fetched
        if assets is None:
            got, lost = self._downloaded(pending)
        else:
            got = pending.join(assets, "image_url")
            failed = pending.join(assets.select("image_url"), "image_url", "left_anti")
            lost = curate.rejection(failed, "download", F.lit("HTTP_ERROR"), F.lit("no bytes were fetched"))
        got = got.withColumn("reused", F.lit(False))
        have = got if reused is None else got.unionByName(reused)
        have = materialize(have, "assets")
        exact = curate.exact_dedup(have, [~F.col("reused"), F.col("source"), F.col("source_id")], F.col("reused"))
        lost = materialize(lost, "not-downloaded")
        kept = materialize(exact.kept, "downloaded")
        again = materialize(exact.rejections, "copies")
        known = kept.join(images.select("sha256"), "sha256", "left_semi").count()
        metrics = {"downloaded": have.where("not reused").count(), "reused_from_store": have.where("reused").count(), "failed": lost.count()}
        self._audit(report, "download", metrics | {"already_in_store": known, "exact_duplicates_in_run": again.count()}, lost.unionByName(again))

        valid = curate.validate(kept, cfg.validation)
        checked = materialize(valid.kept, "validated")
        self._audit(report, "validate", {"validated": checked.count()}, valid.rejections)

        near = None
        if cfg.dedupe.enable:  # the stored index files new codes only
            found = checked.where("phash is not null").select(neardup.as_code("phash").alias("code"))
            index = CodeIndex(self.spark, f"{store.root}/phash_index", cfg.dedupe.max_distance)
            index.add(found)
            near = materialize(index.pairs(found), "near")
        marked = neardup.mark(checked, neardup.index_rows(images), cfg.dedupe, near)
        rows = materialize(marked.kept, "deduped")
        over = materialize(marked.extras["supersessions"], "supersessions")
        self._audit(report, "dedupe", {"unique": rows.where("duplicate_of is null").count(), "near_duplicates": rows.where("duplicate_of is not null").count(), "superseded_existing": over.count()}, marked.rejections)

        normal = curate.normalize(rows, cfg.license)
        curated = materialize(normal.kept, "normalized")
        self._audit(report, "normalize", {"normalised": curated.count(), "attribution_placeholders": curated.where("attribution like 'Unknown author (see %'").count()}, normal.rejections)

        chosen = curate.select_target(curated, views.class_counts(images), images.select("sha256"), cfg.source, cfg.split)
        batch = materialize(chosen.kept, "selected")
        self._audit(report, "select", {"selected": batch.where("duplicate_of is null").count(), "trimmed_over_target": chosen.rejections.count()}, chosen.rejections)

        batch = batch.withColumns({"source_url": F.col("landing_url"), "origin_url": F.col("image_url"), "retrieved_at": F.col("fetched_at"), "split": F.lit(None).cast("string")})
        done = upsert(images, batch, run_id, [F.col("class_label"), F.col("sha256"), F.col("source"), F.col("source_id")])
        counters = {r["metric"]: r["value"] for r in done["counters"].collect()}
        marks = batch.where("duplicate_of is not null").select("sha256", "duplicate_of", F.col("duplicate_distance").alias("distance"))
        now = mark_duplicates(done["images"], marks)
        now = mark_duplicates(now, over.select(F.col("old").alias("sha256"), F.col("new").alias("duplicate_of"), "distance"))
        touched = batch.select("sha256").unionByName(over.select(F.col("old").alias("sha256"))).distinct()
        store.merge_images(now.join(touched, "sha256", "left_semi"))
        now = store.read("images")
        marked = marks.join(now.select("sha256", F.col("duplicate_of").alias("_of")), "sha256").where("duplicate_of = _of").count()
        taken = over.join(now.select(F.col("sha256").alias("old"), F.col("duplicate_of").alias("_of")), "old").where("new = _of").count()
        more = {"kept": counters["inserted"] + counters["already_known"], "marked_duplicate": marked, "superseded": taken, "supersessions_skipped": over.count() - taken}
        self._audit(report, "persist", counters | more)

        images = store.read("images")
        changed = materialize(curate.resplit(images, cfg.split), "splits")
        n = changed.count()
        if n:
            store.merge_images(set_splits(images.join(changed.select("sha256"), "sha256", "left_semi"), changed))
        images = store.read("images")
        live = images.where("duplicate_of is null")
        self._audit(report, "split", {"eligible": live.count(), "changed": n, "train": live.where("split = 'train'").count(), "val": live.where("split = 'val'").count()})

        report.export = export(images, out, run_id, cfg.snapshot(), tree)
        self._audit(report, "export", {"exported": report.export["records"]})
        gate = views.quality_gate(classes, views.class_counts(images), cfg.source, report.export.get("images_missing", 0)).first()
        report.status = gate["status"]
