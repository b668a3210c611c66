"""python -m gleaner.cli run|status|init|verify|trace ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from gleaner.config import load
from gleaner.plans import views
from gleaner.plans.pipeline import Runner
from gleaner.plans.store import Store, latest_runs, schema_report
from gleaner.schemas import CANDIDATE, TABLES
from gleaner.sources.crawl import Crawl
from gleaner.sources.images import read_assets

EXIT = {"success": 0, "partial": 2, "failed": 1}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gleaner")
    parser.add_argument("--store", default="data/store")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="curate landed candidates")
    run.add_argument("--candidates", help="Parquet of landed candidate records; without it the sources are asked")
    run.add_argument("--assets", help="Parquet of asset measures with image_url, or a folder of image files with an index.parquet of image_url and storage_path; without it the bytes are fetched")
    run.add_argument("--data", help="folder for fetched bytes, which all executors reach")
    run.add_argument("--output", default="data/output")
    run.add_argument("--tree", help="folder for the exported image tree")
    run.add_argument("--classes")
    run.add_argument("--limit", type=int, help="target per class; lowers the minimum as well")
    run.add_argument("--refetch", action="store_true")
    status = commands.add_parser("status", help="latest runs and the set's composition")
    status.add_argument("--runs", type=int, default=5)
    commands.add_parser("init", help="create the store's folders")
    commands.add_parser("verify", help="check the store's schema, rules and references")
    trace = commands.add_parser("trace", help="crawl one class and print what each round saw; the store is not touched")
    trace.add_argument("--class-label", default="cat")
    trace.add_argument("--limit", type=int, default=5)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("gleaner").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = Store(spark, args.store)
    if args.command == "init":
        store.init()
        return 0
    if args.command == "verify":
        report = schema_report({t: store.read(t) for t in TABLES})
        report.show(truncate=False)
        return 0 if report.first()["verdict"] == "ok" else 1
    if args.command == "status":
        summary = views.run_summary(store.read("pipeline_runs"), store.read("run_stage_metrics"), store.read("rejections"))
        latest_runs(summary, args.runs).show(truncate=False)
        views.dataset_composition(store.read("images")).orderBy("class_label", "split").show(truncate=False)
        return 0
    if args.command == "trace":
        cfg = load()
        title = cfg.source.categories.get(args.class_label)
        crawl = Crawl(spark.createDataFrame([(args.class_label, title, args.limit)], "class_label string, title string, cap long"), cfg.source, cfg.http, cfg.workers)
        out = crawl.records()
        for line in crawl.trace:
            print(line)
        out.kept.select("title", "license_raw", "image_url").show(truncate=False)
        out.rejections.select("reason_code", "source_id", "detail").show(truncate=False)
        return 0 if out.kept.count() else 1
    given: dict = {"refetch": args.refetch} | ({"data_dir": args.data} if args.data else {})
    if args.classes:
        given["source__classes"] = tuple(c.strip() for c in args.classes.split(","))
    cfg = load(**given)
    if args.limit is not None:
        cfg = load(**given, source__target=args.limit, source__minimum=min(args.limit, cfg.source.minimum))
    candidates = spark.read.schema(CANDIDATE).parquet(args.candidates) if args.candidates else None
    assets = spark.read.parquet(args.assets) if args.assets else None
    if assets is not None and "sha256" not in assets.columns:
        folder = args.assets.rpartition("/")[0]
        assets = assets.select("image_url", "storage_path").join(read_assets(spark, folder), "storage_path")
    report = Runner(spark, store, cfg).execute(candidates, assets, args.output, tree=args.tree)
    print(report)
    return EXIT[report.status]


if __name__ == "__main__":
    sys.exit(main())
