"""Whole runs: the export, a messy corpus twice, streams, the registered queries."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gleaner.config import load
from gleaner.plans import catalog
from gleaner.plans.export import copy_tree, dataset_rows, export, fingerprint, manifest_lines
from gleaner.plans.pipeline import Runner
from gleaner.plans.store import Store, schema_report, verify_schema
from gleaner.schemas import CANDIDATE, IMAGE, TABLES
from gleaner.sources.images import read_assets
from gleaner.streaming.landing import curate_stream, rejection_windows
from tests.conftest import DATA
from tests.test_operators import image, sha
from tests.test_sources import jpeg, picture, png

#: What becomes of a file is its name: a rejection's code, or accepted.
CLASSES = {
    "kettle": ["accepted_1.png", "accepted_2.png", "accepted_3.png", "exact_duplicate.png", "near_duplicate.png", "unreadable_image.png", "truncated_image.png", "extension_mismatch.jpg", "dimensions_too_small.png", "http_error.png", "license_not_permitted.png"],
    "pan": ["unrecognised_license.png"],
}
LICENCE = {"accepted_1.png": "cc0", "license_not_permitted.png": "by-nc-4.0", "unrecognised_license.png": "rights: ask"}


@pytest.fixture
def corpus(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    large = {name: png(picture(400 + 20 * k, 300 + 10 * k, 2 * k + 1)) for k, name in enumerate(n for names in CLASSES.values() for n in names)}
    made = large | {
        "exact_duplicate.png": large["accepted_1.png"], "near_duplicate.png": png(picture(210, 155, 3)), "unreadable_image.png": b"<html>" + b"x" * 2000, "truncated_image.png": large["truncated_image.png"][:-40],
        "dimensions_too_small.png": png(picture(16, 16)) + bytes(2000), "http_error.png": None,
    }
    for n, b in made.items():
        if b is not None:
            (files / n).write_bytes(b)
    rows = [("openverse", c, f"https://h/{n}", n, "", LICENCE.get(n, "by-4.0"), None, "me", n, "{}") for c, names in CLASSES.items() for n in names]
    columns = ", ".join(CANDIDATE.split(", ")[:-1])
    candidates = spark.createDataFrame(rows, columns).withColumn("fetched_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    assets = read_assets(spark, f"file://{files}").withColumn("image_url", F.concat(F.lit("https://h/"), F.element_at(F.split("storage_path", "/"), -1)))
    return candidates, assets


def test_a_messy_corpus_twice(spark, corpus, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    runner = Runner(spark, store, load({}, source__classes=("kettle", "pan"), source__target=20, source__minimum=1))
    first = runner.execute(*corpus, f"file://{tmp_path}/out", tree=f"{tmp_path}/tree")
    rows = {r["source_id"]: r for r in store.read("images").collect()}
    kept = [f"accepted_{k}.png" for k in (1, 2, 3)]
    assert set(rows) == {*kept, "near_duplicate.png"} and all(rows[k]["split"] for k in kept)
    thumb = rows["near_duplicate.png"]
    assert (thumb["duplicate_of"], thumb["split"]) == (rows["accepted_2.png"]["sha256"], None)
    reasons = {r["source_id"]: r["reason_code"] for r in store.read("rejections").collect()}
    assert reasons == {n: n.partition(".")[0].upper() for names in CLASSES.values() for n in names if not n.startswith("accepted")}
    assert first.status == "partial" and first.metrics["persist"]["inserted"] == 4  # no pan was kept
    tree = {os.path.join(d, f) for d, _, names in os.walk(tmp_path / "tree" / "images") for f in names}
    assert len(tree) == 3 == first.export["images_copied"]

    second = runner.execute(*corpus, f"file://{tmp_path}/out", tree=f"{tmp_path}/tree")
    assert second.metrics["persist"]["inserted"] == 0 and second.metrics["split"]["changed"] == 0
    assert second.metrics["download"]["downloaded"] < first.metrics["download"]["downloaded"] and second.metrics["download"]["reused_from_store"] > 0
    assert second.export["fingerprint"] == first.export["fingerprint"] and store.read("images").count() == 4
    assert tree == {os.path.join(d, f) for d, _, names in os.walk(tmp_path / "tree" / "images") for f in names}
    assert second.metrics["split"]["eligible"] == 3 == second.metrics["split"]["train"] + second.metrics["split"]["val"] and first.metrics["persist"]["marked_duplicate"] == 1
    assert not {r["reason_code"] for r in store.read("rejections").where(F.col("run_id") == second.run_id).collect()} & {"OVER_TARGET"}
    assert {r["run_id"] for r in store.read("pipeline_runs").collect()} == {first.run_id, second.run_id}
    assert store.read("raw_records").count() == 24


def test_full_classes_are_not_asked_again(spark, corpus, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    runner = Runner(spark, store, load({}, source__classes=("kettle",), source__target=2, source__minimum=1))
    first = runner.execute(*corpus, f"file://{tmp_path}/out")
    assert first.status == "success" and store.read("images").where("duplicate_of is null").count() == 2
    second = runner.execute(*corpus, f"file://{tmp_path}/out")
    assert second.metrics["ingest"] == {"fetched": 0, "classes_at_target": 1, "sources_empty": 0} and store.read("images").where("duplicate_of is null").count() == 2


def test_failed_runs_say_so(spark, corpus, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    with pytest.raises(Exception, match="phash"):
        Runner(spark, store, load({}, source__classes=("kettle",))).execute(corpus[0], corpus[1].drop("phash"), f"file://{tmp_path}/out")
    assert [(r["status"], r["error_message"] is not None) for r in store.read("pipeline_runs").collect()] == [("failed", True)]


def _set(spark, tmp_path, n=4):
    rows = []
    for k in range(n):
        path = tmp_path / f"f{k}.bin"
        path.write_bytes(jpeg(10, 10))
        rows.append(image(sha(k), str(k), split="train" if k else "val", storage_path=str(path), attribution=None if k else "é"))
    return spark.createDataFrame(rows, IMAGE)


def test_export_and_prune(spark, tmp_path):
    df = _set(spark, tmp_path)
    out = export(df, f"file://{tmp_path}/out", "run", '{"a": 1}', f"{tmp_path}/tree")
    doc = json.loads("\n".join(r[0] for r in spark.read.text(f"{tmp_path}/out/manifest.json").collect()))
    assert doc["counts"] == {"cat": {"train": 3, "val": 1}} and doc["n_images"] == 4 and doc["schema_version"] == "1.0" and doc["licenses"] == {"CC0-1.0": 4}
    assert spark.read.parquet(f"{tmp_path}/out/dataset.parquet").count() == 4 == spark.read.option("header", True).csv(f"{tmp_path}/out/dataset.csv").count()
    items = doc["images"]
    assert [(i["label"], i["split"], i["checksum"]["value"]) for i in items] == sorted((i["label"], i["split"], i["checksum"]["value"]) for i in items) and len(items) == 4
    assert {os.path.isfile(f"{tmp_path}/tree/{i['path']}") for i in items} == {True} and all(i["path"].endswith(".jpg") for i in items)
    want = __import__("hashlib").sha256("".join(f"{r['sha256']}:{r['split']}:cat" for r in sorted(df.collect(), key=lambda r: r["sha256"])).encode()).hexdigest()[:16]
    assert doc["dataset_fingerprint"] == want == out["fingerprint"] == fingerprint(dataset_rows(df.repartition(3))).first()[0]
    moved = dataset_rows(df.withColumn("split", F.lit("val")))
    os.remove(tmp_path / "f1.bin")
    done = copy_tree(moved, f"{tmp_path}/tree")
    assert done == {"images_copied": 3, "images_missing": 1, "images_pruned": 3} and not os.path.isdir(tmp_path / "tree" / "images" / "train")
    assert export(df.limit(0), f"file://{tmp_path}/none", "run")["records"] == 0 and not os.path.exists(tmp_path / "none")


def test_streams(spark, tmp_path):
    seen = []
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        curate_stream(spark, f"{tmp_path}/landing", "id long, x string", f"{tmp_path}/checkpoint", lambda batch, k: seen.append(batch.count()))
    assert seen == [2, 2]
    lost = spark.sql("select timestamp'2026-01-01 00:03:00' occurred_at, 'select' stage, 'OVER_TARGET' reason_code union all select timestamp'2026-01-01 00:08:00', 'select', 'OVER_TARGET' union all select timestamp'2026-01-01 00:12:00', 'select', 'OVER_TARGET'")
    assert sorted(r["n"] for r in rejection_windows(lost).collect()) == [1, 2]


def _norm(frame):
    text = lambda x: "-" if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted(tuple(map(text, r)) for r in frame.astype(object).where(frame.notna(), None)[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries_equal_their_sql(spark, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    if name not in catalog.ORACLES:
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "events"):
        con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    want = con.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and _norm(got) == _norm(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_planted_violations_are_found(spark, tmp_path):
    df = _set(spark, tmp_path)
    none = spark.createDataFrame([], "x int")
    out = verify_schema(df, none, none, spark.createDataFrame([(4,)], "n_images long"))
    rows = out.collect()
    assert {r["outcome"] for r in rows} == {"PASS"} and {r["verdict"] for r in rows} == {f"all {len(rows)} checks passed"} and rows[0]["images"] == 4 == rows[0]["composition"]


def test_a_broken_store_is_told(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.init()
    tables = {t: store.read(t) for t in TABLES}
    assert schema_report(tables).first()["verdict"] == "ok"
    assert schema_report(tables | {"images": tables["images"].drop("phash")}).first()["verdict"] == "columns are missing"
    row = image("a", "1", width=0)
    assert schema_report(tables | {"images": spark.createDataFrame([row], IMAGE)}).first()["verdict"] == "rules are broken"
    row = image("a", "1", duplicate_of="b", duplicate_distance=1)
    assert schema_report(tables | {"images": spark.createDataFrame([row], IMAGE)}).first()["verdict"] == "rows without their parent"


def test_parts_of_the_manifest_are_in_order(spark, tmp_path):
    df = dataset_rows(spark.createDataFrame([image(sha(k), str(k), split=("train", "val")[k % 2], class_label="abc"[k % 3]) for k in range(200)], IMAGE))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        manifest_lines(df, {"n": 1}).write.text(f"{tmp_path}/m")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    parts = sorted(p for p in (tmp_path / "m").glob("part-*"))
    doc = json.loads("".join(p.read_text() for p in parts))
    got = [(i["label"], i["split"], i["checksum"]["value"]) for i in doc["images"]]
    assert len(parts) > 3 and got == sorted(got) and len(got) == 200
