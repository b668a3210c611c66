"""Stages on small frames: order independence, budgets, precedence, greedy marking."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gleaner.config import Dedupe, License, Settings, Source, Split, Validation, load
from gleaner.operators import curate, neardup
from gleaner.plans import buckets
from gleaner.plans import store as st
from gleaner.plans import views
from gleaner.plans.buckets import FIRST, Buckets
from gleaner.plans.codeindex import CodeIndex
from gleaner.plans.components import components
from gleaner.schemas import IMAGE, TABLES


def sha(x):
    return hashlib.sha256(str(x).encode()).hexdigest()


def candidates(spark, sizes):
    rows = [(sha(f"{c}-{i}"), c, None) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "sha256 string, class_label string, duplicate_of string")


def split_of(df, cfg=Split()):
    return {r["sha256"]: r["split"] for r in curate.assign_split(df, cfg).collect()}


def test_split_is_exact_and_stable(spark):
    df = candidates(spark, {"cat": 60, "dog": 40, "bird": 50, "few": 3, "one": 1})
    out = curate.assign_split(df).groupBy("class_label", "split").count().collect()
    got = {(r["class_label"], r["split"]): r["count"] for r in out}
    assert got == {("cat", "train"): 48, ("cat", "val"): 12, ("dog", "train"): 32, ("dog", "val"): 8, ("bird", "train"): 40, ("bird", "val"): 10, ("few", "train"): 2, ("few", "val"): 1, ("one", "train"): 1}
    assert split_of(df) == split_of(df.orderBy(F.desc("sha256")).repartition(5))
    bucket = Split(strategy="stable_bucket")
    more = split_of(candidates(spark, {"cat": 90}), bucket)
    assert all(more[s] == v for s, v in split_of(candidates(spark, {"cat": 60}), bucket).items())


def test_duplicates_have_no_split(spark):
    df = candidates(spark, {"cat": 10}).withColumn("duplicate_of", F.when(F.col("sha256") == sha("cat-3"), sha("cat-1"))).withColumn("split", F.lit("val"))
    out = {r["sha256"]: r["split"] for r in curate.split_in_memory(df).collect()}
    assert out[sha("cat-3")] is None and all(v for s, v in out.items() if s != sha("cat-3"))


def test_selection(spark):
    df = candidates(spark, {"cat": 30, "dog": 5}).withColumns({"source": F.lit("openverse"), "source_id": F.col("sha256")})
    df = df.withColumn("duplicate_of", F.when(F.col("sha256") == sha("cat-1"), sha("cat-2")).when(F.col("sha256") == sha("dog-1"), sha("dog-2")))
    counts = spark.createDataFrame([("cat", 4)], "class_label string, n long")
    stored = spark.createDataFrame([(sha(f"cat-{i}"),) for i in (5, 6, 7, 8)], "sha256 string")
    out = curate.select_target(df, counts, stored, Source(target=10, minimum=5))
    kept = {r["sha256"] for r in out.kept.collect()}
    assert {sha(f"cat-{i}") for i in (5, 6, 7, 8)} <= kept and {sha(f"dog-{i}") for i in range(5)} <= kept
    assert out.extras["selected"].where("class_label = 'cat'").count() == 6
    assert (sha("cat-1") in kept) == (sha("cat-2") in kept)
    assert len(kept) + out.rejections.count() == 35 and {r[0] for r in out.rejections.select("reason_code").distinct().collect()} == {"OVER_TARGET"}
    again = curate.select_target(df.repartition(6), counts, stored, Source(target=10, minimum=5))
    assert kept == {r["sha256"] for r in again.kept.collect()}


REASONS = [
    ((100, "unreadable", "JPEG", ".png", 1, 1), "FILESIZE_TOO_SMALL"), ((5000, "unreadable", None, ".jpg", None, None), "UNREADABLE_IMAGE"), ((5000, "truncated", "JPEG", ".png", 400, 400), "TRUNCATED_IMAGE"),
    ((5000, None, "JPEG", ".jpg", 20000, 6000), "IMAGE_BOMB"), ((5000, None, "SVG", ".jpg", 400, 400), "UNSUPPORTED_FORMAT"), ((5000, None, "PNG", ".jpg", 16, 16), "EXTENSION_MISMATCH"),
    ((5000, None, "PNG", ".bin", 16, 16), "DIMENSIONS_TOO_SMALL"), ((5000, None, "TIFF", "tif", 9000, 70), "DIMENSIONS_TOO_LARGE"), ((5000, None, "PNG", ".PNG", 2000, 100), "ASPECT_RATIO_EXTREME"),
    ((5000, None, "JPEG", ".jpeg", 320, 240), None), ((5000, None, "JPEG", ".jpg", 9000, 7000), "DIMENSIONS_TOO_LARGE"),
]


def test_validation_precedence(spark):
    df = spark.createDataFrame([(i, *r) for i, (r, _) in enumerate(REASONS)], "i int, file_size_bytes long, status string, format string, extension string, width int, height int")
    assert [r[1] for r in df.select("i", curate.validation_reason(Validation())).orderBy("i").collect()] == [w for _, w in REASONS]


def test_exact_dedup_is_order_free(spark):
    rows = [("x", "openverse", "2"), ("x", "openverse", "1"), ("x", "wikimedia_commons", "0"), ("y", "openverse", "9")]
    df = spark.createDataFrame(rows, "sha256 string, source string, source_id string").withColumn("class_label", F.lit("cat"))
    for d in (df, df.repartition(3)):
        out = curate.exact_dedup(d, [F.col("source"), F.col("source_id")])
        assert {(r["sha256"], r["source_id"]) for r in out.kept.collect()} == {("x", "1"), ("y", "9")}
        assert out.rejections.count() == 2


def test_licence_gate(spark):
    rows = [("by-4.0", "", "u1"), ("by-nc-4.0", "me", "u2"), (None, "me", "u3"), ("cc0", None, "u4"), ("by-sa-3.0", "me", "u5")]
    df = spark.createDataFrame(rows, "license_raw string, attribution string, image_url string").withColumns({"landing_url": F.lit(""), "class_label": F.lit(" Cat "), "source": F.lit("openverse"), "source_id": F.col("image_url")})
    out = curate.normalize(df, License())
    assert {(r["license"], r["attribution"], r["class_label"]) for r in out.kept.collect()} == {("CC-BY-4.0", "Unknown author (see u1)", "cat"), ("CC0-1.0", None, "cat"), ("CC-BY-SA-3.0", "me", "cat")}
    assert {(r["source_id"], r["reason_code"]) for r in out.rejections.collect()} == {("u2", "LICENSE_NOT_PERMITTED"), ("u3", "UNRECOGNISED_LICENSE")}
    assert out.extras["placeholders"].count() == 1 and {r["metric"]: r["value"] for r in out.metrics().collect()}["kept"] == 3


# Near duplicates ----------------------------------------------------------------------------------------------------
def greedy(batch, stored, k, keep="highest_resolution"):
    """The loop over all rows: (sha, duplicate_of, distance) and supersessions."""
    index = [list(x[:3]) for x in sorted(stored, key=lambda s: s[3])]
    marks, over = {}, []
    for s, code, pixels in sorted(batch, key=lambda x: (-x[2], x[0])):
        best = None
        for i, (t, c, _) in enumerate(index):
            d = (code ^ c).bit_count()
            if t != s and d <= k and (best is None or d < best[0]):
                best = (d, i)
        if best is None:
            index.append([s, code, pixels])
            marks[s] = (None, None)
        elif keep == "highest_resolution" and pixels > index[best[1]][2]:
            over.append((index[best[1]][0], s, best[0]))
            index[best[1]] = [s, code, pixels]
            marks[s] = (None, None)
        else:
            marks[s] = (index[best[1]][0], best[0])
    return marks, over


def cloud(r, n):
    out, code = [], r.getrandbits(64)
    for i in range(n):
        if r.random() < 0.15:
            code = r.getrandbits(64)
        for _ in range(r.randint(0, 4)):
            code ^= 1 << r.randrange(64)
        out.append((sha((n, i, r.random())), code, r.randint(1, 12) * 100))
    return out


def frame(spark, rows, stored=False):
    data = [(s, f"{c:016x}", p, 1, "openverse", s, "cat", *([x[0]] if (x := rest) else [])) for s, c, p, *rest in rows]
    return spark.createDataFrame(data, "sha256 string, phash string, width int, height int, source string, source_id string, class_label string" + (", pos long" if stored else ""))


@pytest.mark.parametrize("seed, keep", [(1, "highest_resolution"), (2, "highest_resolution"), (3, "first_seen"), (4, "highest_resolution"), (5, "highest_resolution"), (7, "first_seen")])
def test_marking_equals_the_loop(spark, seed, keep):
    r = random.Random(seed)
    rows = cloud(r, 60)
    stored = [(*x, i) for i, x in enumerate(r.sample(rows, 12))] if seed > 1 else []
    if seed > 3:  # stored copies of codes, smaller and larger than the batch's, and rows that are stored themselves
        stored += [(sha((seed, i)), c ^ (i % 3), p * r.choice([1, 2, 3]) // 2, 12 + i) for i, (_, c, p) in enumerate(r.sample(rows, 25))]
    batch = [x for x in rows if r.random() < 0.9 or x[0] not in {s[0] for s in stored}]
    marks, over = greedy(batch, stored, 5, keep)
    out = neardup.mark(frame(spark, batch), frame(spark, stored, True) if stored else None, Dedupe(keep=keep))
    assert {x["sha256"]: (x["duplicate_of"], x["duplicate_distance"]) for x in out.kept.collect()} == marks
    assert sorted(map(tuple, out.extras["supersessions"].collect())) == sorted(over)
    assert out.rejections.count() == sum(v[0] is not None for v in marks.values())


def test_same_codes_are_not_paired(spark):
    rows = [(sha(i), 7, 100 + i % 3) for i in range(300)]
    marks, _ = greedy(rows, [], 5)
    out = neardup.mark(frame(spark, rows), None)
    assert {x["sha256"]: (x["duplicate_of"], x["duplicate_distance"]) for x in out.kept.collect()} == marks
    assert neardup.hamming_codes(spark.createDataFrame([(7,)] * 50, "code long"), 5).count() == 0


@pytest.mark.parametrize("k", [0, 1, 5, 18])
def test_hamming_pairs(spark, k):
    r = random.Random(k)
    codes = [c for _, c, _ in cloud(r, 60)]
    codes += codes[:3]
    df = spark.createDataFrame([(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)], "id long, code long")
    got = {tuple(x) for x in neardup.hamming_pairs(df, "id", "code", k).collect()}
    assert got == {(i, j, d) for i in range(len(codes)) for j in range(i + 1, len(codes)) if (d := (codes[i] ^ codes[j]).bit_count()) <= k}


@pytest.mark.parametrize("k", [0, 3, 5, 9])
def test_crowded_keys_lose_no_pair(spark, monkeypatch, k):
    monkeypatch.setattr(neardup, "CROWD", 6)
    r = random.Random(k)
    flat = [r.getrandbits(18) for _ in range(250)]  # three quarters of the bits are shared by all
    codes = sorted({*flat, *(c for _, c, _ in cloud(r, 120))})
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
    got = {(x["a"] % (1 << 64), x["b"] % (1 << 64), x["d"]) for x in neardup.hamming_codes(df, k).collect()}
    want = {(a, b, d) for i, a in enumerate(codes) for b in codes[i + 1 :] if (d := (a ^ b).bit_count()) <= k}
    assert {(min(a, b), max(a, b), d) for a, b, d in got} == want


def test_unhashed_and_disabled(spark):
    df = frame(spark, [(sha(1), 1, 10), (sha(2), 1, 10)])
    assert neardup.mark(df, None, Dedupe(enable=False)).kept.where("duplicate_of is not null").count() == 0
    assert neardup.mark(df.withColumn("phash", F.lit(None).cast("string")), None).kept.where("duplicate_of is null").count() == 2


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Store --------------------------------------------------------------------------------------------------------------
def image(s, source_id, **more):
    base = {"sha256": s, "class_label": "cat", "source": "openverse", "source_id": source_id, "origin_url": f"u/{s}", "license": "CC0-1.0", "storage_path": f"/p/{s}", "format": "JPEG", "width": 10, "height": 10, "file_size_bytes": 2000, "split": None}
    return tuple((base | more).get(c.split()[0]) for c in IMAGE.split(", "))


def test_upsert(spark):
    have = spark.createDataFrame([image("a", "1", split="val", license="PDM-1.0", last_seen_run_id="r1"), image("b", "2")], IMAGE)
    batch = spark.createDataFrame([image("a", "1", split="train"), image("c", "2"), image("d", "4"), image("e", "4"), image("d", "4")], IMAGE)
    out = st.upsert(have, batch, "r2", [F.col("sha256"), F.col("source_id")])
    rows = {r["sha256"]: r for r in out["images"].collect()}
    assert set(rows) == {"a", "b", "d"}
    assert (rows["a"]["license"], rows["a"]["split"], rows["a"]["last_seen_run_id"], rows["b"]["last_seen_run_id"]) == ("PDM-1.0", "train", "r2", None)
    assert {r["metric"]: r["value"] for r in out["counters"].collect()} == {"inserted": 1, "already_known": 2, "conflicted": 2}


def test_snapshots(spark, tmp_path):
    store = st.Store(spark, f"file://{tmp_path}/store")
    store.init()
    store.init()
    assert store.read("images").count() == 0 and store.version("images") is None
    store.publish("images", spark.createDataFrame([image("a", "1")], IMAGE))
    store.publish("images", store.read("images").union(spark.createDataFrame([image("b", "2")], IMAGE)))
    assert store.version("images") == 1 and store.read("images").count() == 2
    for bad in ([image("a", "1"), image("a", "2")], [image("a", "1"), image("b", "1")], [image("a", "1", license=None)], [image("a", "1", width=0)], [image("a", "1", duplicate_of="a", duplicate_distance=1)], [image("a", "1", duplicate_of="z")], [image("a", "1", split="test")]):
        with pytest.raises(ValueError):
            store.publish("images", spark.createDataFrame(bad, IMAGE))
    assert store.version("images") == 1 and store.read("images").count() == 2


def test_marks_and_splits(spark):
    df = spark.createDataFrame([image("a", "1", split="train"), image("b", "2", split="train"), image("c", "3", split="val")], IMAGE)
    marks = spark.createDataFrame([("b", "a", 3), ("c", "absent", 1), ("a", "a", 0)], "sha256 string, duplicate_of string, distance int")
    rows = {r["sha256"]: (r["duplicate_of"], r["duplicate_distance"], r["split"]) for r in st.mark_duplicates(df, marks).collect()}
    assert rows == {"a": (None, None, "train"), "b": ("a", 3, None), "c": (None, None, "val")}
    new = spark.createDataFrame([("a", "val"), ("b", "val")], "sha256 string, split string")
    assert {r["sha256"]: r["split"] for r in st.set_splits(st.mark_duplicates(df, marks), new).collect()} == {"a": "val", "b": None, "c": "val"}


def test_deleted_runs(spark):
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string")
    df = spark.createDataFrame([image("a", "1", first_seen_run_id="r1", last_seen_run_id="r2")], IMAGE)
    out = st.delete_runs({"pipeline_runs": runs, "images": df}, spark.createDataFrame([("r1",)], "run_id string"))
    row = out["images"].first()
    assert out["pipeline_runs"].count() == 1 and row["first_seen_run_id"] is None and row["last_seen_run_id"] == "r2"


def test_summary_of_a_run(spark):
    runs = spark.sql("select 'r' run_id, 'success' status, timestamp'2026-01-01 00:00:00' started_at, timestamp'2026-01-01 00:00:12.25' finished_at, cast(null as string) error_message union all select 'idle', 'running', timestamp'2026-01-01 00:00:00', null, null")
    metrics = spark.createDataFrame([("r", "ingest", "fetched", 12), ("r", "persist", "kept", 9), ("r", "dedupe", "near_duplicates", 3)], "run_id string, stage string, metric string, value long")
    lost = spark.createDataFrame([("r", "HTTP_ERROR"), ("r", "NEAR_DUPLICATE"), ("r", "TOO_LARGE"), ("r", "OVER_TARGET")], "run_id string, reason_code string")
    out = {r["run_id"]: r for r in views.run_summary(runs, metrics, lost).collect()}
    r = out["r"]
    assert (r["duration_seconds"], r["rejected"], r["trimmed_over_target"], r["rejection_rate_pct"], r["near_duplicates_marked"]) == (12.3, 3, 1, 25.0, 3)
    assert out["idle"]["rejection_rate_pct"] is None and out["idle"]["fetched"] == 0


def test_settings():
    cfg = load({"GLEANER_SPLIT_TRAIN_PERCENT": "70", "GLEANER_SOURCE_CLASSES": "a, b", "GLEANER_LICENSE_FORBIDDEN": "nc", "GLEANER_HTTP_RESPECT_ROBOTS": "no"}, source__target=5)
    assert (cfg.split.train_percent, cfg.source.classes, cfg.license.forbidden, cfg.http.respect_robots, cfg.source.target) == (70, ("a", "b"), ("NC",), False, 5)
    assert load({}) == Settings()
    for bad in ({"split__train_percent": 99}, {"license__forbidden": ("XX",)}, {"dedupe__max_distance": 65}):
        with pytest.raises(ValueError):
            load({}, **bad)


# Buckets and the code index -------------------------------------------------------------------------------------------
def test_a_merge_rewrites_only_its_buckets(spark, tmp_path):
    table = Buckets(spark, f"file://{tmp_path}/t", "k long, x string", ["k"])
    assert table.version() is None and table.read().count() == 0
    table.merge(spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("x")))
    files = lambda: {str(f) for f in tmp_path.rglob("*.parquet")}
    before = files()
    table.merge(spark.createDataFrame([(7, "b"), (1000, "c")], "k long, x string"))
    new = files() - before
    mine = {r[0] for r in spark.createDataFrame([(7,), (1000,)], "k long").select(table.of(FIRST)).collect()}
    assert before <= files() and {f.partition("_b=")[2].partition("/")[0] for f in new} == set(map(str, mine)) and len(new) == len(mine)
    rows = {r["k"]: r["x"] for r in table.read().collect()}
    assert rows == {k: "a" for k in range(500)} | {7: "b", 1000: "c"} and table.manifest()["rows"] == 501 and table.version() == 1
    assert table.merge(spark.createDataFrame([], "k long, x string")) == 1
    assert table.vacuum() == len(mine) and {r["k"]: r["x"] for r in table.read().collect()} == rows


def test_buckets_grow_and_fold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 4)
    monkeypatch.setattr(buckets, "MERGE_AT", 3)
    table = Buckets(spark, f"file://{tmp_path}/t", "k long", ["k"])
    for at in range(0, 200, 25):
        table.add(spark.range(at, at + 25).toDF("k"))
    assert sorted(r[0] for r in table.read().collect()) == list(range(200))
    assert table.manifest()["buckets"] >= 32 and max(map(len, table.manifest()["held"].values())) < 3
    table.vacuum()
    assert table.read().count() == 200


def test_a_failed_check_changes_nothing(spark, tmp_path):
    store = st.Store(spark, f"file://{tmp_path}/store")
    store.publish("images", spark.createDataFrame([image("a", "1"), image("b", "2")], IMAGE))
    for bad in ([image("c", "2")], [image("a", "1", width=-1)], [image("c", "3"), image("c", "4")]):
        with pytest.raises(ValueError):
            store.merge_images(spark.createDataFrame(bad, IMAGE))
    assert store.version("images") == 0 and {r["sha256"] for r in store.read("images").collect()} == {"a", "b"}
    store.merge_images(spark.createDataFrame([image("a", "1", split="val"), image("c", "3")], IMAGE))
    assert {r["sha256"]: r["split"] for r in store.read("images").collect()} == {"a": "val", "b": None, "c": None}


def test_unknown_words_are_refused(spark, tmp_path):
    store = st.Store(spark, f"file://{tmp_path}/store")
    row = ("r", "dedupe", "openverse", "cat", "1", "u", "NEAR_DUPLICATE", "", None)
    store.append("rejections", spark.createDataFrame([row], TABLES["rejections"]))
    for bad in (("r", "polish", *row[2:]), (*row[:6], "TOO_UGLY", *row[7:]), ("r", "dedupe", "elsewhere", *row[3:])):
        with pytest.raises(ValueError):
            store.append("rejections", spark.createDataFrame([row, bad], TABLES["rejections"]))
    assert store.read("rejections").count() == 1


def test_codes_in_batches_equal_all_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neardup, "CROWD", 8)
    r = random.Random(8)
    codes = list({c for _, c, _ in cloud(r, 200)} | {r.getrandbits(14) for _ in range(80)})
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
    index = CodeIndex(spark, f"file://{tmp_path}/index", 5)
    parts = df.randomSplit([1.0, 3.0, 2.0], 4)
    assert [index.add(p) for p in (*parts, parts[0])] == [*(p.count() for p in parts), 0]
    want = {tuple(x) for x in neardup.hamming_codes(df, 5).collect()}
    assert {tuple(x) for x in index.pairs().collect()} == want
    some = {x["code"] for x in parts[0].collect()}
    assert {tuple(x) for x in index.pairs(parts[0]).collect()} == {p for p in want if p[0] in some or p[1] in some}


def test_keys_of_codes_are_not_broadcast(spark):
    """A code has some 40 keys, and as many second ones for each, while Spark takes them for as few as the codes."""
    codes = spark.range(300).select(F.xxhash64("id").alias("code"))
    rows = neardup.filed(codes, 16)
    hot = [rows.select("part", "value", F.col("code").alias(c)) for c in "xy"]
    for pairs in (neardup.meeting(rows, rows, 16), neardup._second_keys(*hot, 16)):
        plan = pairs._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_second_keys_lose_no_pair(spark):
    codes = [(k * 0x9E3779B97F4A7C15 >> 7) % 2**40 for k in range(1, 120)] + [5, 6, 7, 2**63 - 1]
    for distance in (1, 4, 16):
        rows = neardup.filed(spark.createDataFrame([(c,) for c in codes], "code long"), distance)
        found = {tuple(r) for r in neardup.meeting(rows, rows, distance, crowd=1).collect()}
        near = {(a, b, (a ^ b).bit_count()) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= distance}
        assert found == near
