"""Hard negatives, fill-in-middle and nearest neighbours against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import fill_in_middle, hard_negatives, ivfpq, vectors
from tests.conftest import DATA
from tests.llm.helpers import empty_docs, odd_docs, with_clashes

EMBEDDINGS = "vec_id long, embedding array<float>, label int"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(text)
    return doc_id, n, "psm", len(prefix), len(middle), sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(text)


def _fim_docs(spark):
    marked = [(20 + k, f"some <{m}> text {k}") for k, m in enumerate("PSMX")]
    blanks = [(30 + k, " " * k + "a\t\tb" + "\n" * (k % 3) + ("é \U0001f600 " * k)) for k in range(40)]
    return odd_docs(spark).select("doc_id", "text").unionAll(spark.createDataFrame(marked + blanks, "doc_id long, text string"))


@pytest.mark.parametrize("chunk", [1, 3, 64, 1 << 20])
def test_fill_in_middle_equals_plain_cuts(spark, chunk):
    docs = _fim_docs(spark) if chunk > 1 else _fim_docs(spark).where("length(text) < 200 or text is null")
    got = fill_in_middle.transformed(docs, chunk).drop("output").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_fim(r["doc_id"], r["text"])) for r in docs.collect())


def test_fill_in_middle_outputs_hold_all_pieces(spark):
    rows = fill_in_middle.transformed(_fim_docs(spark), 50).collect()
    assert {"plain", "spm", "psm"} == {r["form"] for r in rows}
    for r in rows:
        assert hashlib.sha256(r["output"].encode()).hexdigest() == r["output_sha256"]
        assert hashlib.sha256(fill_in_middle.restored(r["output"].encode(), r["form"])).hexdigest() == r["restored_sha256"]


def test_fill_in_middle_over_a_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = sorted(repr(plain_fim(r["doc_id"], r["text"])) for r in docs.collect())
    assert sorted(map(repr, map(tuple, fill_in_middle.op12(spark, DATA).collect()))) == want
    assert sorted(map(repr, map(tuple, fill_in_middle.transformed(docs.repartition(5), 500).drop("output").collect()))) == want


def test_fill_in_middle_of_clashing_and_empty_tables(spark):
    assert fill_in_middle.transformed(empty_docs(spark)).collect() == []
    docs = with_clashes(odd_docs(spark))
    assert sorted(map(repr, fill_in_middle.transformed(docs, 40).collect())) == sorted(map(repr, fill_in_middle.transformed(odd_docs(spark)).collect()))


def _vectors(n: int, seed: int, groups: int = 0, width: int = 12):
    """Rows with labels; with groups a third of the rows lies closely around one of so many centres, and some are equal."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width)).astype(np.float32)
    for k in range(groups):
        near = slice(k * n // (3 * groups), (k + 1) * n // (3 * groups))
        x[near] = r.normal(size=width) + 0.02 * r.normal(size=x[near].shape)
    if groups:
        x[n // 2 : n // 2 + n // 8] = x[n // 2]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, r.integers(0, 6, n), strict=True))]


ODD = [
    (None, [1.0] * 12, 1), (10000, None, 1), (10050, [None, *[1.0] * 11], 1), (10100, [math.nan, *[1.0] * 11], 2), (10150, [math.inf] * 12, 2), (10200, [0.5] * 12, None), (10250, [0.0] * 12, 3),
    (10300, [], 3), (10350, [0.25, -0.5], 4), (10400, [3e7, *[0.0] * 11], 4), (10450, [-1.0] * 12, 5), (10450, [-1.0] * 12, 5),
]


def plain_hard_negatives(rows):
    held = {}
    for i, v, c in rows:
        if i is None or v is None or c is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(max(min(256 * x, 2.0**28), -(2.0**28))) for x in map(float, v)]
        held[i] = ([*v, *[0] * (12 - len(v))], (c + 1) % 10 if i % 7 == 0 else c)
    out = set()
    for a, (v, c) in held.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, (w, _) in held.items() if i != a)
        for s, p in [x for x in scored if held[x[1]][1] == c][:5]:
            good = [x for x in scored if held[x[1]][1] != c and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(good)}
    return out


@pytest.mark.parametrize(("groups", "odd"), [(0, False), (3, False), (2, True)])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, groups, odd):
    monkeypatch.setattr(vectors, "LEAST_ROWS", 100)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 150)
    monkeypatch.setattr(vectors, "QUERIES_EACH", 9)
    monkeypatch.setattr(hard_negatives, "BUCKET", 16)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 300)
    rows = _vectors(900, groups, groups) + ODD * odd
    table = spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit(1) for c in ("id", "v", "block", "leaf", "score")})
    ids = hard_negatives.integer_rows(table.repartition(6))
    ids = ids.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    got = [tuple(r) for r in hard_negatives.mined(ids, ids.where("id % 50 = 0")).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_hard_negatives(rows)


def test_hard_negatives_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    held = [(i, v, c) for i, v, c in rows]
    got = {tuple(r) for r in hard_negatives.op11(spark, DATA).collect()}
    x = np.array([[math.floor(256 * float(y)) for y in v] for _, v, _ in held], np.int64)
    ids, labels = np.array([r[0] for r in held]), np.array([(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in held])
    want = set()
    for a in np.flatnonzero(ids % 50 == 0):
        s = x @ x[a]
        order = [j for j in np.lexsort((ids, -s)) if j != a]
        for p in [j for j in order if labels[j] == labels[a]][:5]:
            good = [j for j in order if labels[j] != labels[a] and 50 * s[p] <= 100 * s[j] <= 95 * s[p]][:3]
            want |= {(int(ids[a]), int(ids[p]), k + 1, int(ids[j]), int(s[p]), int(s[j])) for k, j in enumerate(good)}
    assert got == want


def test_a_tree_bounds_all_scores():
    r = np.random.default_rng(1)
    for x in (r.integers(-200, 200, (400, 6)).astype(float), np.ones((50, 6)), np.repeat(r.integers(-9, 9, (5, 6)), 30, axis=0).astype(float)):
        square = float((x**2).sum(axis=1).max())
        points = hard_negatives.augmented(x, square)
        for measured in (True, False):
            tree = hard_negatives.VantageTree(points, 20, measured)
            leaf = tree.route(points)
            assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(x)))
            q = r.integers(-300, 300, (30, 6)).astype(float)
            least, most = tree.scores(q, square)
            s = q @ x.T
            assert (s <= most[:, leaf]).all() and (s >= least[:, leaf]).all()


def plain_neighbours(rows, k):
    """Of each query the ids by score, and all scores."""
    held = {i: np.array([*v, *[0.0] * (12 - len(v))], np.float32).astype(float) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = np.array(sorted(held))
    x = np.stack([held[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = (x * held[q]).sum(axis=1)
        keep = ids != q
        out[int(q)] = [(int(i), float(t)) for i, t in zip(*vectors.best(ids[keep], s[keep], k), strict=True)]
    return out


@pytest.mark.parametrize(("groups", "odd", "n"), [(0, False, 3000), (3, True, 3000), (2, True, 30)])
def test_neighbours_are_found(spark, monkeypatch, groups, odd, n):
    monkeypatch.setattr(vectors, "LEAST_ROWS", 100)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 300)
    monkeypatch.setattr(vectors, "QUERIES_EACH", 40)
    rows = _vectors(n, groups, groups) + ODD * odd
    found = ivfpq.usable(spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit(1) for c in ("id", "v", "block", "cell", "score")}).repartition(5))
    got: dict = {}
    for r in sorted(ivfpq.search(found.where("id % 20 = 0"), ivfpq.index(found)).collect()):
        assert r["rank"] == len(got.setdefault(r["query_id"], [])) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = plain_neighbours(rows, 20)
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in best}) for q, best in want.items()) / sum(map(len, want.values()))
    assert hit >= 0.9
    held = {i: [*v, *[0.0] * (12 - len(v))] for i, v, _ in rows if v}
    for q, best in got.items():
        assert len(best) == len(want[q]) and best == sorted(best, key=lambda x: (-x[1], x[0])) and q not in {i for i, _ in best}
        exact = [float((np.array(held[q], np.float32).astype(float) * np.array(held[i], np.float32).astype(float)).sum()) for i, _ in best]
        assert np.allclose([s for _, s in best], exact, rtol=1e-12, atol=1e-12)


def test_recall_on_a_table(spark):
    t = spark.read.parquet(f"{DATA}/embeddings.parquet").toArrow().sort_by("vec_id")
    ids, x = t.column("vec_id").to_numpy(), vectors.matrix(t.column("embedding").combine_chunks())
    got = {(r["query_id"], r["vec_id"]) for r in ivfpq.op13(spark, DATA).collect()}
    want = set()
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(axis=1)
        s[q] = -np.inf
        want |= {(int(ids[q]), int(i)) for i in vectors.best(ids, s, 20)[0]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_cells_are_packed_into_blocks():
    first, parts = ivfpq.packed_cells(np.array([5, 5, 0, 25, 3, 9, 1]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 5, 5] and parts.tolist() == [1, 1, 1, 3, 1, 1, 1]


def test_no_rows(spark):
    for rows in ([], [(1, None, 1), (50, [float("nan")], 1)]):
        table = spark.createDataFrame(rows, EMBEDDINGS)
        ids = hard_negatives.integer_rows(table)
        assert hard_negatives.mined(ids, ids).collect() == []
        assert ivfpq.search(ivfpq.usable(table), ivfpq.index(ivfpq.usable(table))).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0], 1)], EMBEDDINGS)
    assert ivfpq.search(ivfpq.usable(one), ivfpq.index(ivfpq.usable(one))).collect() == []
    ids = hard_negatives.integer_rows(one)
    assert hard_negatives.mined(ids, ids).collect() == []


def test_op13_recall_on_other_rows(spark):
    """Queries that lie apart from a table of tight clusters, and components whose squares overflow in single precision."""
    random = np.random.default_rng(1)
    n, width = 3000, 16
    x = random.normal(size=(150, width))[random.integers(0, 150, n)] + 0.02 * random.normal(size=(n, width))
    x[::20] = random.normal(size=(n // 20, width))
    for v in (x, x * 1e25):
        rows = ivfpq.usable(spark.createDataFrame([(i, v[i].tolist(), 0) for i in range(n)], EMBEDDINGS))
        queries = rows.where("id % 20 = 0")
        got = {(r["query_id"], r["vec_id"]) for r in ivfpq.search(queries, ivfpq.index(rows, queries=queries)).collect()}
        scores = v[::20] @ v.T
        scores[np.arange(n // 20), np.arange(0, n, 20)] = -np.inf
        true = {(20 * q, int(i)) for q, s in enumerate(scores) for i in np.argsort(-s)[:20]}
        assert len(got & true) >= 0.95 * len(true)
