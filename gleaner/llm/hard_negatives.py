"""Hard negatives: for each anchor and positive, the nearest rows of other labels inside a window of scores.

A score is an integer inner product of vectors whose components are floor(256 * x). Inner products become distances by
one more coordinate: with M the largest norm, a row x gets sqrt(M^2 - |x|^2) and a query q gets 0, so all rows lie on a
sphere and |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. A window of scores is an annulus around q', and the nearest row in it is
the one with the highest score.

A vantage-point tree indexes the augmented rows: a node has a vantage point and splits its rows at the median distance to
it. The upper levels are fitted on a sample of SAMPLE rows by hash of the id (documented bound; the driver holds it), and
every row is routed through them to a leaf; a leaf with more than BLOCK_ROWS rows is split by hash. The lower levels are
built by the task that reads a block, down to BUCKET rows, with the distances that its rows really have. The triangle
inequality bounds a leaf's scores by the distances on its path. A path's bounds only narrow, so leaves in the order of
their bound come as a priority queue over nodes would yield them: the traversal goes nearest first, skips what lies inside
the annulus's inner radius, and ends where the bound falls below the k-th best found.

A search is two rounds. A query first visits the one leaf that can hold its nearest rows; the k-th score it finds there
is the bound with which it visits all other leaves that can still hold a better row, as rows of an equi-join by block.
First each anchor's positives are searched (same label), then for all its windows at once the negatives (other labels).
Searches are exact whatever the sample. In many dimensions without clusters bounds exclude little, and a search costs
what comparing the queries with all rows in blocks costs.

Of rows with equal vector and label the first POSITIVES + 1 ids are indexed: ties go to smaller ids, so no other can be
in a result. All anchors are searched for, equal ones too.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part; of rows that share
an id the one with the smallest vector, then label, counts; shorter vectors count as padded with zeros; components beyond
2^20 in size count as 2^20, so that a score fits a long; an anchor without positives, and a positive without negatives,
give no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import vectors
from gleaner.llm.texts import read
from gleaner.plans.storage import materialize

POSITIVES, NEGATIVES = 5, 3
#: Percent of a positive's score that a negative has at least and at most.
LEAST, MOST = 50, 95
SAMPLE = 1 << 14
BUCKET = 512
_LARGEST = float(1 << 28)
_OPEN = 2**62


class VantageTree:
    """Vantage points, and for each leaf its path: places of vantage points, least and most distance to them."""

    def __init__(self, points: np.ndarray, most: int, measured: bool):
        """points: augmented rows. measured: bounds are the distances that the points have; else those that any routed row has."""
        self.vantage, self.nodes, self.paths, self.leaves = [], [], [], []
        todo = [(np.arange(len(points)), (), -1, 0)]
        random = np.random.default_rng(len(points))
        while todo:
            rows, path, above, side = todo.pop()
            inside, radius = None, 0.0
            if len(rows) > most:
                at = points[rows[random.integers(len(rows))]]
                d = np.sqrt(((points[rows] - at) ** 2).sum(axis=1))
                radius = float(np.median(d))
                if not (d > radius).any():  # over half are equally far
                    radius = float(d[d < radius].max()) if (d < radius).any() else -1.0
                inside = d <= radius
            split = inside is not None and inside.any() and not inside.all()
            if above >= 0:
                self.nodes[above][2 + side] = len(self.nodes) if split else ~len(self.leaves)
            if not split:
                self.leaves.append(rows)
                self.paths.append(path)
                continue
            self.nodes.append([len(self.vantage), radius, 0, 0])
            self.vantage.append(at)
            for k, some in enumerate((inside, ~inside)):
                low, high = (float(d[some].min()), float(d[some].max())) if measured else ((0.0, radius), (radius, np.inf))[k]
                todo.append((rows[some], (*path, (len(self.vantage) - 1, low, high)), len(self.nodes) - 1, k))
        self.vantage = np.array(self.vantage).reshape(len(self.vantage), points.shape[1])
        depth = max(map(len, self.paths))
        self.on = np.zeros((len(self.leaves), depth), int)
        self.low, self.high = np.zeros(self.on.shape), np.full(self.on.shape, np.inf)
        for k, path in enumerate(self.paths):
            for j, (v, low, high) in enumerate(path):
                self.on[k, j], self.low[k, j], self.high[k, j] = v, low, high

    def route(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each augmented row."""
        leaf = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))] if self.nodes else []
        while todo:
            node, rows = todo.pop()
            v, radius, inner, outer = self.nodes[node]
            inside = ((points[rows] - self.vantage[v]) ** 2).sum(axis=1) <= radius * radius
            for to, some in ((inner, rows[inside]), (outer, rows[~inside])):
                if to < 0:
                    leaf[some] = ~to
                elif len(some):
                    todo.append((to, some))
        return leaf

    def scores(self, queries: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query and leaf, a lower and an upper bound of the scores of its rows. square: M^2."""
        total = (queries**2).sum(axis=1)[:, None] + square
        if not len(self.vantage):
            return np.full((len(queries), 1), -np.inf), np.full((len(queries), 1), np.inf)
        d = np.sqrt(np.maximum(total - 2 * queries @ self.vantage[:, :-1].T, 0))
        # A distance is off by the root of the rounding error of its square at most.
        off = 1e-6 * np.sqrt(total)
        least, most = np.zeros((len(queries), len(self.leaves))), np.full((len(queries), len(self.leaves)), np.inf)
        for j in range(self.on.shape[1]):
            there = d[:, self.on[:, j]]
            np.maximum(least, np.maximum(there - self.high[:, j], self.low[:, j] - there), out=least)
            np.minimum(most, there + self.high[:, j], out=most)
        near, far = np.maximum(least - 2 * off, 0), most + 2 * off
        return np.floor((total - far**2) / 2) - 1, np.ceil((total - near**2) / 2) + 1


def augmented(x: np.ndarray, square: float) -> np.ndarray:
    return np.column_stack((x, np.sqrt(np.maximum(square - (x**2).sum(axis=1), 0))))


def products(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as integers; exact: they are below 2^53, so floats are exact."""
    return (rows @ query).astype(np.int64) if exact else (rows.astype(np.int64) * query.astype(np.int64)).sum(axis=1)


class Block:
    """The rows of a block and the lower levels of the tree over them."""

    def __init__(self, table: pa.Table, square: float):
        x = vectors.matrix(table.column("v").combine_chunks())
        self.square = square
        self.exact = bool(x.size == 0 or np.abs(x).max() ** 2 * x.shape[1] < 2**53)
        self.tree = VantageTree(augmented(x, square), BUCKET, measured=True)
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        self.leaves = [(x[rows], ids[rows], labels[rows]) for rows in self.tree.leaves]

    def nearest(self, bounds, query: np.ndarray, own: int, label: int, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list:
        """For each window [low, high], ids and scores of the k best rows, nearest first. bounds: of the leaves."""
        least, most = bounds
        exact = self.exact and np.abs(query).max(initial=0) ** 2 * len(query) < 2**53
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        need, top = low.copy(), high.max()
        for leaf in np.argsort(-most, kind="stable").tolist():
            floor = need.min()
            if most[leaf] < floor:
                break
            if least[leaf] > top:  # nearer than the inner radius
                continue
            x, ids, labels = self.leaves[leaf]
            s = products(x, query, exact)
            at = np.flatnonzero((s >= floor) & (s <= top))
            at = at[((labels[at] == label) == same) & (ids[at] != own)] if len(at) else at
            if not len(at):
                continue
            s, ids = s[at], ids[at]
            for w in range(len(low)):
                inside = (s >= need[w]) & (s <= high[w])
                if inside.any():
                    mine = vectors.best(np.concatenate((found[w][0], ids[inside])), np.concatenate((found[w][1], s[inside])), k)
                    found[w] = mine
                    if len(mine[0]) == k:
                        need[w] = mine[1][-1]
        return found


class Index(NamedTuple):
    """rows: id, label, v (integers as doubles) and leaf; tree: the upper levels; square: the largest squared norm; width: components of a vector; n: rows before equal ones were left out."""

    rows: DataFrame
    tree: VantageTree | None
    square: float
    width: int
    n: int


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """id, label and v of the rows that take part; components are floor(256 * x)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & vectors.finite(F.col("v")))
    v = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * 256, F.lit(_LARGEST)), F.lit(-_LARGEST))).cast("double"))
    return vectors.one_each(rows.select("id", v.alias("v"), "label"))


def index(rows: DataFrame, keep: int) -> Index:
    """rows: id, label and v. keep: how many of rows with equal vector and label are indexed."""
    spark = rows.sparkSession
    dot = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, square, narrow, wide = rows.agg(F.count("*"), F.max(dot), F.min(F.size("v")), F.max(F.size("v"))).first()
    if not n:
        return Index(rows, None, 0.0, 0, 0)
    if narrow != wide:
        rows = rows.withColumn("v", vectors.padded(F.col("v"), wide))
    few = vectors.few_equal(rows, ["v", "label"], keep)
    part = min(1 << 30, -(-SAMPLE * (1 << 30) // n))
    sample = few.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < part).select("id", "v").toArrow().sort_by("id")
    points = augmented(vectors.matrix(sample.column("v").combine_chunks()), square).reshape(sample.num_rows, -1)
    tree = VantageTree(points, -(-max(sample.num_rows, 1) // vectors.n_blocks(spark, n)), measured=False)
    held = spark.sparkContext.broadcast(tree)

    def run(batches):
        for b in batches:
            if b.num_rows:
                leaf = held.value.route(augmented(vectors.matrix(b.column("v")), square))
                yield pa.record_batch([*b.columns, pa.array(leaf)], names=[*b.schema.names, "leaf"])

    return Index(materialize(few.select("id", "label", "v").mapInArrow(run, "id long, label long, v array<double>, leaf long"), "leaves"), tree, square, wide, n)


def _parts(rows: DataFrame) -> DataFrame:
    """leaf and parts, the number of blocks of a leaf; a row per leaf, of which there are n / BLOCK_ROWS or a few thousand."""
    return rows.groupBy("leaf").agg(F.ceil(F.count("*") / vectors.BLOCK_ROWS).cast("long").alias("parts"))


_QUERY = "id long, label long, v array<double>, low array<long>, high array<long>"


def _reach(batch, found: VantageTree, square: float):
    """For each query and leaf whether the leaf can hold a row of the query's windows, and the bounds of its scores."""
    least, most = found.scores(vectors.matrix(batch.column("v")), square)
    low = np.array([min(x) for x in batch.column("low").to_pylist()], np.int64).reshape(-1, 1)
    high = np.array([max(x) for x in batch.column("high").to_pylist()], np.int64).reshape(-1, 1)
    return (most >= low) & (least <= high), least, np.minimum(most, high.astype(float))


def _with_home(queries: DataFrame, found: Index) -> DataFrame:
    """queries and home, the leaf whose bound inside the windows is the highest."""
    held, square = queries.sparkSession.sparkContext.broadcast(found.tree), found.square

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                may, least, most = _reach(part, held.value, square)
                rank = np.where(may, most + np.maximum(least, -1e18) * 1e-6, -np.inf)
                yield pa.record_batch([*part.columns, pa.array(rank.argmax(axis=1))], names=[*part.schema.names, "home"])

    return queries.select("id", "label", "v", "low", "high").mapInArrow(run, f"{_QUERY}, home long")


def _others(queries: DataFrame, found: Index) -> DataFrame:
    """queries (with home), once for each other leaf that can hold a row of their windows."""
    held, square = queries.sparkSession.sparkContext.broadcast(found.tree), found.square

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                may, _, _ = _reach(part, held.value, square)
                may[np.arange(part.num_rows), part.column("home").to_numpy()] = False
                query, leaf = np.nonzero(may)
                for s in range(0, len(query), 4096):
                    q = pa.array(query[s : s + 4096])
                    yield pa.record_batch([*(part.column(c).take(q) for c in ("id", "label", "v", "low", "high")), pa.array(leaf[s : s + 4096])], names=["id", "label", "v", "low", "high", "leaf"])

    return queries.mapInArrow(run, f"{_QUERY}, leaf long")


def _seen(visits: DataFrame, found: Index, same: bool, k: int, n_queries: int) -> DataFrame:
    """visits: queries with a leaf. id, part (the window's place), ids and scores: the best of each visit."""
    square = found.square
    # A row for each leaf, of which there are n / BLOCK_ROWS or as many as partitions.
    parts = F.broadcast(found.rows.groupBy("leaf").agg(F.ceil(F.count("*") / vectors.BLOCK_ROWS).cast("long").alias("parts")))
    first = F.col("leaf") * (1 << 20)
    rows = found.rows.join(parts, "leaf").withColumn("block", first + F.pmod(F.xxhash64("id"), F.col("parts")))
    to = visits.join(parts, "leaf").withColumn("block", F.explode(F.sequence(first, first + F.col("parts") - 1)))

    def answer(block: Block, batch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            x = vectors.matrix(part.column("v"))
            least, most = block.tree.scores(x, square)
            own, label, low, high = (part.column(c).to_pylist() for c in ("id", "label", "low", "high"))
            out = [[], [], [], []]
            for j in range(len(own)):
                best = block.nearest((least[j], most[j]), x[j], own[j], label[j], same, np.array(low[j]), np.array(high[j]), k)
                for w, (ids, scores) in enumerate(best):
                    if len(ids):
                        for col, value in zip(out, (own[j], w, ids, scores), strict=True):
                            col.append(value)
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["id", "part", "ids", "scores"])

    schema = "id long, part int, ids array<long>, scores array<long>"
    return vectors.visit(rows.select("block", "id", "label", "v"), to.select("block", "id", "label", "v", "low", "high"), n_queries, lambda t: Block(t, square), answer, schema)


def search(queries: DataFrame, found: Index, same: bool, k: int, n_queries: int) -> DataFrame:
    """queries: id, label, v, low and high (arrays, a window for each place). id, part, rank, found and score of the k best rows of the same label, or of others, in each window."""
    homed = materialize(_with_home(queries, found), "queries")
    first = materialize(_seen(homed.withColumnRenamed("home", "leaf"), found, same, k, n_queries), "near")
    # The k-th best of the first leaf raises a window's low end: other leaves have to hold something as good.
    reached = first.where(F.size("scores") >= k).groupBy("id", "part").agg(F.max(F.element_at("scores", k)).alias("to"))
    reached = reached.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("part", "to"))).alias("reached"))  # a few windows
    low = F.transform("low", lambda x, j: F.greatest(x, F.coalesce(F.try_element_at("reached", j), x)))
    again = homed.join(reached, "id", "left").select("id", "label", "v", low.alias("low"), "high", "home")
    return vectors.merged(first.unionAll(_seen(_others(again, found), found, same, k, n_queries)), k, "long")


def mined(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """rows and anchors: id, label and v (integers as doubles). anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    found = index(rows, max(positives + 1, negatives))
    if not found.n:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return rows.sparkSession.createDataFrame([], schema)
    ends = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", -_OPEN), ("high", _OPEN))]
    anchors = materialize(anchors.select("id", "label", vectors.padded(F.col("v"), found.width).alias("v"), *ends), "anchors")
    n = anchors.count()
    near = materialize(search(anchors, found, True, positives, n), "positives")
    windows = near.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("x"))  # positives rows of an anchor at most
    low = F.expr(f"transform(x.score, p -> (p * {least} + pmod(-p * {least}, 100)) div 100)")
    high = F.expr(f"transform(x.score, p -> (p * {most} - pmod(p * {most}, 100)) div 100)")
    hard = search(anchors.drop("low", "high").join(windows, "id").select("id", "label", "v", low.alias("low"), high.alias("high")), found, False, negatives, n)
    named = near.select("id", (F.col("rank") - 1).alias("part"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(named, ["id", "part"]).select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11(spark, sf_dir: str) -> DataFrame:
    rows = integer_rows(read(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mined(rows, rows.where("id % 50 = 0"))


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.other_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""
