"""Approximate nearest neighbours by inner product: an inverted file with product-quantised residuals.

Coarse centroids (k-means) deal rows into cells. What a centroid leaves of a row is cut into SUB-dimensional pieces, each
replaced by the nearest of CODES codewords: a byte a piece. A query's distance to a row is asymmetric: the product with
the cell's centroid plus, for each piece, an entry of the query's table for the row's byte, so no row is decoded. The
best by these sums are compared exactly, in double precision on original vectors.

Centroids and codewords are fitted on TRAIN rows at most, those with the smallest hashes of their ids (a documented
bound, held by the driver); all rows are indexed. How many cells a query probes and how many rows of a block are compared
exactly is measured, not set: for CALIBRATE of the queries that will be asked (rows, if none are given), those with the
smallest hashes of their ids, the true neighbours are found in a pass over all rows; as many cells are probed as hold a
share of TARGET of them, and as many rows are compared (RERANK at least) as a share of TARGET of them have before them by
their sums. So a table without clusters probes most of its cells, one with clusters few, and a dense cluster, whose rows
codewords can't tell apart, is compared row by row. Queries that lie otherwise than the rows do are measured as they lie.

Cells and codes take rows in single precision, scaled by the power of two that brings the largest component under 1, so
that squares neither overflow nor vanish; scores and comparisons are of the rows as they are.

Cells are packed into blocks of bounded size, neighbours along the centroids' main axis together; a cell with more rows
than a block is split by hash, and its probes go to all its parts. Blocks and queries meet as vectors.visit() deals them.
Of equal vectors the first NEIGHBOURS + 1 ids are indexed: ties go to smaller ids, so no other can be in a result.

Defined results: rows with a null id, a null, empty or zero vector, or a null or non-finite component take no part; of rows
that share an id the one with the smallest vector counts; shorter vectors count as padded with zeros; other columns are
ignored; a query without candidates gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import vectors
from gleaner.llm.texts import read
from gleaner.plans.storage import materialize

NEIGHBOURS = 20
TRAIN = 1 << 15
MAX_CELLS = 4096
SUB, CODES = 4, 256
RERANK = 80
CALIBRATE, TARGET = 64, 0.98
ROUNDS = 8
_BATCH = 128


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, in blocks."""
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *((x[s : s + 4096] @ centres.T - half).argmax(axis=1) for s in range(0, len(x), 4096))])


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most k centres; an empty one is put on a row of the largest cell."""
    random = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[random.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        cell = nearest(x, centres)
        n = np.bincount(cell, minlength=k)
        order = np.argsort(cell, kind="stable")
        full = np.flatnonzero(n)
        centres[full] = np.add.reduceat(x[order], (np.cumsum(n) - n)[full], axis=0) / n[full, None]
        members = order[np.cumsum(n)[n.argmax()] - n.max() :][: n.max()]
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[random.choice(members, len(empty))]
    return centres


class Quantiser(NamedTuple):
    """centres (float32, a row a cell) and words (pieces x codewords x SUB)."""

    centres: np.ndarray
    words: np.ndarray

    def pieces(self, x: np.ndarray) -> np.ndarray:
        """Rows cut into pieces, padded with zeros."""
        whole = len(self.words) * SUB
        return np.pad(x, ((0, 0), (0, whole - x.shape[1]))).reshape(len(x), -1, SUB)

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell and the bytes of each row."""
        cell = nearest(x, self.centres)
        left = self.pieces(x - self.centres[cell])
        return cell, np.stack([nearest(left[:, m], w) for m, w in enumerate(self.words)], axis=1).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """pieces x queries x codewords: the products of a query's pieces and all codewords."""
        return np.matmul(self.pieces(queries).transpose(1, 0, 2), self.words.transpose(0, 2, 1))


    def sums(self, queries: np.ndarray, cells: np.ndarray, cell: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Asymmetric products of queries and rows. cells: numbers of cells; cell: each row's place among them; code: its bytes."""
        out = (queries @ self.centres[cells].T)[:, cell]
        for m, table in enumerate(self.tables(queries)):
            out += table[:, code[:, m]]
        return out


def scaled(column, scale: float) -> np.ndarray:
    """Vectors as they are coded."""
    return (vectors.matrix(column) * scale).astype(np.float32)


def code_bytes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def fit(x: np.ndarray, cells: int) -> Quantiser:
    centres = k_means(x, cells, 3)
    axis = np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)[2][0]
    centres = centres[np.argsort(centres @ axis, kind="stable")]
    n_pieces = -(-x.shape[1] // SUB)
    left = np.pad(x - centres[nearest(x, centres)], ((0, 0), (0, n_pieces * SUB - x.shape[1]))).reshape(len(x), n_pieces, SUB)
    words = [k_means(np.ascontiguousarray(left[:, m]), CODES, m) for m in range(n_pieces)]
    return Quantiser(centres, np.stack(words))


class Index(NamedTuple):
    """rows: id, v, cell, code and block; quantiser; first and parts (of each cell: its first block, and over how many it is split); probes: cells to probe; rerank: rows of a block to compare exactly; width: components of a vector; n: rows; scale: what vectors are multiplied by before they are coded."""

    rows: DataFrame
    quantiser: Quantiser | None
    first: np.ndarray
    parts: np.ndarray
    probes: int
    rerank: int
    width: int
    n: int
    scale: float = 1.0


def usable(embeddings: DataFrame) -> DataFrame:
    """id and v of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & vectors.finite(F.col("v")))
    return vectors.one_each(rows.where(F.exists("v", lambda x: x != 0)))


def packed_cells(counts: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its first block and over how many blocks it is split; blocks hold target rows or so, and a cell that is split shares its blocks with no other."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, held = 0, 0
    for k, n in enumerate(counts.tolist()):
        parts[k] = max(-(-n // target), 1)
        if held and held + n > target:
            block, held = block + 1, 0
        first[k] = block
        held += n
        if parts[k] > 1:
            block, held = block + int(parts[k]), 0
    return first, parts


def index(rows: DataFrame, k: int = NEIGHBOURS, queries: DataFrame | None = None) -> Index:
    """rows: id and v, as usable() gives them. k: neighbours that will be asked for. queries: id and v of those that will be asked."""
    spark = rows.sparkSession
    n, narrow, wide, top = rows.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if not n:
        return Index(rows, None, np.zeros(0), np.zeros(0), 0, 0, 0, 0)
    scale = 2.0 ** min(-math.frexp(top)[1], 1000)
    if narrow != wide:
        rows = rows.withColumn("v", vectors.padded(F.col("v"), wide))
    few = vectors.few_equal(rows, ["v"], k + 1)
    share = min(1 << 30, -(-TRAIN * (1 << 30) // n))
    sample = few.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).select("id", "v").toArrow().sort_by("id")
    x = scaled(sample.column("v").combine_chunks(), scale)
    quantiser = fit(x, min(MAX_CELLS, max(1, round(2 * n**0.5))))
    held = spark.sparkContext.broadcast(quantiser)

    def run(batches):
        for b in batches:
            if b.num_rows:
                cell, code = held.value.codes(scaled(b.column("v"), scale))
                code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(code.shape[1]), len(code), [None, pa.py_buffer(np.ascontiguousarray(code))])
                yield pa.record_batch([*b.columns, pa.array(cell), code.cast(pa.binary())], names=["id", "v", "cell", "code"])

    coded = materialize(few.select("id", "v").mapInArrow(run, "id long, v array<double>, cell long, code binary"), "codes")
    counts = np.zeros(len(quantiser.centres), np.int64)
    for cell, m in coded.groupBy("cell").count().collect():  # MAX_CELLS rows at most
        counts[cell] = m
    first, parts = packed_cells(counts, min(vectors.BLOCK_ROWS, -(-n // vectors.n_blocks(spark, n))))
    queries = few if queries is None else queries
    asked = queries.select("id", vectors.padded(F.col("v"), wide).alias("v")).orderBy(F.xxhash64("id"), "id").limit(CALIBRATE).toArrow()
    if not asked.num_rows:
        return Index(coded, quantiser, first, parts, 1, RERANK, wide, n, scale)
    probes, rerank = _calibrated(coded, quantiser, asked.column("id").to_numpy(), vectors.matrix(asked.column("v").combine_chunks()), k, scale)
    return Index(coded, quantiser, first, parts, probes, rerank, wide, n, scale)


def _calibrated(coded: DataFrame, quantiser: Quantiser, ids: np.ndarray, queries: np.ndarray, k: int, scale: float) -> tuple[int, int]:
    """How many cells hold a share of TARGET of the true neighbours of the queries, and how many rows a share of TARGET has before it by the sums."""

    def run(batches):
        found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        for b in batches:
            theirs, scores = b.column("id").to_numpy(), queries @ vectors.matrix(b.column("v")).T if b.num_rows else None
            for j in range(len(ids) if b.num_rows else 0):
                at = np.argpartition(-scores[j], min(k, len(theirs) - 1))[: k + 1]
                at = at[theirs[at] != ids[j]]
                found[j] = vectors.best(np.concatenate((found[j][0], theirs[at])), np.concatenate((found[j][1], scores[j, at])), k)
        arrays = [np.arange(len(ids)), np.zeros(len(ids), np.int32), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))]
        yield pa.record_batch([pa.array(x) for x in arrays], names=["id", "part", "ids", "scores"])

    best = coded.select("id", "v").mapInArrow(run, "id long, part int, ids array<long>, scores array<double>")
    true = vectors.merged(best.where(F.size("ids") > 0), k, "double").select(F.col("id").alias("query"), F.col("found").alias("id"))
    rows = coded.select("id", "cell", "code").join(F.broadcast(true), "id").select("query", "cell", "code").toArrow().sort_by("query")  # CALIBRATE * k rows
    if not rows.num_rows:
        return 1, RERANK
    q, query, cell = (queries * scale).astype(np.float32), rows.column("query").to_numpy(), rows.column("cell").to_numpy()
    order = np.argsort(np.argsort(-(q @ quantiser.centres.T), axis=1, kind="stable"), axis=1)
    mine = quantiser.sums(q, np.arange(len(quantiser.centres)), cell, code_bytes(rows.column("code")))[query, np.arange(len(query))]
    held = [np.sort(mine[query == j]) for j in range(len(q))]

    def before(batches):
        n = [np.zeros(len(h), np.int64) for h in held]
        for b in batches:
            cells, place = np.unique(b.column("cell").to_numpy(), return_inverse=True)
            sums = quantiser.sums(q, cells, place, code_bytes(b.column("code"))) if b.num_rows else np.zeros((len(q), 0))
            for j, h in enumerate(held):
                n[j] += b.num_rows - np.searchsorted(np.sort(sums[j]), h - 1e-6)
        yield pa.record_batch([pa.array(np.arange(sum(map(len, n)))), pa.array(np.concatenate(n))], names=["at", "n"])

    ranks = coded.select("cell", "code").mapInArrow(before, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow().column("n").to_numpy()
    share = lambda x: int(np.sort(x)[min(int(np.ceil(TARGET * len(x))), len(x) - 1)])
    return share(order[query, cell]) + 1, max(RERANK, share(ranks))


class Block:
    """The rows of a block."""

    def __init__(self, table: pa.Table, quantiser: Quantiser, rerank: int, scale: float):
        self.quantiser, self.scale = quantiser, scale
        self.x = vectors.matrix(table.column("v").combine_chunks())
        self.ids = table.column("id").to_numpy()
        self.code = code_bytes(table.column("code"))
        self.cells, self.cell = np.unique(table.column("cell").to_numpy(), return_inverse=True)
        self.rerank = min(rerank, len(self.ids))

    def search(self, queries: np.ndarray, own: np.ndarray, probed: list, k: int) -> list:
        """ids and scores of the k best found of each query."""
        sums = self.quantiser.sums((queries * self.scale).astype(np.float32), self.cells, self.cell, self.code)
        sums[~np.array([np.isin(self.cells, p) for p in probed])[:, self.cell]] = -np.inf
        sums[own[:, None] == self.ids] = -np.inf
        at = np.argpartition(-sums, self.rerank - 1, axis=1)[:, : self.rerank]
        exact = (self.x[at] * queries[:, None, :]).sum(axis=2)
        there = np.isfinite(np.take_along_axis(sums, at, axis=1))
        return [vectors.best(self.ids[a[t]], s[t], k) for a, s, t in zip(at, exact, there, strict=True)]


def search(queries: DataFrame, found: Index, k: int = NEIGHBOURS) -> DataFrame:
    """queries: id and v. query_id, rank, vec_id and score of the k best found of each."""
    spark = queries.sparkSession
    if not found.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = materialize(queries.select("id", vectors.padded(F.col("v"), found.width).alias("v")), "queries")
    held = spark.sparkContext.broadcast((found.quantiser, found.first, found.parts))
    probes, rerank, scale = found.probes, found.rerank, found.scale

    def probed(batches):
        quantiser, first, parts = held.value
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                near = scaled(part.column("v"), scale) @ quantiser.centres.T
                cells = np.sort(np.argpartition(-near, min(probes, near.shape[1]) - 1, axis=1)[:, :probes], axis=1)
                which, block, mine = [], [], []
                for j, c in enumerate(cells):
                    to = np.repeat(first[c], parts[c]) + np.concatenate([np.arange(p) for p in parts[c]])
                    c = np.repeat(c, parts[c])
                    starts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
                    which += [j] * len(starts)
                    block += to[starts].tolist()
                    mine += np.split(c, starts[1:])
                take = pa.array(which, pa.int64())
                yield pa.record_batch([part.column("id").take(take), part.column("v").take(take), pa.array(block, pa.int64()), pa.array(mine, pa.list_(pa.int64()))], names=["id", "v", "block", "cells"])

    visits = queries.mapInArrow(probed, "id long, v array<double>, block long, cells array<long>")

    def dealt(batches):
        _, first, parts = held.value
        for b in batches:
            cell = b.column("cell").to_numpy()
            block = first[cell] + b.column("h").to_numpy() % parts[cell]
            yield pa.record_batch([*(b.column(c) for c in ("id", "v", "cell", "code")), pa.array(block)], names=["id", "v", "cell", "code", "block"])

    h = F.shiftrightunsigned(F.xxhash64("id"), 1)
    rows = found.rows.select("id", "v", "cell", "code", h.alias("h")).mapInArrow(dealt, "id long, v array<double>, cell long, code binary, block long")

    def answer(block: Block, batch) -> Iterator[pa.RecordBatch]:
        step = max(1, min(_BATCH, (32 << 20) // (block.rerank * block.x.shape[1] * 8), (64 << 20) // (4 * len(block.ids))))
        for s in range(0, batch.num_rows, step):
            part = batch.slice(s, step)
            best = block.search(vectors.matrix(part.column("v")), part.column("id").to_numpy(), part.column("cells").to_pylist(), k)
            some = [j for j, b in enumerate(best) if len(b[0])]
            yield pa.record_batch(
                [part.column("id").take(pa.array(some, pa.int64())), pa.array(np.zeros(len(some), np.int32)), pa.array([best[j][0] for j in some], pa.list_(pa.int64())), pa.array([best[j][1] for j in some], pa.list_(pa.float64()))],
                names=["id", "part", "ids", "scores"],
            )

    seen = vectors.visit(rows, visits, queries.count(), lambda t: Block(t, held.value[0], rerank, scale), answer, "id long, part int, ids array<long>, scores array<double>")
    return vectors.merged(seen, k, "double").select(F.col("id").alias("query_id"), "rank", F.col("found").alias("vec_id"), "score")


def op13(spark, sf_dir: str) -> DataFrame:
    rows = usable(read(spark, sf_dir, "embeddings"))
    queries = rows.where("id % 20 = 0")
    return search(queries, index(rows, queries=queries))
