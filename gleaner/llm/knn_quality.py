"""Quality scores by nearest-neighbour voting in a latent space.

Features of a whole text: a histogram of hashed byte trigrams (TRIGRAM_BINS) and one of hashed words' lengths, case and
repetition signs (STYLE_BINS), each as square roots of shares, so that a dot product compares distributions. Labelled
rows are reduced to LATENT dimensions by an SVD of their centred features (latent semantic analysis). Every document
is projected the same way and compared by cosine, in blocks, with all labelled vectors, exactly; the NEIGHBOURS most
similar vote with weight similarity ** SHARPNESS.

Fitting takes all labelled rows up to MAX_LABELLED, beyond that those with the smallest hash of their id: a documented
bound, so the broadcast is MAX_LABELLED * LATENT floats at most (1 MB) whatever the corpus. Labels, language, source
and id are no inputs of a score.

Defined results: null and empty texts are scored as empty ones; documents without a label are scored like others;
rows that repeat an id, in labels, count with their mean label (null labels not at all); without any label every score
is 0.5; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.texts import read

TRIGRAM_BINS = 1024
STYLE_BINS = 64
LATENT = 48
NEIGHBOURS = 24
SHARPNESS = 4
MAX_LABELLED = 5000
BLOCK = 512

_random = np.random.default_rng(11)
_TABLES = _random.integers(0, 1 << 16, (3, 256), dtype=np.uint16)
#: Byte classes: blank, lower, upper, digit, other ASCII, beyond ASCII.
_CLASS = np.array([0 if chr(b) in " \t\n\v\f\r" else 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b < 128 else 5 for b in range(256)], np.int64)


def features(text: str | None) -> np.ndarray:
    """TRIGRAM_BINS + STYLE_BINS floats."""
    out = np.zeros(TRIGRAM_BINS + STYLE_BINS, np.float32)
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if len(raw) > 2:
        bins = (_TABLES[0][raw[:-2]] ^ _TABLES[1][raw[1:-1]] ^ _TABLES[2][raw[2:]]) & (TRIGRAM_BINS - 1)
        n = np.bincount(bins, minlength=TRIGRAM_BINS)
        out[:TRIGRAM_BINS] = np.sqrt(n / n.sum())
    if len(raw):
        kinds = _CLASS[raw]
        pairs = np.bincount(kinds[:-1] * 6 + kinds[1:], minlength=36)
        out[TRIGRAM_BINS : TRIGRAM_BINS + 36] = np.sqrt(pairs / max(1, pairs.sum()))
        words = (text or "").split()
        if words:
            distinct = len(set(words)) / len(words)
            out[TRIGRAM_BINS + 36 : TRIGRAM_BINS + 38] = np.sqrt([distinct, 1 - distinct])
            lines = [x for x in (text or "").split("\n") if x]
            repeat = 1 - len(set(lines)) / len(lines)
            out[TRIGRAM_BINS + 38 : TRIGRAM_BINS + 40] = np.sqrt([repeat, 1 - repeat])
            out[TRIGRAM_BINS + 40 + min(15, int(np.log2(len(words))))] = 0.5
    return out


class Voter:
    """A fitted model: mean, projection, labelled unit vectors and their labels."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean = x.mean(axis=0)
        centred = x - self.mean
        _, _, v = np.linalg.svd(centred.T @ centred, hermitian=True)
        self.project = np.ascontiguousarray(v[: min(LATENT, len(v))].T.astype(np.float32))
        self.vectors = self._unit(centred @ self.project)
        self.labels = y.astype(np.float32)

    @classmethod
    def of(cls, arrays: dict) -> Voter:
        out = cls.__new__(cls)
        vars(out).update(arrays)
        return out

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), BLOCK):
            sims = self._unit((x[at : at + BLOCK] - self.mean) @ self.project) @ self.vectors.T
            k = min(NEIGHBOURS, sims.shape[1])
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sims, near, 1), 1e-3).astype(float) ** SHARPNESS
            out[at : at + BLOCK] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Voter | None:
    """A voter of the labelled rows that are not held out."""
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.avg("quality").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)

    def run(batches):
        for b in batches:
            rows = [features(t).tobytes() for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])

    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, label double, x binary")
    rows = rows.groupBy("doc_id").agg(F.min("x").alias("x"), F.min("label").alias("label")).toPandas().sort_values("doc_id")
    if rows.empty:
        return None
    return Voter(np.stack([np.frombuffer(x, np.float32) for x in rows["x"]]), rows["label"].to_numpy())


def scored(docs: DataFrame, voter: Voter | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    arrays = docs.sparkSession.sparkContext.broadcast(vars(voter) if voter else None)

    def run(batches):
        model = Voter.of(arrays.value) if arrays.value else None
        for b in batches:
            texts = b.column(2)
            for at in range(0, b.num_rows, BLOCK):
                part = texts.slice(at, BLOCK).to_pylist()
                x = np.stack([features(t) for t in part])
                score = model.scores(x) if model else np.full(len(part), 0.5)
                yield pa.record_batch([b.column(0).slice(at, BLOCK), b.column(1).slice(at, BLOCK), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read(spark, sf_dir, "labels")))
