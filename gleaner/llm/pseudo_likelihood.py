"""Language-model scores by masked pseudo-likelihood.

A bidirectional window network, trained in numpy, predicts every token from the SIDE tokens on either side, the token
itself masked; a document's score is the sum of its tokens' conditional log-probabilities.

Words. All words of the corpus are counted. The OWN most frequent ones have an id each; every other word has one of RARE
shared ids by its hash, and within that id its probability is its share of the id's count:
    P(word | context) = P(id | context) * count(word) / count(id)
so each word of the corpus has a probability of its own and they sum to 1. The counts are a table that grows with the
corpus. Only words with at least one in COMMON of all tokens, of which there are COMMON at most, are broadcast with their
counts; the rest, which by that rule can't be hot, are joined by hash. A word that the counts lack counts as one.

An id is two digits of base ROOT: the network predicts the first from the context and the second from the context and
the first, so its probabilities over ids sum to 1 and a token costs 2 * ROOT outputs.

Training covers every token of every document once, in ROUNDS rounds of shards of about SHARD tokens. What stands in a
shard, and in which order, follows from the documents' hashes, so neither the layout of the input nor the number of
tasks changes the network. Each shard trains a copy (Adagrad, mini-batches) from the network of the round before; the
copies are averaged by their number of tokens, in the order of shards. They travel as BLOCK-sized stretches of
parameters, which are summed by stretch as they stream through a shuffle; the driver receives one network of 0.3 MB.
The copies that are gathered, and the counts, grow with the input.

Defined results: null, empty and blank texts have 0 tokens, log_prob 0 and mean_log_prob null; repeated rows score
alike; places beyond a text's ends are a token of their own; an empty corpus leaves the initial network; other columns
are ignored. Retried tasks give the same copy. Scores are rounded to six digits, as sums of doubles depend on their order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.hashes import Codes, coded, coded_parts, codes  # noqa: F401 (the tests take Codes and codes from here)
from gleaner.llm.texts import read, row_key
from gleaner.plans.storage import materialize

ROOT = 32
VOCAB = ROOT * ROOT
RARE = 64
OWN = VOCAB - RARE
PAD = VOCAB
COMMON = 1 << 18
SIDE = 2
DIM = 16
ROUNDS = 4
SHARD = 1 << 20
RATE = 0.05
MINIBATCH = 4096
BLOCK = 512
#: Scores are computed with parameters that are multiples of it: 36 bits after the point in a product leave 17 before it.
GRID = 2.0**-18
#: Tokens that are counted or trained on at once.
TOKENS = 1 << 20
_OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]
_SHAPES = {"embed": (len(_OFFSETS), VOCAB + 1, DIM), "out": (DIM, 2 * ROOT), "bias": (2 * ROOT,), "second": (ROOT, ROOT)}


def start() -> dict[str, np.ndarray]:
    random = np.random.default_rng(5)
    return {name: (random.normal(0, 0.1, shape) if name in ("embed", "out") else np.zeros(shape)).astype(np.float32) for name, shape in _SHAPES.items()}


def pack(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[name].ravel() for name in _SHAPES])


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def framed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, apart and framed by SIDE pads; places of tokens; the text of each token."""
    pad = np.full(SIDE, PAD)
    parts = [pad]
    for ids in texts:
        parts += [ids, pad]
    ids = np.concatenate(parts).astype(np.int64)
    return ids, np.flatnonzero(ids != PAD), np.repeat(np.arange(len(texts)), [len(x) for x in texts])


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def forward(net: dict, ids: np.ndarray, at: np.ndarray):
    """Context vectors, probabilities of the first digit, and of the second given the first."""
    context = net["embed"][0][ids[at + _OFFSETS[0]]]
    for k, o in enumerate(_OFFSETS[1:], 1):
        context += net["embed"][k][ids[at + o]]
    z = (context @ net["out"]).astype(np.float32, copy=False)
    z += net["bias"]
    return context, _softmax(np.ascontiguousarray(z[:, :ROOT])), _softmax(z[:, ROOT:] + net["second"][ids[at] // ROOT])


def log_probs(net: dict, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    net = net | {name: np.round(net[name].astype(np.float64) / GRID) * GRID for name in ("embed", "out")}
    out = np.empty(len(at))
    for k in range(0, len(at), MINIBATCH):
        part = at[k : k + MINIBATCH]
        _, p, q = forward(net, ids, part)
        row, token = np.arange(len(part)), ids[part]
        out[k : k + MINIBATCH] = np.log(p[row, token // ROOT]) + np.log(q[row, token % ROOT])
    return out


class Trainer:
    def __init__(self, net: dict[str, np.ndarray]):
        self.net = {k: v.copy() for k, v in net.items()}
        self.squares = {k: np.full(v.shape, 1e-4, np.float32) for k, v in net.items()}
        self.tokens = 0

    def _step(self, name: str, gradient: np.ndarray) -> None:
        self.squares[name] += gradient * gradient
        self.net[name] -= RATE * gradient / np.sqrt(self.squares[name])

    def batch(self, ids: np.ndarray, at: np.ndarray) -> None:
        context, p, q = forward(self.net, ids, at)
        row, token, n = np.arange(len(at)), ids[at], np.float32(len(at))
        p[row, token // ROOT] -= 1
        q[row, token % ROOT] -= 1
        dz = np.concatenate((p, q), axis=1) / n
        back = dz @ self.net["out"].T
        gradient = np.empty(_SHAPES["embed"], np.float32)
        for k, o in enumerate(_OFFSETS):
            near = ids[at + o]
            for d in range(DIM):
                gradient[k, :, d] = np.bincount(near, weights=back[:, d], minlength=VOCAB + 1)
        first = np.zeros((len(at), ROOT), np.float32)
        first[row, token // ROOT] = 1
        self._step("embed", gradient)
        self._step("out", context.T @ dz)
        self._step("bias", dz.sum(axis=0))
        self._step("second", first.T @ dz[:, ROOT:])
        self.tokens += len(at)

    def texts(self, texts: list[np.ndarray]) -> None:
        """Train on encoded texts."""
        ids, at, _ = framed(texts)
        for k in range(0, len(at), MINIBATCH):
            self.batch(ids, at[k : k + MINIBATCH])


@dataclass
class Model:
    """net; own: hashes of words with an id of their own, sorted (a word's id is its place); totals: counts of the RARE shared ids; total: all tokens; counts: a table of word (hash) and n."""

    net: dict[str, np.ndarray]
    own: np.ndarray
    totals: np.ndarray
    total: int
    counts: DataFrame


def word_counts(docs: DataFrame) -> DataFrame:
    """word (a 64-bit hash) and n of every word of all texts."""

    def run(batches):
        parts, n = [], 0

        def done():
            word, times = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(word)
            word, times = word[order], times[order]
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            return pa.record_batch([pa.array(word[first].view(np.int64)), pa.array(np.add.reduceat(times, first))], names=["word", "n"])

        for b in batches:
            for own, place, _ in coded_parts(b.column(0)):
                parts.append((own, np.bincount(place, minlength=len(own))))
                n += len(place)
                if n >= 4 * TOKENS:
                    yield done()
                    parts, n = [], 0
        if n:
            yield done()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def ids_of(words: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Ids of word hashes; own words by their place, others by their hash."""
    out = OWN + (words % np.uint64(RARE)).astype(np.int64)
    if len(own):
        at = np.minimum(np.searchsorted(own, words), len(own) - 1)
        out = np.where(own[at] == words, at, out)
    return out


def counted(text: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text (ascending), word and times of each word in each text, texts and then words ascending."""
    order = np.argsort(word, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    text, word = text[order], word[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(word), 1), bool), (text[1:] != text[:-1]) | (word[1:] != word[:-1]))))
    return text[first], word[first], np.diff(np.append(first, len(word)))


def untrained(docs: DataFrame) -> Model:
    """The vocabulary of docs with the initial network."""
    counts = materialize(word_counts(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    own = counts.orderBy(F.col("n").desc(), "word").limit(OWN)
    own = np.sort(np.array([r["word"] for r in own.collect()], np.int64).view(np.uint64))
    others = counts.join(F.broadcast(docs.sparkSession.createDataFrame([(int(x),) for x in own.view(np.int64)], "word long")), "word", "left_anti")
    totals = np.ones(RARE)
    for r in others.groupBy(F.col("word").bitwiseAND(RARE - 1).alias("id")).agg(F.sum("n").alias("n")).collect():
        totals[r["id"]] = r["n"]
    return Model(start(), own, totals, total, counts)


def encoded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, key, order (a hash of the text), n_tokens, ids (16 bits each), share (the sum of logarithms of common words' shares in their ids), rare (other words' hashes, times and shared ids)."""
    spark = docs.sparkSession
    common = model.counts.where(F.col("n") * COMMON >= model.total).select("word", "n").toArrow()
    word, n = common.column("word").to_numpy().view(np.uint64), common.column("n").to_numpy()
    order = np.argsort(word)
    held = spark.sparkContext.broadcast((model.own, model.totals, word[order], n[order]))

    def rows_of(keys: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        own, totals, common, n = held.value
        words = np.concatenate([np.zeros(0, np.uint64), *texts])
        sizes = np.array([len(t) for t in texts], np.int64)
        ids = ids_of(words, own)
        far = np.flatnonzero(ids >= OWN)
        text, word, times = counted(np.repeat(np.arange(len(texts)), sizes)[far], words[far])
        at = np.minimum(np.searchsorted(common, word), max(len(common) - 1, 0))
        known = common[at] == word if len(common) else np.zeros(len(word), bool)
        logs = times[known] * np.log(n[at[known]] / totals[(word[known] % np.uint64(RARE)).astype(int)])
        share = np.bincount(text[known], weights=logs, minlength=len(texts)).astype(float)
        ends = np.cumsum(np.bincount(text[~known], minlength=len(texts)))
        left = pa.StructArray.from_arrays([pa.array(word[~known].view(np.int64)), pa.array(times[~known].astype(np.int32))], names=["word", "n"])
        rare = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), left)
        raw, bounds = ids.astype("<i2").tobytes(), [0, *(2 * np.cumsum(sizes)).tolist()]
        cells = pa.array([raw[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
        return pa.record_batch([*keys, pa.array(sizes), cells, pa.array(share), rare], names=["doc_id", "key", "order", "n_tokens", "ids", "share", "rare"])

    def run(batches):
        for b in batches:
            start, texts, held_words = 0, [], 0
            for i, words in enumerate(coded(b.column(3))):
                texts.append(words)
                held_words += len(words)
                if held_words >= TOKENS // 8 or i == b.num_rows - 1:
                    part = b.slice(start, i + 1 - start)
                    yield rows_of([part.column(k) for k in range(3)], texts)
                    start, texts, held_words = i + 1, [], 0

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("key"), F.xxhash64("text").alias("order"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, key long, order long, n_tokens long, ids binary, share double, rare array<struct<word:long,n:int>>"), "ids")


def _round(ids: DataFrame, net: dict[str, np.ndarray], k: int, shards: int) -> dict[str, np.ndarray]:
    """ids: key, order and ids of documents. The network after round k."""
    begin = ids.sparkSession.sparkContext.broadcast(pack(net))

    def copy(shard: int, trainer: Trainer) -> pa.RecordBatch:
        flat = pack(trainer.net)
        cut = [flat[at : at + BLOCK] for at in range(0, len(flat), BLOCK)]
        return pa.record_batch([pa.array(range(len(cut)), pa.int32()), pa.array([shard] * len(cut), pa.int64()), pa.array([float(trainer.tokens)] * len(cut)), pa.array([x.tobytes() for x in cut], pa.binary())], names=["block", "shard", "weight", "values"])

    def train(batches):
        now, trainer, held, n = None, None, [], 0
        for b in batches:
            for shard, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if shard != now:
                    if now is not None:
                        trainer.texts(held)
                        yield copy(now, trainer)
                    now, trainer, held, n = shard, Trainer(unpack(begin.value)), [], 0
                held.append(np.frombuffer(raw, "<i2"))
                n += len(held[-1])
                if n >= TOKENS:
                    trainer.texts(held)
                    held, n = [], 0
        if now is not None:
            trainer.texts(held)
            yield copy(now, trainer)

    def add(batches):
        now, weight, total = None, 0.0, 0.0
        for b in batches:
            out = []
            for block, more, values in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if block != now:
                    if now is not None:
                        out.append((now, (total / weight).astype(np.float32).tobytes()))
                    now, weight, total = block, 0.0, 0.0
                weight += more
                total = total + more * np.frombuffer(values, np.float32).astype(float)
            if out:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary()), strict=True)], names=["block", "values"])
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.int32()), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=["block", "values"])

    mixed = F.xxhash64("order", "doc_id", F.lit("shard"))  # copies of a text are dealt out by their ids
    mine = ids.where((F.col("n_tokens") > 0) & (F.pmod(mixed, F.lit(ROUNDS)) == k)).withColumn("shard", F.pmod(F.shiftrightunsigned(mixed, 8), F.lit(shards)))
    dealt = mine.select("shard", "ids", "order").repartition(shards, "shard").sortWithinPartitions("shard", "order", "ids")
    copies = dealt.select("shard", "ids").mapInArrow(train, "block int, shard long, weight double, values binary")
    rows = copies.repartition("block").sortWithinPartitions("block", "shard").select("block", "weight", "values").mapInArrow(add, "block int, values binary").collect()
    begin.unpersist()
    if not rows:
        return net
    return unpack(np.concatenate([np.frombuffer(r["values"], np.float32) for r in sorted(rows, key=lambda r: r["block"])]))


def fitted(ids: DataFrame, model: Model) -> Model:
    """model trained on the encoded documents."""
    net, shards = model.net, max(1, -(-model.total // (ROUNDS * SHARD)))
    for k in range(ROUNDS):
        net = _round(ids, net, k, shards)
    return Model(net, model.own, model.totals, model.total, model.counts)


def train(docs: DataFrame) -> Model:
    model = untrained(docs)
    return fitted(encoded(docs, model), model)


def scored(ids: DataFrame, model: Model) -> DataFrame:
    """ids: what encoded() gives. doc_id, n_tokens, log_prob (sum) and mean_log_prob of every row."""
    arrays = ids.sparkSession.sparkContext.broadcast(pack(model.net))

    def run(batches):
        net = unpack(arrays.value)
        for b in batches:
            n = b.column(2).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.diff(np.cumsum(n) // TOKENS, prepend=-1))
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), b.num_rows], strict=True):
                texts, places, text = framed([np.frombuffer(x, "<i2") for x in b.column(4).slice(s, e - s).to_pylist()])
                total = np.bincount(text, weights=log_probs(net, texts, places), minlength=e - s) + b.column(3).slice(s, e - s).to_numpy(zero_copy_only=False)
                yield pa.record_batch([b.column(0).slice(s, e - s), b.column(1).slice(s, e - s), b.column(2).slice(s, e - s), pa.array(total)], names=["doc_id", "key", "n_tokens", "near"])

    near = ids.select("doc_id", "key", "n_tokens", "share", "ids").mapInArrow(run, "doc_id long, key long, n_tokens long, near double")
    rare = ids.select("key", "rare")
    if not ids.groupBy("key").count().where("count > 1").isEmpty():
        rare = rare.dropDuplicates(["key"])
    rare = rare.select("key", F.explode("rare").alias("x")).select("key", F.col("x.word").alias("word"), F.col("x.n").alias("times"))
    totals = F.array(*[F.lit(float(x)) for x in model.totals])
    of_id = F.element_at(totals, (F.col("word").bitwiseAND(RARE - 1) + 1).cast("int"))
    rare = rare.join(model.counts, "word", "left").select("key", (F.col("times") * F.log(F.coalesce("n", F.lit(1)) / of_id)).cast("decimal(28,12)").alias("x"))
    rare = rare.groupBy("key").agg(F.sum("x").cast("double").alias("far"))
    total = F.round(F.col("near") + F.coalesce("far", F.lit(0.0)), 6)
    out = near.join(rare, "key", "left").withColumn("log_prob", total)
    return out.select("doc_id", "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.round(F.col("log_prob") / F.col("n_tokens"), 6)).alias("mean_log_prob"))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = untrained(docs)
    ids = encoded(docs, model)
    return scored(ids, fitted(ids, model))
