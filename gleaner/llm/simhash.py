"""SimHash near-duplicates, linked through pigeonring chains.

A fingerprint has 64 bits; bit k is 1 if it is set in over half of the XXH64 values (seed 42) of the text's word
shingles, repeats included. Two fingerprints link at DISTANCE or fewer differing bits.

Pigeonring: the bits lie on a ring of four 16-bit segments. If two fingerprints differ in d <= 3 bits, some segment
starts a chain whose cumulative differences stay within l * 3 / 4 for every length l: none in the first segment, at
most 1 over two, at most 2 over three, at most 3 over all. So the first two segments of the chain are the join key:
each fingerprint files itself under its own 32 bits, and again under those with one 0 bit of the second segment set
(which reaches every partner that differs there in one bit from exactly one side). The third segment's budget is
tested on the joined rows before the full Hamming check.

A key that holds over CROWD fingerprints is not paired: its members meet at hubs instead. A hub is the rest of the
fingerprint (the other 32 bits) with up to two bits changed. A member that files under its own key and reaches a hub
with at most one change is within 3 bits of every member that reaches it with up to two (one, if it filed under a
changed key), so each hub that has such a centre links all others to it: true links only, and of every link at least
one path. Rows grow with the members, not with their pairs.

near_copies() is the wider form that the pipeline takes: it also links texts whose sets of five-word shingles have a
Jaccard similarity of 0.8 or more. A prefix filter on the shingles (rare ones first) proposes them, first each text
with one other for each shingle, then all that is left between the components found so far. Parities of the sets rule out
most proposals: where two rows meet a sketch of 256 bits and then half a bit or more for each shingle, a bit or two for
each before texts are joined; the sets themselves decide.

Components are then found on distinct fingerprints; copies share theirs and are never expanded into pairs.

Defined results: null or blank texts have fingerprint zero and link like any other; fewer words than a shingle give
one shingle of all words; repeated rows each get their result; component_id is the smallest doc_id reachable, and
null only if no reachable row has an id. Other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.hashes import Prefixes, coded
from gleaner.llm.texts import packed, read, row_key
from gleaner.plans.components import components, spread_join
from gleaner.plans.storage import discard, free_shuffles, materialize, partitions, scratch, shuffled

SEED = 42
DISTANCE = 3
#: Members of a key up to which they are paired.
CROWD = 96
NO_ID = 2**63 - 1
SIMILARITY = 0.8


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """A hash for each shingle; all words are one if they are fewer."""
    words = (text or "").encode().lower().split()
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)] if words else []), min(len(words), 1)
    else:
        grams, n = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)), len(words) - shingle + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), "<u8", n)


def _packed(ones: np.ndarray, n) -> np.ndarray:
    """Fingerprints of rows of 64 counts."""
    return np.packbits(ones * 2 > n, axis=-1, bitorder="little").view("<u8").ravel()


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64)


def fingerprint(text: str | None, shingle: int) -> int:
    h = _hashes(text, shingle)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        ones += _bits(h[at : at + 65536]).sum(axis=0, dtype=np.uint32)
    return int(_packed(ones, len(h))[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, key (of the row) and fp (long, the 64 bits) of every row."""

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "key", "fp"])

    return docs.select(F.col("doc_id").cast("long"), row_key(docs).alias("key"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, key long, fp long")


def _segment(fp: str, k: Column | int) -> Column:
    return F.shiftrightunsigned(F.col(fp), 16 * k).bitwiseAND(0xFFFF)


def _keys(nodes: DataFrame) -> DataFrame:
    """A row for each key under which a fingerprint files itself: key, near (bits changed, 0 or 1), start, fp, node."""

    def of(i: int) -> Column:
        own = F.lit(i << 32).bitwiseOR(F.shiftleft(_segment("fp", i), 16)).bitwiseOR(_segment("fp", (i + 1) % 4))
        zeros = F.filter(F.array(*[F.lit(1 << j).cast("long") for j in range(16)]), lambda bit: own.bitwiseAND(bit) == 0)
        near = F.transform(zeros, lambda bit: F.struct(own.bitwiseOR(bit).alias("key"), F.lit(1).alias("near")))
        return F.concat(F.array(F.struct(own.alias("key"), F.lit(0).alias("near"))), near)

    return nodes.select("fp", "node", F.explode(F.concat(*map(of, range(4)))).alias("x")).select("x.key", "x.near", "fp", "node")


def _third(a: str, b: str) -> Column:
    """Bits that differ over the chain's third segment, whose place follows from the key's start."""
    start = F.shiftright(F.col("key"), 32)
    x = F.col(a).bitwiseXOR(F.col(b))
    return F.bit_count(F.element_at(F.array(*[F.shiftrightunsigned(x, 16 * ((i + 2) % 4)).bitwiseAND(0xFFFF) for i in range(4)]), (start + 1).cast("int")))


def _pairs(rows: DataFrame) -> DataFrame:
    own = rows.where("near = 0").select("key", F.col("fp").alias("fa"), F.col("node").alias("a"))
    all_ = rows.select("key", "near", F.col("fp").alias("fb"), F.col("node").alias("b"))
    return (
        own.join(shuffled(all_), "key")
        .where((F.col("fa") != F.col("fb")) & ((F.col("near") == 1) | (F.col("fa") < F.col("fb"))))
        .where(F.col("near") + _third("fa", "fb") <= 2)
        .where(F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= DISTANCE)
        .select("a", "b")
    )


def _hubs(rows: DataFrame) -> DataFrame:
    """Links of crowded keys: through hubs of the 32 bits that the key leaves open."""
    start = F.shiftright(F.col("key"), 32)
    rest = F.element_at(
        F.array(*[F.shiftleft(_segment("fp", (i + 2) % 4), 16).bitwiseOR(_segment("fp", (i + 3) % 4)) for i in range(4)]), (start + 1).cast("int")
    )
    one = [1 << j for j in range(32)]
    two = [x | y for k, x in enumerate(one) for y in one[:k]]
    near = F.array(*[F.lit(x).cast("long") for x in [0, *one]])
    far = F.array(*[F.lit(x).cast("long") for x in two])
    masks = F.when(F.col("near") == 0, F.concat(near, far)).otherwise(near)
    at = rows.withColumn("rest", rest).select("key", "near", "node", "rest", F.explode(masks).alias("mask"))
    at = at.select("key", F.col("rest").bitwiseXOR(F.col("mask")).alias("hub"), "node", ((F.col("near") == 0) & (F.bit_count("mask") <= 1)).alias("core"))
    centre = at.where("core").groupBy("key", "hub").agg(F.min("node").alias("centre"))
    return at.join(shuffled(centre), ["key", "hub"]).where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()


def links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """nodes: fp and node, one row per fingerprint. a and b of links that connect whatever is within DISTANCE."""
    rows = _keys(nodes)
    busy = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("near").alias("least")).where("n > 1 and least = 0")
    rows = materialize(rows.join(shuffled(busy.select("key", "n")), "key"), "keys")
    return _pairs(rows.where(F.col("n") <= crowd)).unionAll(_hubs(rows.where(F.col("n") > crowd)))


def simhash_components(docs: DataFrame, shingle: int = 3, crowd: int = CROWD) -> DataFrame:
    """doc_id, key, fp (long), component (a label) and component_id of every row of docs."""
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("node")), "nodes")
    if nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        found = components(links(nodes, crowd))
        to = nodes.join(shuffled(found), "node", "left").select("fp", F.coalesce("component", "node").alias("component")).withColumn("least", F.col("component"))
    else:  # an id stands for several texts, so nodes go by their fingerprint
        found = components(links(nodes.select("fp", F.col("fp").alias("node")), crowd))
        named = nodes.join(shuffled(found.withColumnRenamed("node", "fp")), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        to = named.join(shuffled(named.groupBy("component").agg(F.min("node").alias("least"))), "component").select("fp", "component", "least")
    return spread_join(fps, to, "fp", "key").select("doc_id", "key", "fp", "component", F.nullif(F.col("least"), F.lit(NO_ID)).alias("component_id"))


def op7(spark, sf_dir: str) -> DataFrame:
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _with_text_hash(docs: DataFrame, key: Column, shingle: int) -> DataFrame:
    """doc_id, key, same (two hashes of the text that copies share) and fp of every row."""

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(3).to_pylist()), np.uint64, b.num_rows)
            yield pa.record_batch([*(b.column(k) for k in range(3)), pa.array(fps.view(np.int64))], names=["doc_id", "key", "same", "fp"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), key.alias("key"), F.xxhash64(text, F.length(text)).alias("same"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, same long, fp long")


def _similar(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have a Jaccard similarity of at least the given one. texts: node, text."""

    def shingles(text: str) -> set:
        words = text.encode().lower().split()
        return set(zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else {tuple(words)}

    def run(batches):
        last, theirs = None, None
        for batch in batches:
            a, b, own, other = (batch.column(k).to_pylist() for k in range(4))
            keep = []
            for k in range(len(a)):
                if b[k] != last:
                    last, theirs = b[k], shingles(other[k])
                mine = shingles(own[k])
                both = len(mine & theirs)
                keep.append(both >= similarity * (len(mine) + len(theirs) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    of = lambda x, t: texts.select(F.col("node").alias(x), F.col("text").alias(t))
    with_texts = spread_join(spread_join(pairs, of("b", "other"), "b", "a"), of("a", "own"), "a", "b").select("a", "b", "own", "other")
    return materialize(with_texts.mapInArrow(run, "a long, b long"), "similar")


#: Upper bits of a shingle's hash by which its frequency is estimated; it decides the order of shingles, never a result.
BUCKET_BITS = 20


def _shingle_set(words: np.ndarray, shingle: int) -> np.ndarray:
    """Distinct hashes of shingles of words (their codes); all words are one if they are fewer."""
    if not len(words):
        return np.zeros(0, np.uint64)
    at = np.arange(max(len(words) - shingle + 1, 1))
    return np.unique(Prefixes(words).of(at, np.minimum(at + shingle, len(words))))


def _levels(texts: DataFrame, shingle: int) -> np.ndarray:
    """For each bucket of hashes the magnitude of its count if it is a frequent one, else 0."""
    shift = np.uint64(64 - BUCKET_BITS)

    def run(batches):
        held = np.zeros(1 << BUCKET_BITS, np.int64)
        for b in batches:
            found = [_shingle_set(words, shingle) >> shift for words in coded(b.column(0))]
            held += np.bincount(np.concatenate([np.zeros(0, np.uint64), *found]).astype(np.int64), minlength=len(held))
        busy = np.flatnonzero(held > 8 + 4 * held.mean())
        yield pa.record_batch([pa.array(busy.astype(np.int32)), pa.array(held[busy])], names=["bucket", "n"])

    busy = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(1 << BUCKET_BITS, np.uint8)
    levels[busy.column("bucket").to_numpy()] = np.log2(busy.column("n").to_numpy()).astype(np.uint8)
    return levels


def _needed(similarity: float, n):
    return np.ceil(similarity * n - 1e-9).astype(np.int64)


def parity_bits(h: np.ndarray) -> bytes:
    """Whether an odd number of distinct hashes falls on each of 2^k bits, as many as there are hashes at least (256 or more)."""
    n = max(256, 1 << max(len(h) - 1, 0).bit_length())
    odd = np.bincount((h & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their parities: the longer is folded to the shorter's bits."""
    n = min(len(a), len(b))
    x, y = (np.bitwise_xor.reduce(np.frombuffer(v, np.uint64).reshape(-1, n // 8), axis=0) for v in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


#: Bytes of the sketch that travels with every shingle of a prefix.
SKETCH = 32


def sketch(bits: bytes) -> bytes:
    """Parities folded to SKETCH bytes, or repeated to as many: a bound like theirs, of fixed size."""
    v = np.frombuffer(bits, np.uint8)
    return np.bitwise_xor.reduce(v.reshape(-1, SKETCH), axis=0).tobytes() if len(v) >= SKETCH else bits + bytes(SKETCH - len(v))


#: Bytes of parities above which they are folded once to travel. Half a bit for each shingle still tells large sets apart.
FOLDED = 64


def travelling(bits: bytes) -> bytes:
    """Parities that grow with the set, from half a bit a shingle, as they travel with every shingle of a prefix."""
    v = np.frombuffer(bits, np.uint8)
    return np.bitwise_xor.reduce(v.reshape(2, -1), axis=0).tobytes() if len(v) > FOLDED else bits


class Parities:
    """Parities of many sets (a power of two of bytes each, SKETCH or more), and how far pairs of them differ at least."""

    def __init__(self, cells: list[bytes]):
        self.words = np.frombuffer(b"".join(cells), np.uint64)
        self.width = np.array([len(x) // 8 for x in cells], np.int64)
        self.start = np.cumsum(self.width) - self.width

    def folded(self, rows: np.ndarray, width: int, to: int) -> np.ndarray:
        """Rows of one width, folded to a smaller one."""
        return np.bitwise_xor.reduce(self.words[self.start[rows][:, None] + np.arange(width)].reshape(len(rows), -1, to), axis=1)

    def sketches(self) -> np.ndarray:
        out = np.empty((len(self.width), SKETCH // 8), np.uint64)
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            out[at] = self.folded(at, w, SKETCH // 8)
        return out

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        m, n = self.width[i], self.width[j]
        for x, y in {(*p,) for p in np.unique(np.stack((m, n), axis=1), axis=0).tolist()}:
            at = np.flatnonzero((m == x) & (n == y))
            for k in range(0, len(at), step := max(1, PAIRS // max(x, y))):
                some = at[k : k + step]
                out[some] = np.bitwise_count(self.folded(i[some], x, min(x, y)) ^ self.folded(j[some], y, min(x, y))).sum(axis=1)
        return out


def _sets(texts: DataFrame, levels: np.ndarray, shingle: int, similarity: float) -> DataFrame:
    """texts: node and text. node, size (of the set of shingles), bits (their parities), sketch and prefix (hashes in the filter's order) of each text."""
    held = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        shift = np.uint64(64 - BUCKET_BITS)
        for b in batches:
            found, sizes, bits = [np.zeros(0, np.uint64)], [], []
            for words in coded(b.column(1)):
                h = _shingle_set(words, shingle)
                h = h[np.lexsort((h, held.value[(h >> shift).astype(np.int64)]))]
                sizes.append(len(h))
                bits.append(parity_bits(h))
                found.append(h[: len(h) - int(_needed(similarity, len(h))) + 1])
            offsets = np.cumsum([0, *map(len, found[1:])], dtype=np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int64)))
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()), pa.array(map(travelling, bits), pa.binary()), prefix], names=["node", "size", "bits", "sketch", "prefix"])

    return texts.select("node", "text").mapInArrow(run, "node long, size int, bits binary, sketch binary, prefix array<long>")


def _plausible(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose parities allow the similarity, so that texts travel only for these.

    Sets of m and n members that are similar differ in (1 - similarity) / (1 + similarity) * (m + n) members at most, and
    parities differ on no more bits than that. No similar pair is lost.
    """
    share = (1 - similarity) / (1 + similarity)

    def run(batches):
        for batch in batches:
            m, n = (batch.column(c).to_numpy() for c in ("m", "n"))
            most = share * (m.astype(np.int64) + n) + 1e-6
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = pa.array(np.fromiter(map(least_difference, x, y), np.int64, len(x)) <= most)
            yield pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    of = lambda node, size, bits: sets.select(F.col("node").alias(node), F.col("size").alias(size), F.col("bits").alias(bits))
    both = spread_join(spread_join(pairs, of("b", "n", "y"), "b", "a"), of("a", "m", "x"), "a", "b")
    return materialize(both.select("a", "b", "m", "n", "x", "y").mapInArrow(run, "a long, b long"), "plausible")


def _shared(prefixes: DataFrame) -> DataFrame:
    """prefixes: h, node, size and place. The rows whose shingle stands in others too, with least, the smallest node of their shingle and band of sizes. Texts of a similarity stand in one band or in neighbours; _apart() sees to the others. One shuffle, by shingle, serves both; what a window holds of a shingle spills."""
    band = F.floor(F.log(F.col("size").cast("double")) / float(np.log(1 / SIMILARITY))).cast("int")
    rows = prefixes.repartition("h").withColumn("band", band)
    rows = rows.withColumn("least", F.min("node").over(W.partitionBy("h", "band"))).withColumn("n", F.count("*").over(W.partitionBy("h")))
    return rows.where("n > 1").select("h", "node", "size", "place", "least")


def cross_pairs(h, component, size, place, similarity: float, sketches=None, part=None):
    """(i, j): indices of pairs with equal h and different components whose sizes, places and sketches allow the similarity.

    With a prefix filter's order, what follows the first shared place bounds the overlap, so a partner's size lies in a
    range. Rows of one shingle are sorted by size; of each row's range only stretches of other components are read, so
    members of one component are never paired with each other. sketches (rows of 64-bit words): sets that are similar
    differ in (1 - similarity) / (1 + similarity) of their sizes' sum at most, and parities in no more bits. part: rows of
    one number are not paired with each other, unless it is -1.
    """
    order = np.lexsort((component, size, h))
    h, component, size, place = (x[order] for x in (h, component, size, place))
    sketches, part = (None if x is None else x[order] for x in (sketches, part))
    first = np.flatnonzero(np.concatenate((np.ones(min(len(h), 1), bool), h[1:] != h[:-1])))
    if not len(first):
        return
    mixed = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
    ends = np.append(first[1:], len(h))
    ratio = (1 + similarity) / similarity
    share = (1 - similarity) / (1 + similarity)
    for s, e in zip(first[mixed].tolist(), ends[mixed].tolist(), strict=True):
        left = (size[s:e] - place[s:e]).astype(float)
        # The row with the smaller or equal size looks up: overlap <= min(left) bounds the larger size.
        most = np.minimum(size[s:e] / similarity, left * ratio - size[s:e]) + 1e-6
        stop = s + np.searchsorted(size[s:e], most, side="right")
        # Rows are grouped by runs of one component: a run has no pairs inside.
        cut = np.flatnonzero(np.concatenate(([True], component[s + 1 : e] != component[s : e - 1])))
        run_end = s + np.append(cut[1:], e - s)[np.cumsum(np.concatenate(([True], component[s + 1 : e] != component[s : e - 1]))) - 1]
        here = np.arange(s, e)
        n = np.maximum(stop - np.maximum(run_end, here + 1), 0)
        # As many rows at once as make PAIRS pairs or so.
        at = np.flatnonzero(np.diff(np.cumsum(n) // PAIRS, prepend=-1))
        for k, end in zip(at.tolist(), [*at[1:].tolist(), len(n)], strict=True):
            m = n[k:end]
            if not m.any():
                continue
            i = np.repeat(here[k:end], m)
            j = np.repeat(run_end[k:end], m) + np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m)
            may = (component[i] != component[j]) & (np.minimum(size[i] - place[i], size[j] - place[j]) >= _needed(similarity / (1 + similarity), size[i] + size[j]))
            if part is not None:
                may &= (part[i] != part[j]) | (part[i] < 0)
            i, j = i[may], j[may]
            if sketches is not None and len(i):
                may = np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1) <= share * (size[i] + size[j]) + 1e-6
                i, j = i[may], j[may]
            yield order[i], order[j]


#: Pairs that a task looks at at once, and rows of a shingle above which they are dealt out.
PAIRS, HOT = 1 << 18, 1 << 14


def _mixed(rows: DataFrame) -> DataFrame:
    """rows: prefixes with component. Those of shingles that stand in several components, with parts, in how many their shingle is cut."""
    shingle = W.partitionBy("h")
    rows = rows.repartition("h").withColumn("n", F.count("*").over(shingle)).withColumn("x", F.min("component").over(shingle)).withColumn("y", F.max("component").over(shingle))
    return rows.where("x <> y").select("h", "node", "component", "size", "place", F.ceil(F.col("n") / HOT).cast("int").alias("parts"))


def _apart(rows: DataFrame, sketches: DataFrame, similarity: float, n: int) -> DataFrame:
    """rows: _mixed() prefixes, dealt out over n tasks; sketches: node and sketch. a and b: all pairs of different components that may have the similarity.

    With the shingles of all texts in one order, rare ones first, two sets of that similarity share a shingle among the
    first n - similarity * n + 1 of each. At the first that they share, what is left must suffice for the overlap, and
    the parities must allow it, a sketch of fixed size first; so texts that share standard sentences, and long ones that
    share some shingle by chance, are ruled out where they meet and not written.
    Shingles of one component only have no such pair. A shingle with over HOT rows is cut in parts of that many, and each
    two parts meet in a task of their own.
    """

    share = (1 - similarity) / (1 + similarity)

    def run(batches):
        def pairs(held):
            h, node, component, size, place, cells, part = (np.concatenate(x) for x in zip(*held, strict=True))
            bits, found = Parities(cells.tolist()), []
            for i, j in cross_pairs(h, component, size, place, similarity, bits.sketches(), part):
                may = bits.apart(i, j) <= share * (size[i].astype(np.int64) + size[j]) + 1e-6
                if may.any():
                    i, j = i[may], j[may]
                    found.append((np.maximum(node[i], node[j]), np.minimum(node[i], node[j])))
            if found:
                a, b = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)]), axis=1)
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        held, n, last = [], 0, None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("group", "node", "component", "size", "place")]
            cols = [*cols, b.column("sketch").to_numpy(zero_copy_only=False), b.column("part").to_numpy()]
            # Rows come sorted by group: once enough are held, they go as soon as the last group has ended.
            cut = int(np.searchsorted(cols[0] != last, True)) if n > HOT else b.num_rows
            if cut < b.num_rows:
                held.append([x[:cut] for x in cols])
                yield from pairs(held)
                held, n, cols = [], 0, [x[cut:] for x in cols]
            held.append(cols)
            n, last = n + len(cols[0]), cols[0][-1]
        if held:
            yield from pairs(held)

    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    met = rows.join(shuffled(sketches), "node").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = F.when(F.col("parts") == 1, F.col("h")).otherwise(F.xxhash64("h", F.least("mine", "other"), F.greatest("mine", "other")))
    part = F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine"))
    # Where two parts meet, rows of one part are not paired again; where a part meets itself, all are.
    met = met.select(key.alias("group"), "node", "component", "size", "place", "sketch", part.alias("part"))
    return materialize(met.repartition(n, "group").sortWithinPartitions("group").mapInArrow(run, "a long, b long").distinct(), "apart")


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = SIMILARITY, crowd: int = CROWD, key: Column | None = None) -> DataFrame:
    """doc_id (NO_ID for null), key and component of every row: whole texts within DISTANCE bits, and texts of the given similarity.

    A text that differs in a few words is further than DISTANCE bits from its original, so a prefix filter proposes
    those as well. Of the texts that share a shingle of their prefixes and a band of sizes each is compared with one
    first: a group of copies, however large, is linked by as many pairs as members. What lies in different components
    after that is compared in all pairs that the filter can't rule out, so no link between components is lost. Copies
    are one text throughout.
    """
    key = row_key(docs) if key is None else key
    rows = materialize(_with_text_hash(docs, key, shingle), "fingerprints")
    nodes = rows.groupBy("same", "fp").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    nodes = materialize(nodes.select("same", "fp", F.col("first.key").alias("node")), "texts")
    texts = docs.select(key.alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    repeats = not rows.groupBy("key").count().where("count > 1").isEmpty()  # rows that are there twice

    def of(wanted: DataFrame) -> DataFrame:
        some = texts.join(wanted.select("node"), "node", "left_semi")
        return some.dropDuplicates(["node"]) if repeats else some

    # Copies go once their sets are known, which are smaller to shuffle than texts.
    sets = _sets(texts, _levels(texts, shingle), shingle, similarity).join(shuffled(nodes.select("node")), "node", "left_semi")
    sets = materialize(sets.dropDuplicates(["node"]) if repeats else sets, "sets")
    free_shuffles(docs.sparkSession)

    def alike(pairs: DataFrame) -> DataFrame:
        may = _plausible(pairs, sets, similarity)
        out = _similar(may, of(may.select(F.col("a").alias("node")).union(may.select("b")).distinct()), shingle, similarity)
        discard(pairs)
        discard(may)
        free_shuffles(docs.sparkSession)
        return out

    held = materialize(_shared(sets.select("node", "size", F.posexplode("prefix").alias("place", "h"))), "prefixes")
    free_shuffles(docs.sparkSession)
    heads = materialize(nodes.groupBy("fp").agg(F.min("node").alias("node")), "heads")
    same = nodes.select("fp", F.col("node").alias("a")).join(heads.withColumnRenamed("node", "b"), "fp").where("a <> b").select("a", "b")
    first = alike(materialize(held.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct(), "pairs"))
    edges = materialize(first.unionAll(same).unionAll(links(heads, crowd)), "links")
    label = components(edges)
    named = held.drop("least").join(shuffled(label), "node", "left").withColumn("component", F.coalesce("component", "node"))
    n, mixed = partitions(held), materialize(_mixed(named), "mixed")
    discard(held)
    del held, named
    free_shuffles(docs.sparkSession)
    # Only rows of shingles that join components get their sketch.
    more = alike(_apart(mixed, sets.select("node", "sketch"), similarity, n))
    for table in (mixed, sets):
        discard(table)
    found = label if more.isEmpty() else components(edges.unionAll(more))
    label = nodes.join(shuffled(found), "node", "left").select(F.struct("same", "fp").alias("text"), F.coalesce("component", "node").alias("component"))
    return spread_join(rows.select("doc_id", "key", F.struct("same", "fp").alias("text")), label, "text", "key").select("doc_id", "key", "component")


def keep_first(docs: DataFrame, shingle: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each component stays, that with the smallest doc_id (nulls last); of rows that repeat it, one.

    Texts with fewer words than a shingle are compared by all their words; blank ones are copies of each other.
    """
    key = row_key(docs)
    with scratch(docs.sparkSession) as keep:
        found = materialize(near_copies(docs, shingle, similarity, key=key), "components")
        first = found.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("x"))
        first = materialize(first.select("component", F.col("x.key").alias("key")), "kept")
        repeats = not found.join(first, ["component", "key"]).groupBy("key").count().where("count > 1").isEmpty()
        keep.append(first)
    kept = packed(docs, key).join(shuffled(first.select("key")), "key", "left_semi")
    return (kept.dropDuplicates(["key"]) if repeats else kept).select("row.*")
