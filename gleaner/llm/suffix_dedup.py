"""Exact substring dedup by a logarithmic family of suffix arrays.

Removed is each byte that a LENGTH-byte string covers which also starts earlier (smaller doc_id, or the same document
and an earlier start), judged on the input.

A suffix array here lists suffixes by the hash of their first bytes, not by the bytes: any order serves that puts equal
prefixes of LENGTH bytes together, and the bytes themselves (134 for each run, four times the text) need not travel. A family holds sorted arrays (levels). A new batch is sorted, scanned against itself
and merge-scanned against each level for long matches; of two suffixes that match, the later is removed and the earlier
stays in the family; then the batch becomes a level, and levels of equal size (within a factor of two) merge, so a
suffix is merged a logarithmic number of times. StoredFamily is the same over batches that come one after another, with
its levels as written tables.

Suffixes are sparse. Each LENGTH-byte window belongs to an anchor: the position in it whose GRAM-byte hash is smallest
(leftmost of equals). Equal windows have equal anchors, and consecutive windows with one anchor form a run, about 35 of
them. So one row for each run, not for each byte, is shuffled, by the anchor's gram:
1. Runs equal in all their bytes match as wholes. They are reduced in each map batch first, so a passage in a third of
   all documents is a row per batch; the family of a partition matches the rest.
2. Runs whose gram occurs but whose bytes differ (the edges of repeats) come back with their bytes from their
   documents, and a second family matches their windows one by one. Of equal runs only the earliest takes part: its
   windows are as early as theirs. A gram with over CROWD different runs (a hot passage's edge) is not kept
   together: its windows are dealt out by their own hashes, after the same reduction in each batch.
Both steps compare two 64-bit hashes of different kinds (gram and run, gram and window).

Defined results: null texts are empty; texts under LENGTH bytes lose nothing; rows that repeat both id and text are one
document and get the same result; rows that repeat an id with another text are ordered by a hash of the text; null ids
come last; other columns are ignored. Texts are cut in PIECE-byte pieces (overlapping by LENGTH - 1), so very long ones
need no more memory than others; a run that a cut divides is matched by its windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.hashes import Prefixes, mix, sliding_argmin
from gleaner.llm.texts import read
from gleaner.plans.storage import materialize, partitions

LENGTH = 100
GRAM = 32
PIECE = 1 << 20
CROWD = 2000
#: Suffixes of a batch that is sorted and merge-scanned at once.
BATCH = 1 << 16
NO_ID = 2**63 - 1

_random = np.random.default_rng(7)
_GRAMS = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES = _random.integers(0, 1 << 63, 256, dtype=np.uint64)
_STEPS = _random.integers(0, 1 << 62, 5, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
_SPAN = LENGTH - GRAM + 1


def runs(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and one-past-last window of each run, the hash of its anchor's gram, the hash of its bytes."""
    n = len(raw)
    if n < LENGTH:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    g, k = _GRAMS[raw], 1
    for step in _STEPS:
        g = g[:-k] * step + g[k:]
        k *= 2
    g = mix(g)
    at = sliding_argmin(g, _SPAN)
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    end = np.append(start[1:], len(at))
    return start, end, g[at[start]], Prefixes(_BYTES[raw]).of(start, end + LENGTH - 1)


class Family:
    """Levels of sorted suffixes. Suffixes are rows of growing columns; a level is (keys, rows), keys sorted."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.columns: list[np.ndarray] = []
        self.n = 0

    def _store(self, columns: list[np.ndarray]) -> np.ndarray:
        m = len(columns[0])
        if not self.columns:
            self.columns = [np.empty(max(m, 1024), c.dtype) for c in columns]
        while self.n + m > len(self.columns[0]):
            self.columns = [np.concatenate((c, np.empty(len(c), c.dtype))) for c in self.columns]
        for held, c in zip(self.columns, columns, strict=True):
            held[self.n : self.n + m] = c
        rows = np.arange(self.n, self.n + m)
        self.n += m
        return rows

    def _earlier(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether rows a come before rows b: by document, text hash, start."""
        doc, uid, start = self.columns[:3]
        return np.where(doc[a] != doc[b], doc[a] < doc[b], np.where(uid[a] != uid[b], uid[a] < uid[b], start[a] < start[b]))

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the hashes kept beside the key agree as well."""
        out = np.ones(len(a), bool)
        for c in self.columns[3:5]:
            out &= c[a] == c[b]
        return out

    def add(self, keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        """columns: document, text hash, start, two hashes that must agree, and any more. Returns rows that match an earlier suffix; a suffix that is the same in document, text hash and start is none."""
        rows = self._store(columns)
        doc, uid, start = columns[:3]
        order = np.lexsort((start, uid, doc, keys))
        keys, rows = keys[order], rows[order]
        first = np.concatenate(([True], keys[1:] != keys[:-1]))
        head = rows[np.flatnonzero(first)[np.cumsum(first) - 1]]
        later = [rows[~first & self._same(head, rows) & self._earlier(head, rows)]]
        keys, rows = keys[first], rows[first]
        for k, (held, at) in enumerate(self.levels):
            i = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            hit = (held[i] == keys) & self._same(at[i], rows)
            mine, theirs, i = rows[hit], at[i[hit]], i[hit]
            before = self._earlier(mine, theirs)
            later += [mine[self._earlier(theirs, mine)], theirs[before]]
            at[i[before]] = mine[before]
            keys, rows = keys[~hit], rows[~hit]
        if len(keys):
            self.levels.append((keys, rows))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels[-2:]
            keys = np.concatenate((a, b))
            order = np.argsort(keys, kind="stable")
            self.levels[-2:] = [(keys[order], np.concatenate((x, y))[order])]
        return np.concatenate(later)

    def rows(self) -> np.ndarray:
        return np.concatenate([at for _, at in self.levels]) if self.levels else np.zeros(0, np.int64)


def _pieces(raw: np.ndarray):
    """(offset, bytes) of overlapping pieces."""
    for at in range(0, max(1, len(raw) - LENGTH + 1), PIECE):
        yield at, raw[at : at + PIECE + LENGTH - 1]


# Kinds of rows between the steps.
RUN, COVER, EDGE, HOT = 0, 1, 2, 3
_ROWS = "kind byte, doc long, uid long, start long, end long, h long, c long"
_SCHEMA = pa.schema([("kind", pa.int8()), ("doc", pa.int64()), ("uid", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("h", pa.int64()), ("c", pa.int64())])


def _rows(kind: int, doc, uid, start, end, h=None, c=None) -> pa.RecordBatch:
    n = len(doc)
    zero = np.zeros(n, np.int64)
    parts = [np.full(n, kind, np.int8), doc, uid, start, end, zero if h is None else h.view(np.int64), zero if c is None else c.view(np.int64)]
    return pa.record_batch([pa.array(np.ascontiguousarray(x)) for x in parts], schema=_SCHEMA)


def _merged(doc, uid, start, end):
    """Covers with overlaps joined within a document."""
    if not len(doc):
        return doc, uid, start, end
    order = np.lexsort((start, uid, doc))
    doc, uid, start, end = doc[order], uid[order], start[order], end[order]
    group = np.concatenate(([0], np.cumsum((doc[1:] != doc[:-1]) | (uid[1:] != uid[:-1]))))
    # Ends never fall back within a group: shift groups apart, then take the running maximum.
    shift = int(end.max()) + 2
    reach = np.maximum.accumulate(end + group * shift) - group * shift
    fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], uid[first], start[first], reach[last]


def _find_runs(batches):
    """Texts to runs and covers; equal runs of a batch of rows are reduced to the earliest."""
    for b in batches:
        docs, uids = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        parts, held = [], 0
        for i in range(b.num_rows):
            text = b.column(2)[i].as_buffer()
            raw = np.frombuffer(text, np.uint8) if text is not None else np.zeros(0, np.uint8)
            for offset, piece in _pieces(raw):
                start, end, h, c = runs(piece)
                parts.append((np.full(len(h), docs[i]), np.full(len(h), uids[i]), start + offset, end + offset, h, c))
                held += len(h)
                if held >= 4 * BATCH:
                    yield from _reduced(parts)
                    parts, held = [], 0
        if held:
            yield from _reduced(parts)


def _reduced(parts):
    doc, uid, start, end, h, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((start, uid, doc, c, h))
    doc, uid, start, end, h, c = (x[order] for x in (doc, uid, start, end, h, c))
    first = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    same = ~first & (doc[head] == doc) & (uid[head] == uid) & (start[head] == start)  # a row that is there twice
    yield _rows(RUN, doc[first], uid[first], start[first], end[first], h[first], c[first])
    again = ~first & ~same
    yield _rows(COVER, *_merged(doc[again], uid[again], start[again], end[again] + LENGTH - 1))


def _columns(b: pa.RecordBatch, keep: np.ndarray) -> list[np.ndarray]:
    return [b.column(k).to_numpy(zero_copy_only=False)[keep] for k in range(1, 7)]


def _match_runs(batches):
    """The family of a partition: covers, and the edges that have to be matched by windows."""
    family, held, n = Family(), [], 0

    def flush():
        doc, uid, start, end, h, c = (np.concatenate(x) for x in zip(*held, strict=True))
        h, c = h.view(np.uint64), c.view(np.uint64)
        later = family.add(mix(h ^ mix(c)), [doc, uid, start, h, c, end])
        doc, uid, start, _, _, end = family.columns
        return _rows(COVER, *_merged(doc[later], uid[later], start[later], end[later] + LENGTH - 1))

    for b in batches:
        kind = b.column(0).to_numpy(zero_copy_only=False)
        if (kind == COVER).any():
            yield b.filter(pa.array(kind == COVER))
        held.append(_columns(b, kind == RUN))
        n += len(held[-1][0])
        if n >= BATCH:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()
    if family.n:
        at = family.rows()
        doc, uid, start, h, _, end = family.columns
        at = at[np.argsort(h[at], kind="stable")]
        first = np.flatnonzero(np.concatenate(([True], h[at][1:] != h[at][:-1])))
        size = np.diff(np.append(first, len(at)))
        size = np.repeat(size, size)
        for kind, rows in ((EDGE, at[(size > 1) & (size <= CROWD)]), (HOT, at[size > CROWD])):
            for k in range(0, len(rows), BATCH):
                r = rows[k : k + BATCH]
                yield _rows(kind, doc[r], uid[r], start[r], end[r], h[r])


_WINDOWS = "deal long, doc long, uid long, start long, h long, w long, bytes binary"
_WINDOWS_SCHEMA = pa.schema([("deal", pa.int64()), ("doc", pa.int64()), ("uid", pa.int64()), ("start", pa.int64()), ("h", pa.int64()), ("w", pa.int64()), ("bytes", pa.binary())])


def _window_hashes(raw: np.ndarray) -> np.ndarray:
    at = np.arange(len(raw) - LENGTH + 1)
    return Prefixes(_BYTES[raw]).of(at, at + LENGTH)


def _fetch(batches):
    """Documents with their edges: a row with the bytes of each edge, and a row per window of each hot one."""
    for b in batches:
        out, held = [], 0
        for i in range(b.num_rows):
            raw = np.frombuffer(b.column("text")[i].as_buffer(), np.uint8)
            doc, uid = b.column("doc")[i].as_py(), b.column("uid")[i].as_py()
            for e in b.column("edges")[i].as_py():
                piece = raw[e["start"] : e["end"] + LENGTH - 1]
                if e["kind"] == EDGE:
                    out.append((e["h"], doc, uid, e["start"], e["h"], 0, piece.tobytes()))
                else:
                    w = _window_hashes(piece)
                    deal = mix(w ^ np.uint64(e["h"] & (2**64 - 1))).view(np.int64)
                    out += [(int(x), doc, uid, e["start"] + k, e["h"], int(v), None) for k, (x, v) in enumerate(zip(deal, w.view(np.int64), strict=True))]
                held += len(piece)
            if held >= 1 << 22:
                yield _window_rows(out)
                out, held = [], 0
        if out:
            yield _window_rows(out)


def _window_rows(rows) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _WINDOWS_SCHEMA, strict=True)], schema=_WINDOWS_SCHEMA)


def _match_windows(batches):
    family = Family()
    for b in batches:
        for at in range(0, b.num_rows, BATCH // 32):
            part = b.slice(at, BATCH // 32)
            doc, uid, start, h, w = (part.column(k).to_numpy(zero_copy_only=False) for k in range(1, 6))
            h, w = h.view(np.uint64), w.view(np.uint64)
            texts = part.column(6)
            n = np.array([1 if x is None else len(x) - LENGTH + 1 for x in texts.to_pylist()], np.int64)
            whole = np.flatnonzero([x.is_valid for x in texts])
            row = np.repeat(np.arange(len(n)), n)
            starts = start[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
            hashes = w[row]
            if len(whole):
                raw = np.frombuffer(b"".join(texts[int(k)].as_py() for k in whole), np.uint8)
                all_ = _window_hashes(raw)
                size = n[whole] + LENGTH - 1
                offset = np.cumsum(size) - size
                of = np.repeat(offset, n[whole]) + (np.arange(n[whole].sum()) - np.repeat(np.cumsum(n[whole]) - n[whole], n[whole]))
                hashes[np.isin(row, whole)] = all_[of]
            later = family.add(mix(hashes ^ h[row]), [doc[row], uid[row], starts, h[row], hashes])
            d, u, s = (c[later] for c in family.columns[:3])
            yield _rows(COVER, *_merged(d, u, s, s + LENGTH))


def _identified(docs: DataFrame) -> DataFrame:
    """doc, uid and text; uid tells rows apart that repeat an id, and is 0 where none does."""
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    repeats = not plain.groupBy("doc").count().where("count > 1").isEmpty()
    return plain.select("doc", (F.xxhash64("text") if repeats else F.lit(0).cast("long")).alias("uid"), "text", "doc_id")


_COVER_COLUMNS = ["doc", "uid", "start", "end"]


def _covers_of(runs_: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """runs_: rows of _find_runs; docs: doc, uid and text of their documents."""
    deal = F.when(F.col("kind") == RUN, F.col("h")).otherwise(F.xxhash64("doc", "uid", "start"))
    matched = materialize(runs_.repartition(n, deal).mapInArrow(_match_runs, _ROWS), "runs")
    edges = matched.where(f"kind >= {EDGE}").groupBy("doc", "uid").agg(F.collect_list(F.struct("kind", "start", "end", "h")).alias("edges"))
    windows = edges.join(docs.select("doc", "uid", "text"), ["doc", "uid"]).select("doc", "uid", "text", "edges").mapInArrow(_fetch, _WINDOWS)
    by_window = windows.repartition(n, "deal").mapInArrow(_match_windows, _ROWS)
    return matched.where(f"kind = {COVER}").unionAll(by_window).select(*_COVER_COLUMNS)


def covers(docs: DataFrame) -> DataFrame:
    """docs: doc, uid, text. doc, uid, start, end (bytes) of what is to go; covers of a document may overlap."""
    return _covers_of(docs.select("doc", "uid", "text").mapInArrow(_find_runs, _ROWS), docs, partitions(docs))


class StoredFamily:
    """The family over batches that come one after another: levels of sorted suffixes as written tables.

    add() gives a batch its own sorted suffixes and merge-scans them against each level: of a level only suffixes whose
    gram the batch holds are read. Covers are returned for documents of the batch, and for stored ones where the batch
    holds an earlier document; all covers that add() ever returned are those of all batches at once. Then the batch
    becomes a level, and levels of equal size (within a factor of two) merge, so a suffix is rewritten a logarithmic
    number of times. Texts of batches are kept for the comparison of edges.

    A level's folder is named by the batches it holds; one that holds another's batches replaces it, so a merge that an
    error cuts short leaves the old levels in place. Rows that are null in id or repeat one are told apart by their text.
    """

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folders(self, name: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(f.getPath().getName() for f in fs.listStatus(path) if fs.exists(done(f.getPath(), "_SUCCESS")))

    def levels(self) -> list[tuple[int, int, int]]:
        """First batch, last batch and number of suffixes of each level, oldest first."""
        found = sorted((int(a), -int(b), int(n)) for a, b, n in (f.split("-") for f in self._folders("levels")))
        out: list[tuple[int, int, int]] = []
        for a, b, n in found:
            if not out or a > out[-1][1]:
                out.append((a, -b, n))
        return out

    def _level(self, a: int, b: int, n: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/levels/{a:06d}-{b:06d}-{n}")

    def _write_level(self, rows: DataFrame, a: int, b: int) -> None:
        """The earliest of equal suffixes, sorted by their hashes."""
        first = rows.groupBy("h", "c").agg(F.min(F.struct("doc", "uid", "start", "end")).alias("x")).select("h", "c", "x.*")
        first = materialize(first.sortWithinPartitions("h", "c"), "level")
        first.write.parquet(f"{self.root}/levels/{a:06d}-{b:06d}-{first.count()}")

    def add(self, docs: DataFrame) -> DataFrame:
        """docs: doc_id and text. doc, uid, start, end of what is to go."""
        levels, batch = self.levels(), len(self._folders("texts"))
        own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("uid"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        found = materialize(own.mapInArrow(_find_runs, _ROWS), "found")
        grams = found.where(f"kind = {RUN}").select("h").distinct()
        rows, texts = found, own
        for level in levels:
            held = self._level(*level).join(grams, "h", "left_semi")
            rows = rows.unionByName(held.select(F.lit(RUN).cast("byte").alias("kind"), "doc", "uid", "start", "end", "h", "c"))
        if levels:
            texts = texts.unionByName(self.spark.read.parquet(*[f"{self.root}/texts/{f}" for f in self._folders("texts")]).select("doc", "uid", "text"))
        texts = texts.dropDuplicates(["doc", "uid"])
        out = materialize(_covers_of(rows, texts, partitions(docs)), "covers")
        self._write_level(found.where(f"kind = {RUN}"), batch, batch)
        own.write.parquet(f"{self.root}/texts/{batch:06d}")
        levels = self.levels()
        while len(levels) > 1 and levels[-2][2] < 2 * levels[-1][2]:
            (a, _, _), (_, b, _) = levels[-2:]
            self._write_level(self._level(*levels[-2]).unionByName(self._level(*levels[-1])), a, b)
            levels = self.levels()
        return out


def _cut(batches):
    """Documents with their covers: what stays, counted and hashed."""
    for b in batches:
        out = []
        for i in range(b.num_rows):
            text = b.column("text")[i].as_buffer()
            raw = memoryview(text)
            kept, at, removed, spans, end = hashlib.sha256(), 0, 0, [], 0
            for s, e in sorted((x["start"], x["end"]) for x in b.column("spans")[i].as_py() or ()):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            for s, e in spans:
                kept.update(raw[at:s])
                removed += e - s
                at = e
            kept.update(raw[at:])
            out.append({"doc_id": b.column("doc_id")[i].as_py(), "n_bytes": len(raw), "n_removed": removed, "n_spans": len(spans), "kept_sha256": kept.hexdigest(), "spans": [{"start": s, "end": e} for s, e in spans]})
        yield pa.RecordBatch.from_pylist(out, schema=_CUT_SCHEMA)


_CUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (removed bytes: start and end) of every row."""
    own = _identified(docs)
    spans = materialize(covers(own), "covers").groupBy("doc", "uid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return own.join(spans, ["doc", "uid"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def op4(spark, sf_dir: str) -> DataFrame:
    return deduplicated(read(spark, sf_dir, "documents")).drop("spans")
