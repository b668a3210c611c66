"""Fill-in-middle: whole texts cut at two token ranks and put together as suffix, prefix and middle.

A token is a word with the blanks before it, or the blanks at a text's end. So a token ends exactly where a non-blank is
followed by a blank, and at the text's end: a predicate on two adjacent characters. Blanks and the three marks are
ASCII, so all of it holds on UTF-8 bytes as it does on code points, and nothing is decoded.

Overlapping-chunk decomposition: a text is cut into chunks of CHUNK bytes, each with one byte of the next one. Every chunk
counts its boundaries by itself; prefix sums over a text's chunks say which chunk owns the k-th boundary, and only the
owners of the two cuts are scanned again for the place. Texts of one chunk, where both ranks have the same owner, are
done in place, a batch of them at a time. Of longer texts the chunks are rows of a written table, dealt out by text and
number, so that one long text is counted by many tasks; prefix sums are a window over counts (a row for each CHUNK bytes),
the owners are looked up by an equi-join, and only places go back to the texts.

Hashes of the id decide ranks and form, so a rerun gives the same rows. Output and restored text are made and hashed in
one pass per text: restored() takes the pieces from the output by its marks alone.

Defined results: a null text is empty; a null id hashes as the empty string; n is 0 for an empty text, which is plain;
rows that repeat get a result each; other columns are ignored. A text and its output are held whole by one task, as
they are one cell each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.texts import read
from gleaner.plans.storage import materialize, partitions

#: Bytes of a chunk.
CHUNK = 1 << 15
SEED = "42"
#: Shares in percent: documents that are transformed, and those among them with the suffix first.
FIM_RATE, SPM_RATE = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def boundaries(chunk: np.ndarray) -> np.ndarray:
    """For bytes of a chunk and the one after it: how many of them stand before each token's end that lies between two of them."""
    blank = _BLANK[chunk]
    return np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def ranks(doc_id: Column, n: Column) -> tuple[Column, Column]:
    """The smaller and the larger cut, as numbers of tokens before them."""
    a, b = (F.pmod(_hash(doc_id, k), n + 1) for k in (0, 1))
    return F.least(a, b), F.greatest(a, b)


def _hash(doc_id: Column, k: int) -> Column:
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(name, 256), 8 * k + 1, 8), 16, 10).cast("long")


def form(doc_id: Column, text: Column) -> Column:
    plain = (text == "") | text.contains(PREFIX.decode()) | text.contains(SUFFIX.decode()) | text.contains(MIDDLE.decode()) | (_hash(doc_id, 2) % 100 >= FIM_RATE)
    return F.when(plain, "plain").when(_hash(doc_id, 3) % 100 < SPM_RATE, "spm").otherwise("psm")


def assembled(text: bytes, a: int, b: int, kind: str) -> bytes:
    """The output for cuts after a and b bytes."""
    if kind == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle) if kind == "spm" else (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restored(output: bytes, kind: str) -> bytes:
    """The text, from an output and its form."""
    if kind == "plain":
        return output
    head, _, middle = output.partition(MIDDLE)
    if kind == "spm":
        suffix, _, prefix = head[len(SUFFIX) :].partition(PREFIX)
    else:
        prefix, _, suffix = head[len(PREFIX) :].partition(SUFFIX)
    return prefix + middle + suffix


def _length(text: bytes) -> int:
    """Code points."""
    return len(text) - int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))


_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _record(ids, n, kinds, texts, cuts, with_output: bool) -> pa.RecordBatch:
    cols = [[], [], [], [], []]
    for kind, text, (a, b) in zip(kinds, texts, cuts, strict=True):
        out = assembled(text, a, b, kind)
        lengths = (None, None) if kind == "plain" else (_length(text[:a]), _length(text[a:b]))
        for col, value in zip(cols, (*lengths, hashlib.sha256(out).hexdigest(), hashlib.sha256(restored(out, kind)).hexdigest(), out), strict=True):
            col.append(value)
    arrays = [ids, pa.array(n, pa.int64()), pa.array(kinds, pa.string()), *(pa.array(c, t) for c, t in zip(cols[:4], (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))]
    names = [x.split()[0] for x in _OUT.split(", ")]
    if with_output:
        arrays, names = [*arrays, pa.array(cols[4], pa.binary()).cast(pa.string())], [*names, "output"]
    return pa.record_batch(arrays, names=names)


def _views(column: pa.Array) -> list[memoryview]:
    """The bytes of each string, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    return [data[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _short(docs: DataFrame, with_output: bool) -> DataFrame:
    """Texts of one chunk: counted, cut and put together where they are."""

    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            texts = [bytes(v) for v in _views(batch.column("text"))]
            n, cuts = [], []
            for k, text in enumerate(texts):
                ends = np.append(boundaries(np.frombuffer(text, np.uint8)), len(text)) if text else np.zeros(0, int)
                n.append(len(ends))
                at = sorted((int(h1[k]) % (n[-1] + 1), int(h2[k]) % (n[-1] + 1)))
                cuts.append([int(ends[r - 1]) if r else 0 for r in at])
            yield _record(batch.column("doc_id"), n, batch.column("form").to_pylist(), texts, cuts, with_output)

    return docs.select("doc_id", "text", "form", _hash(F.col("doc_id"), 0).alias("h1"), _hash(F.col("doc_id"), 1).alias("h2")).mapInArrow(run, _OUT + ", output string" * with_output)


def chunked(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key, chunk (its number), last (whether it is the text's last) and data (with the byte after it) of every chunk."""

    def run(batches):
        for batch in batches:
            for k, text in enumerate(_views(batch.column("text"))):
                row = batch.slice(k, 1)
                for j, at in enumerate(range(0, len(text), size)):
                    data = pa.array([bytes(text[at : at + size + 1])], pa.binary())
                    yield pa.record_batch([row.column("doc_id"), row.column("key"), pa.array([j], pa.int32()), pa.array([at + size >= len(text)]), data], names=["doc_id", "key", "chunk", "last", "data"])

    return docs.select("doc_id", "key", "text").mapInArrow(run, "doc_id long, key string, chunk int, last boolean, data binary")


def _cuts(long_docs: DataFrame, size: int) -> DataFrame:
    """key, n and cuts (bytes before the first and the second) of every text of long_docs."""
    spark = long_docs.sparkSession
    many = partitions(long_docs)
    chunks = materialize(chunked(long_docs.dropDuplicates(["key"]), size).repartition(many, "key", "chunk"), "chunks")

    def ends(data: bytes, last: bool) -> np.ndarray:
        found = boundaries(np.frombuffer(data, np.uint8))
        return np.append(found, len(data)) if last else found

    def count(batches):
        for b in batches:
            n = [len(ends(d, x)) for d, x in zip(b.column("data").to_pylist(), b.column("last").to_pylist(), strict=True)]
            yield pa.record_batch([*(b.column(c) for c in ("doc_id", "key", "chunk")), pa.array(n, pa.int64())], names=["doc_id", "key", "chunk", "here"])

    def scan(batches):
        for b in batches:
            places = [int(ends(d, x)[r - 1]) for d, x, r in zip(b.column("data").to_pylist(), b.column("last").to_pylist(), b.column("nth").to_pylist(), strict=True)]
            yield pa.record_batch([b.column("key"), b.column("n"), b.column("cut"), pa.array(b.column("chunk").to_numpy().astype(np.int64) * size + np.array(places, np.int64))], names=["key", "n", "cut", "place"])

    counts = chunks.mapInArrow(count, "doc_id long, key string, chunk int, here long")
    upto = W.partitionBy("key").orderBy("chunk").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = counts.withColumns({"upto": F.sum("here").over(upto), "n": F.sum("here").over(W.partitionBy("key"))})
    low, high = ranks(F.col("doc_id"), F.col("n"))
    routed = materialize(summed.withColumn("cut", F.explode(F.array(F.struct(F.lit(0).alias("no"), low.alias("rank")), F.struct(F.lit(1).alias("no"), high.alias("rank"))))).where(
        (F.col("cut.rank") <= F.col("upto")) & ((F.col("cut.rank") > F.col("upto") - F.col("here")) | (F.col("cut.rank") == 0) & (F.col("chunk") == 0))
    ), "cuts")
    at_start = routed.where("cut.rank = 0").select("key", "n", F.col("cut.no").alias("cut"), F.lit(0).cast("long").alias("place"))
    owners = routed.where("cut.rank > 0").select("key", "chunk", "n", F.col("cut.no").alias("cut"), (F.col("cut.rank") - F.col("upto") + F.col("here")).alias("nth"))
    found = chunks.drop("doc_id").join(owners, ["key", "chunk"]).select("key", "chunk", "last", "data", "n", "cut", "nth")
    places = at_start.unionAll(found.mapInArrow(scan, "key string, n long, cut int, place long"))
    return places.groupBy("key").agg(F.max("n").alias("n"), F.min("place").alias("a"), F.max("place").alias("b"))


def _long(docs: DataFrame, size: int, with_output: bool) -> DataFrame:
    """Texts of more than one chunk."""

    def run(batches):
        for b in batches:
            cuts = zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)
            yield _record(b.column("doc_id"), b.column("n"), b.column("form").to_pylist(), [bytes(v) for v in _views(b.column("text"))], cuts, with_output)

    keyed = docs.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2(F.col("text"), 256)))
    return keyed.join(_cuts(keyed, size), "key").select("doc_id", "text", "form", "n", "a", "b").mapInArrow(run, _OUT + ", output string" * with_output)


def transformed(docs: DataFrame, size: int | None = None, with_output: bool = True) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, the hashes of output and restored text, and (with_output) the output of every row of docs (doc_id, text)."""
    size = size or CHUNK
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("form", form(F.col("doc_id"), F.col("text")))
    one = F.octet_length("text") <= size
    short, over = _short(rows.where(one), with_output), rows.where(~one)
    return short if over.isEmpty() else short.unionAll(_long(over, size, with_output))


def op12(spark, sf_dir: str) -> DataFrame:
    return transformed(read(spark, sf_dir, "documents"), with_output=False)


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents
), r AS (
  SELECT *, len(tokens) AS n, ('0x' || h[1:8])::BIGINT % (len(tokens) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(tokens) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT *, array_to_string(tokens[1:least(x, y)], '') AS prefix, array_to_string(tokens[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(tokens[greatest(x, y) + 1:], '') AS suffix
  FROM r
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
