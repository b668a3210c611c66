"""WARC archives as chunked record tables.

Writing. A page becomes one WARC/1.1 record; of pages with equal payloads (of at least min_bytes) the one with the
smallest page_id is a response and the others are revisits that refer to it. A payload is cut into chunks, each a row
(record, chunk number) and each a record segment in the archive (WARC-Segment-Number, continuation records), so no
archive record is larger than CHUNK bytes and its headers. Every segment has its own block digest and the last one
checks the payload's running digest against its header. Spark's text writer puts the rows into part files of any file
system, with the blank lines that end a record as row separator.

Reading. Spark's text reader splits archives, wherever a split falls, at the version line. Chunks are cut so that no
payload contains that line whole. Payloads of one segment are digested where they are; the chunks of others are sorted by
record and number and stream through an incremental digest, one chunk in memory at a time.

Equal payloads are found by SHA-1 and length: digests are grouped with map-side minima, and only digests that repeat
are joined back, broadcast if there are BROADCAST_DIGESTS at most.

Defined results: null payloads are empty ones; null or odd URLs are left out or percent-encoded; a null page_id comes
last among equals and gives a null page_id back; repeated rows give a record each, and all rows with the smallest
page_id of a payload are responses; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.texts import read
from gleaner.plans.storage import new_path

VERSION = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
CHUNK = 1 << 18
#: Bytes of chunks that a batch of rows holds at most.
BATCH = 1 << 22
BROADCAST_DIGESTS = 200_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}" + BLANK


def base32(hex_: Column) -> Column:
    """Bare upper-case base32 of 40 hex digits: four times ten of them, 40 bits, are eight digits to the base 32."""
    ten = lambda g: F.lpad(F.conv(F.substring(hex_, 10 * g + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*map(ten, range(4))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def once(value: Column, use) -> Column:
    """use(value), where value is computed once however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a string's SHA-1."""
    return once(F.sha1(payload), base32)


def cuts(payload: memoryview, size: int) -> list[int]:
    """Ends of chunks: at most size bytes each, on code points, never the whole version line in one."""
    ends, at, stop = [], 0, len(payload)
    lines = re.finditer(re.escape(VERSION.encode()), payload)
    found = next(lines, None)
    while at < stop:
        end = min(at + size, stop)
        while found and found.start() + 7 <= at:  # an end stands in it already
            found = next(lines, None)
        if found and found.start() < end - 7:
            end = found.start() + 7
            found = next(lines, None)
        while end < stop and payload[end] & 0xC0 == 0x80:
            end -= 1
        ends.append(end)
        at = end
    return ends or [0]


def _digest(sha) -> str:
    return base64.b32encode(sha.digest()).decode()


def _segments(page_id, url, payload: memoryview, n_bytes: int, digest: str, refers, revisit: bool, name: str, size: int):
    """Chunk number, digest of the payload up to the chunk's end, and record text of a page's record, a chunk at a time."""
    ends = [0] if revisit else cuts(payload, size)
    running, at = hashlib.sha1(), 0
    for k, end in enumerate(ends):
        body = payload[at:end] if not revisit else b""
        at = end
        running.update(body)
        block = (HTTP.format(n_bytes).encode() if k == 0 else b"") + bytes(body)
        head = [f"WARC-Type: {'revisit' if revisit else 'response' if k == 0 else 'continuation'}", f"WARC-Record-ID: <{name}{f':{k}' if k else ''}>", "WARC-Date: 1970-01-01T00:00:00Z"]
        head += [f"WARC-Block-Digest: sha1:{_digest(hashlib.sha1(block))}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
        if k == 0:
            head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-X-Payload-Length: {n_bytes}"]
            head += [f"WARC-X-Page: {page_id}"] * (page_id is not None) + [f"WARC-Target-URI: {url}"] * (url is not None)
            head += [f"WARC-Profile: {PROFILE}"] * revisit + [f"WARC-X-Refers-To-Page: {refers}"] * (revisit and refers is not None)
        else:
            head.append(f"WARC-Segment-Origin-ID: <{name}>")
        if len(ends) > 1:
            head += [f"WARC-Segment-Number: {k + 1}"] + [f"WARC-Segment-Total-Length: {n_bytes}"] * (k == len(ends) - 1)
        yield k, _digest(running), VERSION + "\r\n".join(head) + BLANK + block.decode()
    if not revisit and _digest(running) != digest:
        raise ValueError(f"page {page_id}: the payload changed while it was written")


def chunks(pages: DataFrame, min_bytes: int = 0, size: int = CHUNK, broadcast_digests: int = BROADCAST_DIGESTS) -> DataFrame:
    """record, chunk_no, running_digest (of the payload up to the chunk's end) and value (the segment's text): the chunked record table of the archives."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    df = pages.select(F.col("page_id").cast("long"), url.alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("n_bytes"), F.sha1(payload).alias("hex"))
    again = df.where(F.col("n_bytes") >= min_bytes).groupBy("hex", "n_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    small = again.limit(broadcast_digests + 1).count() <= broadcast_digests
    df = df.join(F.broadcast(again) if small else again, ["hex", "n_bytes"], "left")
    df = df.select("page_id", "url", "payload", "n_bytes", once(F.col("hex"), base32).alias("digest"), "first", F.coalesce(F.col("first") != F.col("page_id"), F.col("first").isNotNull()).alias("revisit"))

    def run(batches):
        part, n, out, held = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            cols = [b.column(k) for k in range(7)]
            for i in range(b.num_rows):
                page, url, body, n_bytes, digest, first, revisit = (c[i].as_py() if k != 2 else c[i].as_buffer() for k, c in enumerate(cols))
                name, n = f"urn:page:{page}:{part}-{n}", n + 1
                for k, running, value in _segments(page, url, memoryview(body), n_bytes, digest, first, revisit, name, size):
                    out.append((name, k, running, value))
                    held += len(value)
                    if held >= BATCH:
                        yield _batch(out)
                        out, held = [], 0
        if out:
            yield _batch(out)

    return df.mapInArrow(run, "record string, chunk_no int, running_digest string, value string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, numbers, digests, values = zip(*rows, strict=True)
    return pa.record_batch([pa.array(names, pa.string()), pa.array(numbers, pa.int32()), pa.array(digests, pa.string()), pa.array(values, pa.string())], names=["record", "chunk_no", "running_digest", "value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, size: int = CHUNK) -> None:
    chunks(pages, min_bytes, size).select("value").write.option("lineSep", BLANK).text(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """A row per archive record: its header fields and block."""
    df = spark.read.option("lineSep", VERSION).text(path).where(F.length("value") > 0)
    at = F.instr("value", BLANK)
    rest = F.expr("substring(value, _at + 4)")
    df = df.withColumn("_at", at).withColumn("head", F.expr("left(value, _at + 1)")).withColumn("_rest", rest)
    df = df.withColumn("block", F.expr("left(_rest, length(_rest) - 4)"))
    field = lambda name, of="[^\\r\\n]+": F.nullif(F.regexp_extract("head", rf"(?:^|\n){name}: ({of})\r", 1), F.lit(""))
    df = df.select(
        F.regexp_extract("head", r"(?:^|\n)WARC-Type: (\w+)", 1).alias("type"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record"),
        F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(0)).alias("segment"),
        field("WARC-X-Page").cast("long").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-X-Refers-To-Page").cast("long").alias("refers_to"),
        F.regexp_extract("head", "WARC-Payload-Digest: sha1:([A-Z2-7]+)", 1).alias("stated"),
        field("WARC-X-Payload-Length").cast("long").alias("stated_bytes"),
        F.when(field("Content-Length").cast("long") == F.octet_length("block"), F.col("block")).otherwise(F.raise_error(F.lit("an archive record is torn"))).alias("block"),
    )
    first = F.col("segment") <= 1
    return df.withColumn("payload", F.when(first, F.expr(f"substring(block, instr(block, '\\r\\n\\r\\n') + 4)")).otherwise(F.col("block"))).drop("block")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per page: page_id, url, payload_bytes, payload_digest, record_type and refers_to, digests computed anew."""
    df = read_segments(spark, path)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "stated", "stated_bytes"]
    whole = df.where("type <> 'continuation' and segment = 0")
    revisit = F.col("type") == "revisit"
    whole = whole.select("page_id", "url", F.when(revisit, F.col("stated_bytes")).otherwise(F.octet_length("payload")).cast("long").alias(names[2]), F.when(revisit, F.col("stated")).otherwise(base32_sha1(F.col("payload"))).alias(names[3]), F.col("type").alias(names[4]), "refers_to", "stated", "stated_bytes")

    def run(batches):
        now, row, sha, size = None, None, None, 0

        def done():
            return pa.RecordBatch.from_pylist([dict(zip(names, (row["page_id"], row["url"], size, _digest(sha), row["type"], row["refers_to"], row["stated"], row["stated_bytes"]), strict=True))], schema=schema)

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("stated", pa.string()), ("stated_bytes", pa.int64())])
        for b in batches:
            for i in range(b.num_rows):
                if (name := b.column("record")[i].as_py()) != now:
                    if now is not None:
                        yield done()
                    now, sha, size = name, hashlib.sha1(), 0
                    row = {c: b.column(c)[i].as_py() for c in ("page_id", "url", "type", "refers_to", "stated", "stated_bytes")}
                part = b.column("payload")[i].as_buffer()
                sha.update(part)
                size += len(part)
        if now is not None:
            yield done()

    parts = df.where("segment > 0").repartition("record").sortWithinPartitions("record", "segment")
    parts = parts.select("record", "page_id", "url", "type", "refers_to", "stated", "stated_bytes", "payload")
    joined = parts.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, stated string, stated_bytes long")
    both = whole.unionByName(joined)
    same = (F.col("stated") == F.col("payload_digest")) & (F.col("stated_bytes") == F.col("payload_bytes"))
    return both.withColumn("payload_digest", F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload differs from its stated digest")))).drop("stated", "stated_bytes")


def op5(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32: one letter for each five bits of the 160, four letters to a group of five hex digits.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * (k // 4)::INT + 1, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
