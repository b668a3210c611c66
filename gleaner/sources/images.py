"""Image bytes: format, size and completeness from the bytes, perceptual hash from pixels."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEASURED = "format string, width int, height int, status string"


def _png(b: bytes):
    at, size = 8, None
    while at + 12 <= len(b):
        n, kind = struct.unpack(">I4s", b[at : at + 8])
        body = b[at + 8 : at + 8 + n]
        if len(body) < n or at + 12 + n > len(b):
            break
        if zlib.crc32(kind + body) != struct.unpack(">I", b[at + 8 + n : at + 12 + n])[0]:
            return size, "unreadable" if kind == b"IHDR" else "truncated"
        if kind == b"IHDR":
            size = struct.unpack(">II", body[:8])
        if kind == b"IEND":
            return size, None
        at += 12 + n
    return size, "truncated"


def _jpeg(b: bytes):
    at, size, scan = 2, None, False
    while at + 4 <= len(b):
        if b[at] != 0xFF:
            return size, "unreadable"
        mark = b[at + 1]
        if mark == 0xFF:
            at += 1
            continue
        if mark in (0x01, *range(0xD0, 0xD9)):
            at += 2
            continue
        n = struct.unpack(">H", b[at + 2 : at + 4])[0]
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC) and at + 9 <= len(b):
            h, w = struct.unpack(">HH", b[at + 5 : at + 9])
            size = (w, h)
        if mark == 0xDA:
            scan = True
            break
        at += 2 + n
    done = b.rstrip(b"\x00\r\n")[-2:] == b"\xff\xd9"
    return size, None if size and scan and done else "truncated" if size else "unreadable"


def _webp(b: bytes):
    kind, size = b[12:16], None
    if kind == b"VP8X" and len(b) >= 30:
        size = (1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little"))
    elif kind == b"VP8L" and len(b) >= 25:
        v = int.from_bytes(b[21:25], "little")
        size = ((v & 0x3FFF) + 1, ((v >> 14) & 0x3FFF) + 1)
    elif kind == b"VP8 " and len(b) >= 30:
        w, h = struct.unpack("<HH", b[26:30])
        size = (w & 0x3FFF, h & 0x3FFF)
    return size, None if struct.unpack("<I", b[4:8])[0] + 8 <= len(b) else "truncated"


def _tiff(b: bytes):
    order = "<" if b[:2] == b"II" else ">"
    at = struct.unpack(order + "I", b[4:8])[0]
    if at + 2 > len(b):
        return None, "truncated"
    tags = {}
    for k in range(struct.unpack(order + "H", b[at : at + 2])[0]):
        entry = b[at + 2 + 12 * k : at + 14 + 12 * k]
        if len(entry) < 12:
            return None, "truncated"
        tag, kind, n = struct.unpack(order + "HHI", entry[:8])
        tags[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), entry[8 : 10 if kind == 3 else 12])[0], n
    size = (tags[256][0], tags[257][0]) if 256 in tags and 257 in tags else None
    one = 273 in tags and 279 in tags and tags[273][1] == 1
    return size, "truncated" if one and tags[273][0] + tags[279][0] > len(b) else None


def measure(b: bytes | None) -> tuple[str | None, int | None, int | None, str | None]:
    """(format, width, height, status); status is null for whole images, else unreadable or truncated."""
    b = b or b""
    try:
        if b[:8] == b"\x89PNG\r\n\x1a\n":
            name, (size, bad) = "PNG", _png(b)
        elif b[:2] == b"\xff\xd8":
            name, (size, bad) = "JPEG", _jpeg(b)
        elif b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
            name, size, bad = "GIF", struct.unpack("<HH", b[6:10]), None if b.rstrip(b"\x00")[-1:] == b";" else "truncated"
        elif b[:2] == b"BM" and len(b) >= 26:
            w, h = struct.unpack("<ii", b[18:26])
            name, size, bad = "BMP", (w, abs(h)), None if struct.unpack("<I", b[2:6])[0] <= len(b) else "truncated"
        elif b[:4] == b"RIFF" and b[8:12] == b"WEBP":
            name, (size, bad) = "WEBP", _webp(b)
        elif b[:4] in (b"II*\x00", b"MM\x00*"):
            name, (size, bad) = "TIFF", _tiff(b)
        else:
            return None, None, None, "unreadable"
    except (struct.error, IndexError):
        return None, None, None, "truncated"
    return (name, *size, bad) if size else (name, None, None, bad or "unreadable")


def with_measures(df: DataFrame) -> DataFrame:
    """df with content (binary) measured: format, width, height and status."""

    @F.pandas_udf(MEASURED)
    def run(content: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([measure(bytes(b) if b is not None else None) for b in content], columns=["format", "width", "height", "status"])
        return out.astype({"width": "Int32", "height": "Int32"})

    return df.withColumn("_m", run("content")).select(*df.columns, "_m.*")


def _matrix(n: int = 32) -> np.ndarray:
    k = np.arange(n)
    return np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))


def phash(pixels: np.ndarray) -> str:
    """64-bit perceptual hash of a height x width (x channels, BGR) array: luminance, area average to 32 x 32, DCT, the 8 x 8 low block against its median."""
    grey = pixels.astype(float)
    if grey.ndim == 3:
        grey = grey[:, :, 0] if grey.shape[2] == 1 else grey[:, :, :3] @ np.array([0.114, 0.587, 0.299])
    for axis in (0, 1):
        n = grey.shape[axis]
        sums = np.concatenate((np.zeros_like(np.take(grey, [0], axis)), np.cumsum(grey, axis)), axis)
        edge = np.linspace(0, n, 33)
        lo = np.minimum(edge.astype(int), n - 1)
        at = np.take(sums, lo, axis) + np.take(grey, lo, axis) * np.expand_dims(edge - lo, 1 - axis)
        grey = np.diff(at, axis=axis) * 32 / n
    m = _matrix()
    low = (m @ grey @ m.T)[:8, :8].ravel()
    return f"{int(''.join('1' if x else '0' for x in low > np.median(low)), 2):016x}"


def with_phash(df: DataFrame) -> DataFrame:
    """df with image (Spark's image struct); adds phash, null where there are no pixels."""

    @F.pandas_udf("string")
    def run(h: pd.Series, w: pd.Series, c: pd.Series, data: pd.Series) -> pd.Series:
        shape = zip(h, w, c, data, strict=True)
        return pd.Series([phash(np.frombuffer(d, np.uint8).reshape(int(a), int(b), int(n))) if d is not None and a > 0 else None for a, b, n, d in shape])

    return df.withColumn("phash", run("image.height", "image.width", "image.nChannels", "image.data"))


def read_assets(spark: SparkSession, path: str, since=None) -> DataFrame:
    """storage_path, sha256, file_size_bytes, extension, measures and phash of the files under path (written after since, a time in UTC), in one pass over bytes and one over pixels."""
    newer = {"modifiedAfter": since.strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"} if since else {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").options(**newer).load(path)
    df = files.select(F.col("path").alias("storage_path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_size_bytes"), F.regexp_extract("path", r"(\.[^./]+)$", 1).alias("extension"), "content")
    df = with_measures(df).drop("content")
    pixels = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", True).options(**newer).load(path)
    pixels = with_phash(pixels.select("image")).select(F.col("image.origin").alias("storage_path"), "phash")
    key = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    return df.withColumn("_k", key("storage_path")).join(pixels.select(key("storage_path").alias("_k"), "phash"), "_k", "left").drop("_k").withColumn("phash", F.when(F.col("status").isNull(), F.col("phash")))
