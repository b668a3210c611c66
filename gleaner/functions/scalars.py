"""Scalar semantics as column expressions; none needs Python on executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "webp", "gif", "bmp", "tif", "tiff"]
EXTENSION_FORMATS = {
    "jpg": "JPEG", "jpeg": "JPEG", "jpe": "JPEG", "jfif": "JPEG", "png": "PNG",
    "webp": "WEBP", "gif": "GIF", "bmp": "BMP", "tif": "TIFF", "tiff": "TIFF",
}
FORMAT_SUFFIXES = {"JPEG": ".jpg", "PNG": ".png", "WEBP": ".webp", "GIF": ".gif", "BMP": ".bmp", "TIFF": ".tif"}
AUTHORITY_MARKS = r"(?i)\b(Authority\s*file|VIAF\b|ISNI\b|LCCN\b|GND\b|SUDOC\b|ULAN\b|QS:P)"
MAX_CREDIT = 200


def stripped(x: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def present(x: Column) -> Column:
    """Null for null and for the empty string."""
    return F.nullif(x, F.lit(""))


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def split_score(sha256: Column, salt: str) -> Column:
    """The first 64 bits of SHA-256 of salt:sha256, as a share of 2^64 (1.0 is possible through rounding)."""
    head = F.substring(F.sha2(F.concat(F.lit(salt + ":"), sha256), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def fetch_limit(needed: Column, overfetch: float) -> Column:
    """needed * overfetch, halves to even, at least 0."""
    return F.greatest(F.lit(0), F.bround(needed * F.lit(overfetch)).cast("long"))


def is_image_url(url: Column) -> Column:
    return F.lower(F.split_part(url, F.lit("?"), F.lit(1))).rlike(rf"\.({'|'.join(IMAGE_SUFFIXES)})$")


def url_extension(url: Column) -> Column:
    """The lower-cased suffix of the URL's path where it has 2 to 5 characters with its dot; .bin otherwise."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    suffix = F.regexp_extract(F.lower(path), r"[^/.][^/]*(\.[^./]+)$", 1)
    return F.when(F.length(suffix).between(2, 5), suffix).otherwise(".bin")


def storage_path(root: str, sha256: Column, extension: Column) -> Column:
    return F.concat(F.lit(root + "/"), F.substring(sha256, 1, 2), F.lit("/"), sha256, extension)


def relative_path(split: Column, label: Column, sha256: Column, format_: Column, path: Column) -> Column:
    """images/split/class/sha256 and the suffix of the measured format, else the stored one, else .jpg."""
    stored = present(F.regexp_extract(path, r"[^/.][^/]*(\.[^./]+)$", 1))
    suffix = F.coalesce(lookup(FORMAT_SUFFIXES, F.upper(F.coalesce(format_, F.lit("")))), stored, F.lit(".jpg"))
    return F.concat(F.lit("images/"), split, F.lit("/"), label, F.lit("/"), sha256, suffix)


def absolute(href: Column) -> Column:
    return F.regexp_replace(href, "^//", "https://")


def original_url(src: Column) -> Column:
    """A preview's URL without its thumbnail segment."""
    return F.regexp_replace(absolute(src), r"/thumb(/.+?\.\w+)/[^/]+$", "$1")


def title_of(url: Column) -> Column:
    """What follows the last File:, decoded, underscores as blanks."""
    name = F.element_at(F.split(url, "File:"), -1)
    return F.replace(F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name), F.lit("_"), F.lit(" "))


def credit_line(text: Column) -> Column:
    """An author cell as a credit: no authority record, blanks collapsed, at most MAX_CREDIT characters and cut at a word."""
    head = F.element_at(F.split(text, AUTHORITY_MARKS, 2), 1)
    clean = F.regexp_replace(F.regexp_replace(head, r"(?U)\s+", " "), "^[ ·,;–—-]+|[ ·,;–—-]+$", "")
    cut = F.substring(clean, 1, MAX_CREDIT)
    short = F.concat(F.when(F.contains(cut, F.lit(" ")), F.regexp_replace(cut, " [^ ]*$", "")).otherwise(cut), F.lit("…"))
    return present(F.when(F.length(clean) > MAX_CREDIT, short).otherwise(clean))


def retry_after(value: Column) -> Column:
    """Seconds; null for dates and anything else that is no number."""
    return value.try_cast("double")


def phash_bits(hex_: Column) -> Column:
    """16 hex digits as a long of the same bits."""
    return F.conv(hex_, 16, -10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two hex codes; all bits of the first if they differ in length."""
    return F.when(F.length(a) == F.length(b), F.bit_count(phash_bits(a).bitwiseXOR(phash_bits(b)))).otherwise(F.length(a) * 4)
