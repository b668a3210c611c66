"""The registered queries, on the driver's tables, and their SQL for the comparing engine.

Stand-ins: a document is an asset (its SHA-256, language as class, characters and words as width and height); the signs
of an embedding against its median are a perceptual code; a user of events is a run, an event a metric or a rejection.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.config import Dedupe, License, Source, Split, Validation
from gleaner.functions import licenses, scalars
from gleaner.operators import curate, neardup
from gleaner.plans import export, store, views
from gleaner.plans.codeindex import CodeIndex
from gleaner.plans.storage import new_path
from gleaner.sources import api, html

QUERIES: dict = {}
ORACLES: dict = {}

def licence_texts() -> list[str]:
    """Ways to write a licence, by rule: each set of elements in each form, versions and noise in turn, marks, and texts that are no licence."""
    names = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivs", "sa": "ShareAlike"}
    forms = [
        lambda e, v: "-".join([*e, v]), lambda e, v: f"CC {'-'.join(e).upper()} {v}", lambda e, v: "_".join(e).upper(),
        lambda e, v: f"Creative Commons {'-'.join(names[x] for x in e)} {v}", lambda e, v: f" {'-'.join(e)} {v} or later",
    ]
    sets = [e for k in range(1, 5) for e in combinations(names, k)]
    out = [form(e, ("1.0", "2.0", "2.5", "3.0", "4.0")[(i + j) % 5]) for i, e in enumerate(sets) for j, form in enumerate(forms)]
    marks = [f"{mark}{end}" for mark in ("cc0", "pdm", "Public domain") for end in ("", " (checked)", ", non-commercial")]
    return [*out, *marks, "", "GFDL", "rights: ask"]


LICENSES = licence_texts()
SUFFIXES = ["jpg", "JPEG?w=300", "png#top", "webp", "svg", "jpg.html", "", "tif", "verylong"]
FORMATS = ["JPEG", "PNG", "WEBP", "GIF", "SVG"]
STATUSES = [None, None, None, "truncated", None, "unreadable", None]
DEEDS = [
    "https://creativecommons.org/licenses/by-sa/3.0/", "//creativecommons.org/publicdomain/zero/1.0/", "https://creativecommons.org/publicdomain/mark/1.0/",
    "https://creativecommons.org/licenses/by-nc-nd/", "https://example.org/terms",
]
CREDITS = ["Ola  Brandt ", " · K. Venn — ", "Harbour Archive VIAF 907", "", "Authority file"]
TARGET = Source(target=60, minimum=40)
CODE_DISTANCE = 16


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _dealt(values: list, by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (by % len(values) + 1).cast("int"))


def _sql_dealt(values: list, by: str) -> str:
    return "([" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + f"])[{by} % {len(values)} + 1]"


def assets(spark: SparkSession, d: str) -> DataFrame:
    df = _read(spark, d, "documents")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return df.select(
        "doc_id", F.sha2("text", 256).alias("sha256"), F.col("lang").alias("class_label"), "source", F.col("doc_id").cast("string").alias("source_id"),
        F.concat(F.lit("https://"), "source", F.lit(".example.org/a.b/"), "doc_id", F.lit("."), _dealt(SUFFIXES, F.col("doc_id"))).alias("image_url"),
        F.col("n_chars").cast("int").alias("width"), words.cast("int").alias("height"), F.octet_length("text").cast("long").alias("file_size_bytes"),
        _dealt(LICENSES, F.col("doc_id")).alias("license_raw"), _dealt(CREDITS, F.col("doc_id")).alias("attribution"),
    )


A = f"""a AS (SELECT doc_id, sha256(text) AS sha256, lang AS class_label, source, doc_id::VARCHAR AS source_id,
  'https://' || source || '.example.org/a.b/' || doc_id || '.' || {_sql_dealt(SUFFIXES, "doc_id")} AS image_url, n_chars::INT AS width,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::INT AS height, strlen(text)::BIGINT AS file_size_bytes,
  {_sql_dealt(LICENSES, "doc_id")} AS license_raw, {_sql_dealt(CREDITS, "doc_id")} AS attribution FROM documents)"""
U = f"{A}, u AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY doc_id) = 1)"
SCORE = f"(('0x' || substr(sha256('{Split().salt}:' || sha256), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


def unique(spark: SparkSession, d: str) -> DataFrame:
    return curate.exact_dedup(assets(spark, d), [F.col("doc_id")]).kept


# Exact duplicates ---------------------------------------------------------------------------------------------------
@query(f"WITH {U} SELECT doc_id, sha256, class_label, source FROM u")
def exact_dedup(spark, d):
    return unique(spark, d).select("doc_id", "sha256", "class_label", "source")


@query(f"WITH {U} SELECT 'download' AS stage, source, class_label, source_id, image_url AS source_url, 'EXACT_DUPLICATE' AS reason_code FROM a WHERE doc_id NOT IN (SELECT doc_id FROM u)")
def exact_duplicate_rejections(spark, d):
    return curate.exact_dedup(assets(spark, d), [F.col("doc_id")]).rejections.drop("detail")


# Splits -------------------------------------------------------------------------------------------------------------
@query(f"WITH {U} SELECT sha256, {SCORE} AS score FROM u")
def split_score(spark, d):
    return unique(spark, d).select("sha256", scalars.split_score(F.col("sha256"), Split().salt).alias("score"))


def _ranked(group: str) -> str:
    return f"""{U}, r AS (SELECT sha256, class_label, row_number() OVER (PARTITION BY {group} ORDER BY {SCORE}, sha256) AS k, count(*) OVER (PARTITION BY {group}) AS n FROM u),
s AS (SELECT sha256, class_label, CASE WHEN k <= CASE WHEN n > 1 THEN greatest(1, least(n - 1, round_even(n * 80 / 100.0, 0)::BIGINT)) ELSE n END THEN 'train' ELSE 'val' END AS split FROM r)"""


@query(f"WITH {_ranked('class_label')} SELECT class_label, split, count(*) AS n FROM s GROUP BY ALL")
def split_stratified(spark, d):
    return curate.assign_split(unique(spark, d)).groupBy("class_label", "split").agg(F.count("*").alias("n"))


@query(f"WITH {_ranked('class_label')} SELECT sha256, class_label, split FROM s")
def split_rows(spark, d):
    return curate.assign_split(unique(spark, d)).select("sha256", "class_label", "split")


@query(f"WITH {_ranked('1')} SELECT sha256, split FROM s")
def split_global(spark, d):
    return curate.assign_split(unique(spark, d), Split(stratify=False)).select("sha256", "split")


@query(f"WITH {U} SELECT sha256, CASE WHEN {SCORE} < 0.8 THEN 'train' ELSE 'val' END AS split FROM u")
def split_stable_bucket(spark, d):
    return curate.assign_split(unique(spark, d), Split(strategy="stable_bucket")).select("sha256", "split")


@query(f"WITH {_ranked('class_label')}, c AS (SELECT class_label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) AS n FROM s GROUP BY 1) SELECT class_label, train, val, ((2000 * train + n) // (2 * n)) / 10.0 AS train_pct FROM c")
def split_achieved(spark, d):
    return views.split_counts(curate.assign_split(unique(spark, d)))


@query(f"WITH {_ranked('class_label')} SELECT sha256, split FROM s JOIN u USING (sha256) WHERE split IS DISTINCT FROM CASE WHEN doc_id % 2 = 0 THEN 'train' END")
def resplit(spark, d):
    images = unique(spark, d).withColumns({"duplicate_of": F.lit(None).cast("string"), "split": F.when(F.col("doc_id") % 2 == 0, "train")})
    return curate.resplit(images)


# Licences -----------------------------------------------------------------------------------------------------------
def _quoted(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def norm_sql(raw: str) -> str:
    t = rf"regexp_replace({raw}, '^\s+|\s+$', '', 'g')"
    q, low = _quoted, f"lower({t})"
    version = f"coalesce(nullif(regexp_extract({t}, {{}}, {{}}), ''), '4.0')"
    order = "['BY', 'NC', 'ND', 'SA']"
    coded = rf"list_filter({order}, lambda e: list_contains(regexp_split_to_array(upper(regexp_extract({t}, {q(licenses.CODED)}, 1)), '[-\s_]+'), e))"
    named = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({t}, {q(p)}) THEN '{e}' END" for e, p in licenses.LONG_FORM.items()) + "], lambda e: e IS NOT NULL)"
    return f"""CASE WHEN regexp_matches({low}, {q(licenses.ZERO)}) THEN CASE WHEN NOT regexp_matches({low}, {q(licenses.RESTRICTED)}) THEN 'CC0-1.0' END
  WHEN regexp_matches({low}, {q(licenses.PUBLIC)}) THEN CASE WHEN NOT regexp_matches({low}, {q(licenses.RESTRICTED)}) THEN 'PDM-1.0' END
  WHEN regexp_matches({t}, {q(licenses.CODED)}) THEN 'CC-' || array_to_string({coded}, '-') || '-' || {version.format(q(licenses.CODED), 2)}
  WHEN regexp_matches({t}, {q(licenses.MARKER)}) AND regexp_matches({t}, {q(licenses.LONG_FORM["BY"])})
    THEN 'CC-' || array_to_string({named}, '-') || '-' || {version.format(q(licenses.LONG_VERSION), 1)} END"""


L = f"{A}, l AS (SELECT *, {norm_sql('license_raw')} AS license FROM a)"
ELEMENTS = "CASE WHEN license LIKE 'CC-%' THEN list_filter(['BY', 'NC', 'ND', 'SA'], lambda e: list_contains(string_split(substr(license, 4), '-'), e)) ELSE [] END"
GATE = f"CASE WHEN license IS NULL THEN 'UNRECOGNISED_LICENSE' WHEN list_has_any({ELEMENTS}, ['NC', 'ND']) THEN 'LICENSE_NOT_PERMITTED' END"


@query(f"WITH {L} SELECT doc_id, license_raw, license FROM l")
def license_normalise(spark, d):
    return assets(spark, d).select("doc_id", "license_raw", licenses.normalise_license(F.col("license_raw")).alias("license"))


@query(f"WITH {L} SELECT doc_id, array_to_string({ELEMENTS}, '+') AS elements FROM l WHERE license IS NOT NULL")
def license_elements(spark, d):
    df = assets(spark, d).withColumn("license", licenses.normalise_license(F.col("license_raw"))).where("license is not null")
    return df.select("doc_id", F.array_join(licenses.license_elements(F.col("license")), "+").alias("elements"))


@query(f"WITH {L} SELECT source, class_label, source_id, {GATE} AS reason_code FROM l WHERE {GATE} IS NOT NULL")
def license_gate(spark, d):
    out = curate.normalize(assets(spark, d).withColumn("landing_url", F.lit("")), License())
    return out.rejections.select("source", "class_label", "source_id", "reason_code")


@query(f"WITH {L} SELECT license, count(*) AS n FROM l WHERE {GATE} IS NULL GROUP BY 1")
def license_breakdown(spark, d):
    return export.license_breakdown(curate.normalize(assets(spark, d).withColumn("landing_url", F.lit(""))).kept)


@query(f"WITH {L} SELECT doc_id, CASE WHEN license LIKE 'CC-BY%' AND attribution = '' THEN 'Unknown author (see ' || image_url || ')' ELSE nullif(attribution, '') END AS attribution FROM l WHERE {GATE} IS NULL")
def attribution_placeholder(spark, d):
    return curate.normalize(assets(spark, d).withColumn("landing_url", F.lit(""))).kept.select("doc_id", "attribution")


@query(f"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'by-sa-3.0' WHEN 1 THEN 'cc0' WHEN 2 THEN 'public domain' WHEN 3 THEN 'by-nc-nd' END AS licence,
CASE doc_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 3 END AS restrictiveness,
regexp_replace({_sql_dealt(DEEDS, "doc_id")}, '^//', 'https://') AS url FROM documents""")
def deed_license(spark, d):
    href = _dealt(DEEDS, F.col("doc_id"))
    licence = licenses.deed_license(href)
    return _read(spark, d, "documents").select("doc_id", licence.alias("licence"), F.when(licence.isNotNull(), licenses.restrictiveness(licence)).alias("restrictiveness"), scalars.absolute(href).alias("url"))


# Validation ---------------------------------------------------------------------------------------------------------
def _measured(spark, d):
    by = F.col("doc_id")
    return assets(spark, d).withColumns({"format": _dealt(FORMATS, by), "extension": _dealt(SUFFIXES, by), "status": _dealt(STATUSES, by)})


EXPECTED = "CASE lower(ext) WHEN 'jpg' THEN 'JPEG' WHEN 'jpeg' THEN 'JPEG' WHEN 'png' THEN 'PNG' WHEN 'webp' THEN 'WEBP' WHEN 'tif' THEN 'TIFF' END"
V = f"""{A}, m AS (SELECT *, {_sql_dealt(FORMATS, "doc_id")} AS format, {_sql_dealt(SUFFIXES, "doc_id")} AS ext, {_sql_dealt(STATUSES, "doc_id")} AS status FROM a),
v AS (SELECT *, CASE WHEN file_size_bytes < 1024 THEN 'FILESIZE_TOO_SMALL' WHEN width::BIGINT * height > 100000000 THEN 'IMAGE_BOMB' WHEN status = 'unreadable' THEN 'UNREADABLE_IMAGE'
  WHEN status = 'truncated' THEN 'TRUNCATED_IMAGE' WHEN format = 'SVG' THEN 'UNSUPPORTED_FORMAT' WHEN {EXPECTED} IS NOT NULL AND {EXPECTED} <> format THEN 'EXTENSION_MISMATCH'
  WHEN least(width, height) < 64 THEN 'DIMENSIONS_TOO_SMALL' WHEN greatest(width, height) > 8000 THEN 'DIMENSIONS_TOO_LARGE'
  WHEN least(width, height) > 0 AND greatest(width, height)::DOUBLE / least(width, height) > 6.0 THEN 'ASPECT_RATIO_EXTREME' END AS reason_code FROM m)"""


@query(f"WITH {V} SELECT doc_id, reason_code FROM v")
def validate_reason(spark, d):
    return _measured(spark, d).select("doc_id", curate.validation_reason(Validation()).alias("reason_code"))


@query(f"WITH {V} SELECT 'validate' AS stage, reason_code, count(*) AS n FROM v WHERE reason_code IS NOT NULL GROUP BY ALL")
def validate_breakdown(spark, d):
    return views.rejection_breakdown(curate.validate(_measured(spark, d)).rejections)


# Selection ----------------------------------------------------------------------------------------------------------
def _linked(spark, d):
    """Unique assets, some of them marked as duplicates of the one before them in their class."""
    before = F.lag("sha256").over(W.partitionBy("class_label").orderBy("sha256"))
    return unique(spark, d).withColumn("duplicate_of", F.when(F.substring("sha256", 1, 1) == "0", before))


def _selected(spark, d, stored: bool):
    df = _linked(spark, d)
    have = df.where((F.substring("sha256", 2, 1) == "a") & F.col("duplicate_of").isNull()) if stored else df.limit(0)
    return curate.select_target(df, views.class_counts(have), have.select("sha256"), TARGET, Split())


def _select_sql(stored: bool) -> str:
    return f"""{U}, k AS (SELECT *, CASE WHEN substr(sha256, 1, 1) = '0' THEN lag(sha256) OVER (PARTITION BY class_label ORDER BY sha256) END AS duplicate_of FROM u),
h AS (SELECT *, {"substr(sha256, 2, 1) = 'a' AND duplicate_of IS NULL" if stored else "false"} AS held FROM k),
c AS (SELECT class_label, count(*) FILTER (held) AS n FROM h GROUP BY 1),
r AS (SELECT h.*, row_number() OVER (PARTITION BY h.class_label, held OR duplicate_of IS NOT NULL ORDER BY {SCORE}, sha256) <= greatest(0, 60 - n) AS room FROM h JOIN c USING (class_label)),
ok AS (SELECT sha256 FROM r WHERE held OR (duplicate_of IS NULL AND room)),
s AS (SELECT sha256, class_label, source_id, duplicate_of, CASE WHEN duplicate_of IS NOT NULL THEN duplicate_of IN (SELECT sha256 FROM ok) ELSE held OR room END AS keep FROM r)"""


@query(f"WITH {_select_sql(False)} SELECT sha256, class_label FROM s WHERE keep")
def select_target(spark, d):
    return _selected(spark, d, False).kept.select("sha256", "class_label")


@query(f"WITH {_select_sql(False)} SELECT source_id, 'OVER_TARGET' AS reason_code FROM s WHERE NOT keep")
def select_over_target(spark, d):
    return _selected(spark, d, False).rejections.select("source_id", "reason_code")


@query(f"WITH {_select_sql(True)} SELECT sha256, class_label FROM s WHERE keep")
def select_with_stored(spark, d):
    return _selected(spark, d, True).kept.select("sha256", "class_label")


@query(f"WITH {_select_sql(True)} SELECT sha256, duplicate_of FROM s WHERE NOT keep AND duplicate_of IS NOT NULL")
def select_orphans(spark, d):
    return _selected(spark, d, True).extras["orphans"].select("sha256", "duplicate_of")


# Near duplicates ----------------------------------------------------------------------------------------------------
def codes(spark, d):
    df = _read(spark, d, "embeddings").withColumn("s", F.sort_array("embedding"))
    half = F.size("s") / 2
    middle = (F.element_at("s", half.cast("int")).cast("double") + F.element_at("s", (half + 1).cast("int")).cast("double")) / 2
    df = df.withColumn("m", middle)
    bits = F.transform("embedding", lambda v, i: F.when(v.cast("double") > F.col("m"), _bit(i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    df = df.withColumn("code", code)
    name = F.sha2(F.col("vec_id").cast("string"), 256)
    return df.select("vec_id", "code", name.alias("sha256"), F.lpad(F.lower(F.hex("code")), 16, "0").alias("phash"), (100 + F.col("vec_id") % 37).cast("int").alias("width"), F.lit(64).alias("height"), F.lit("openverse").alias("source"), F.col("label").cast("string").alias("class_label"), F.col("vec_id").cast("string").alias("source_id"))


def _bit(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(1 << k if k < 63 else -(1 << 63)).cast("long") for k in range(64)]), i + 1)


C = """c AS (SELECT vec_id, sha256(vec_id::VARCHAR) AS sha256, 100 + vec_id % 37 AS pixels, label,
  list_sum(list_transform(range(0, 32), lambda i: CASE WHEN embedding[i + 1]::DOUBLE > m THEN 1::BIGINT << i ELSE 0 END))::BIGINT AS lo,
  list_sum(list_transform(range(0, 32), lambda i: CASE WHEN embedding[i + 33]::DOUBLE > m THEN 1::BIGINT << i ELSE 0 END))::BIGINT AS hi
  FROM (SELECT *, (list_sort(embedding)[32]::DOUBLE + list_sort(embedding)[33]::DOUBLE) / 2 AS m FROM embeddings))"""
D = "(bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi)))"


@query(f"WITH {C} SELECT a.vec_id AS id_a, b.vec_id AS id_b, {D}::BIGINT AS distance FROM c a JOIN c b ON a.vec_id < b.vec_id WHERE {D} <= {CODE_DISTANCE}")
def hamming_pairs(spark, d):
    return neardup.hamming_pairs(codes(spark, d), "vec_id", "code", CODE_DISTANCE)


@query(f"WITH {C}, p AS (SELECT a.vec_id AS id, b.vec_id AS match, {D}::BIGINT AS distance FROM c a JOIN c b ON a.vec_id <> b.vec_id WHERE {D} <= {CODE_DISTANCE}) SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, match) = 1")
def neardup_best_match(spark, d):
    df = codes(spark, d)
    return neardup.best_match(df, df.withColumn("pos", F.col("vec_id")), "vec_id", "code", CODE_DISTANCE, "pos")


@query(f"""WITH RECURSIVE {C}, o AS (SELECT *, row_number() OVER (ORDER BY pixels DESC, sha256) AS i FROM c),
g(i, kept, sha256, m) AS (
  SELECT 0::BIGINT, []::STRUCT(s VARCHAR, lo BIGINT, hi BIGINT)[], NULL::VARCHAR, NULL::STRUCT(d BIGINT, k BIGINT, s VARCHAR)
  UNION ALL
  SELECT i, CASE WHEN m IS NULL THEN list_append(kept, {{s: sha256, lo: lo, hi: hi}}) ELSE kept END, sha256, m FROM (
    SELECT o.i, o.sha256, o.lo, o.hi, g.kept, list_min(list_filter(list_transform(g.kept, lambda x, k:
      {{d: (bit_count(xor(x.lo, o.lo)) + bit_count(xor(x.hi, o.hi)))::BIGINT, k: k::BIGINT, s: x.s}}), lambda y: y.d <= {CODE_DISTANCE})) AS m
    FROM g JOIN o ON o.i = g.i + 1))
SELECT sha256, m.s AS duplicate_of, m.d AS duplicate_distance FROM g WHERE i > 0""")
def neardup_mark(spark, d):
    return neardup.mark(codes(spark, d), None, Dedupe(max_distance=CODE_DISTANCE)).kept.select("sha256", "duplicate_of", "duplicate_distance")


# The loop as a recursion: the index is a list of slots, stored ones first; the best match is the least of distance and place.
G = f"""{C}, o AS (SELECT *, row_number() OVER (ORDER BY pixels DESC, sha256) AS i FROM c),
g(i, slots, sha256, m, takes) AS (
  SELECT 0::BIGINT, (SELECT list({{s: sha256, lo: lo, hi: hi, p: pixels}} ORDER BY vec_id) FROM c WHERE vec_id % 5 = 0), NULL::VARCHAR, NULL::STRUCT(d BIGINT, k BIGINT, s VARCHAR, p BIGINT), NULL::BOOLEAN
  UNION ALL
  SELECT i, CASE WHEN m IS NULL THEN list_append(slots, me) WHEN m.p < me.p THEN list_concat(list_append(slots[1:m.k - 1], me), slots[m.k + 1:]) ELSE slots END, me.s, m, m.p < me.p FROM (
    SELECT o.i, {{s: o.sha256, lo: o.lo, hi: o.hi, p: o.pixels}} AS me, g.slots, list_min(list_filter(list_transform(g.slots, lambda x, k:
      {{d: (bit_count(xor(x.lo, o.lo)) + bit_count(xor(x.hi, o.hi)))::BIGINT, k: k::BIGINT, s: x.s, p: x.p}}), lambda y: y.d <= {CODE_DISTANCE} AND y.s <> o.sha256)) AS m
    FROM g JOIN o ON o.i = g.i + 1))"""


def _beside_stored(spark, d):
    """Against stored codes (each fifth), whose slots larger newcomers take."""
    df = codes(spark, d)
    return neardup.mark(df, df.where("vec_id % 5 = 0").withColumn("pos", F.col("vec_id")), Dedupe(max_distance=CODE_DISTANCE))


@query(f"WITH RECURSIVE {G} SELECT m.s AS old, sha256 AS new, m.d AS distance FROM g WHERE takes")
def neardup_supersede(spark, d):
    return _beside_stored(spark, d).extras["supersessions"]


@query(f"WITH RECURSIVE {G} SELECT sha256, CASE WHEN NOT takes THEN m.s END AS duplicate_of, CASE WHEN NOT takes THEN m.d END AS duplicate_distance FROM g WHERE i > 0")
def neardup_beside_stored(spark, d):
    return _beside_stored(spark, d).kept.select("sha256", "duplicate_of", "duplicate_distance")


@query(f"""WITH {C}, h AS (SELECT DISTINCT lo, hi, printf('%08x%08x', hi, lo) AS code FROM c)
SELECT a.code AS code_a, b.code AS code_b, {D}::BIGINT AS distance FROM h a JOIN h b ON a.code < b.code WHERE {D} <= {CODE_DISTANCE}""")
def phash_index_batches(spark, d):
    """A stored index that took the codes in four batches."""
    index = CodeIndex(spark, new_path(spark, "index"), CODE_DISTANCE)
    for k in range(4):
        index.add(codes(spark, d).where(F.col("vec_id") % 4 == k))
    digits = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return index.pairs().select(F.least(digits("a"), digits("b")).alias("code_a"), F.greatest(digits("a"), digits("b")).alias("code_b"), F.col("d").cast("long").alias("distance"))


# Paths and URLs -----------------------------------------------------------------------------------------------------
PATH = r"regexp_extract(image_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
EXT = rf"regexp_extract(lower({PATH}), '[^/.][^/]*(\.[^./]+)$', 1)"
EXT = f"CASE WHEN length({EXT}) BETWEEN 2 AND 5 THEN {EXT} ELSE '.bin' END"


@query(f"WITH {A} SELECT doc_id, {EXT} AS extension FROM a")
def url_extension(spark, d):
    return assets(spark, d).select("doc_id", scalars.url_extension(F.col("image_url")).alias("extension"))


@query(f"WITH {A} SELECT doc_id, '/data/images/' || substr(sha256, 1, 2) || '/' || sha256 || {EXT} AS storage_path FROM a")
def storage_path(spark, d):
    return assets(spark, d).select("doc_id", scalars.storage_path("/data/images", F.col("sha256"), scalars.url_extension(F.col("image_url"))).alias("storage_path"))


@query(f"WITH {A} SELECT doc_id FROM a WHERE regexp_matches(lower(split_part(image_url, '?', 1)), '\\.(jpg|jpeg|png|webp|gif|bmp|tif|tiff)$')")
def image_url_filter(spark, d):
    return assets(spark, d).where(scalars.is_image_url(F.col("image_url"))).select("doc_id")


REL = f"""'images/' || split || '/' || class_label || '/' || sha256 || coalesce(CASE {_sql_dealt(FORMATS, "doc_id")} WHEN 'JPEG' THEN '.jpg' WHEN 'PNG' THEN '.png' WHEN 'WEBP' THEN '.webp' WHEN 'GIF' THEN '.gif' END, {EXT})"""
I = f"{_ranked('class_label')}, i AS (SELECT u.*, split, {_sql_dealt(FORMATS, 'doc_id')} AS format, {norm_sql('license_raw')} AS license, {REL} AS relative_path FROM s JOIN u USING (sha256, class_label))"


def images(spark, d):
    """A curated set without duplicates, split."""
    df = curate.assign_split(unique(spark, d)).withColumn("format", _dealt(FORMATS, F.col("doc_id")))
    path = scalars.storage_path("/data/images", F.col("sha256"), scalars.url_extension(F.col("image_url")))
    return df.withColumns({"storage_path": path, "duplicate_of": F.lit(None).cast("string"), "license": licenses.normalise_license(F.col("license_raw")), "origin_url": F.col("image_url"), "source_url": F.lit("")})


@query(f"WITH {I} SELECT sha256, relative_path FROM i")
def relative_path(spark, d):
    return export.dataset_rows(images(spark, d)).select("sha256", "relative_path")


@query(f"SELECT doc_id, nullif(CASE doc_id % 5 WHEN 0 THEN 'Ola Brandt' WHEN 1 THEN 'K. Venn' WHEN 2 THEN 'Harbour Archive' ELSE '' END, '') AS credit FROM documents")
def credit_line(spark, d):
    return _read(spark, d, "documents").select("doc_id", scalars.credit_line(_dealt(CREDITS, F.col("doc_id"))).alias("credit"))


@query("SELECT doc_id, source || ' ' || doc_id || '+x.jpg' AS title FROM documents")
def page_title(spark, d):
    url = F.concat(F.lit("https://h/wiki/File:"), "source", F.lit("_"), "doc_id", F.lit("%2Bx.jpg"))
    return _read(spark, d, "documents").select("doc_id", scalars.title_of(url).alias("title"))


# Curated set and exports ----------------------------------------------------------------------------------------------
@query(f"WITH {U} SELECT class_label, count(*) AS n FROM u GROUP BY 1")
def class_counts(spark, d):
    return views.class_counts(images(spark, d))


@query(f"WITH {I} SELECT class_label, split, count(*) AS n_images, (2 * sum(width) + count(*))::BIGINT // (2 * count(*)) AS avg_width, (2 * sum(height) + count(*))::BIGINT // (2 * count(*)) AS avg_height, count(DISTINCT source) AS n_sources FROM i GROUP BY ALL")
def dataset_composition(spark, d):
    return views.dataset_composition(images(spark, d))


@query(f"WITH {I} SELECT sha256, class_label, split, relative_path, source, license FROM i")
def dataset_rows(spark, d):
    return export.dataset_rows(images(spark, d)).select("sha256", "class_label", "split", "relative_path", "source", "license")


@query(f"WITH {I} SELECT substr(sha256(string_agg(sha256 || ':' || split || ':' || class_label, '' ORDER BY sha256)), 1, 16) AS fingerprint FROM i")
def dataset_fingerprint(spark, d):
    return export.fingerprint(images(spark, d))


@query(f"WITH {I} SELECT class_label, split, count(*) AS n FROM i GROUP BY ALL")
def manifest_counts(spark, d):
    return export.manifest_counts(images(spark, d))


@query(f"WITH {I} SELECT class_label, sha256, relative_path || chr(10) || '  license: ' || license || chr(10) || '  credit: ' || coalesce(nullif(attribution, ''), 'n/a') || chr(10) || '  source: ' || image_url AS block FROM i WHERE license IS NOT NULL")
def attribution_lines(spark, d):
    return export.attribution_lines(export.dataset_rows(images(spark, d)).where("license is not null"))


@query(f"WITH {I} SELECT sha256, class_label, split FROM i QUALIFY row_number() OVER (PARTITION BY class_label, split ORDER BY sha256) <= 5")
def sample_per_class(spark, d):
    return export.sample(images(spark, d), 5).select("sha256", "class_label", "split")


@query(f"WITH {U}, c AS (SELECT class_label, count(*) AS n FROM u GROUP BY 1), k AS (SELECT DISTINCT lang AS class_label FROM documents UNION SELECT 'none'), g AS (SELECT coalesce(n, 0) AS n FROM k LEFT JOIN c USING (class_label)) SELECT CASE WHEN bool_or(n < 40) THEN 'partial' ELSE 'success' END AS status, count(*) FILTER (n < 40) AS n_short, min(n) AS least FROM g")
def quality_gate(spark, d):
    classes = _read(spark, d, "documents").select(F.col("lang").alias("class_label")).union(spark.createDataFrame([("none",)], "class_label string")).distinct()
    return views.quality_gate(classes, views.class_counts(images(spark, d)), TARGET)


@query(f"WITH {U}, c AS (SELECT class_label, count(*) AS stored FROM u GROUP BY 1), k AS (SELECT DISTINCT lang AS class_label FROM documents UNION SELECT 'none') SELECT class_label, coalesce(stored, 0) AS stored, greatest(0, 301 - coalesce(stored, 0)) AS needed, round_even(greatest(0, 301 - coalesce(stored, 0)) * 1.5, 0)::BIGINT AS fetch_limit FROM k LEFT JOIN c USING (class_label)")
def ingest_gap(spark, d):
    classes = _read(spark, d, "documents").select(F.col("lang").alias("class_label")).union(spark.createDataFrame([("none",)], "class_label string")).distinct()
    return curate.ingest_gap(classes, views.class_counts(images(spark, d)), Source(target=301))


@query("SELECT DISTINCT lang || '-empty' AS source FROM documents")
def sources_empty(spark, d):
    df = _read(spark, d, "documents")
    asked = df.select(F.col("source"), F.lit(1).alias("needed")).union(df.select(F.concat("lang", F.lit("-empty")), F.lit(2))).union(spark.createDataFrame([("never asked", 0)], "source string, needed int"))
    return views.empty_sources(asked, df)


@query(f"WITH {A} SELECT origin_url, sha256, '/data/' || sha256 AS storage_path FROM (SELECT class_label || '/' || width AS origin_url, sha256, doc_id FROM a) QUALIFY row_number() OVER (PARTITION BY origin_url ORDER BY doc_id DESC, sha256) = 1")
def known_origin_urls(spark, d):
    df = assets(spark, d).select(F.concat_ws("/", "class_label", "width").alias("origin_url"), "sha256", F.concat(F.lit("/data/"), "sha256").alias("storage_path"), F.col("doc_id").alias("created_at"))
    return store.known_urls(df)


@query(f"WITH {A} SELECT doc_id, image_url IN (SELECT image_url FROM a WHERE doc_id % 2 = 0) AS reused FROM a")
def url_reuse(spark, d):
    df = assets(spark, d)
    held = df.where("doc_id % 2 = 0").select(F.col("image_url").alias("origin_url"), "sha256", F.col("sha256").alias("storage_path"))
    again, pending = curate.reuse(df.drop("sha256"), held)
    return again.select("doc_id", F.lit(True).alias("reused")).union(pending.select("doc_id", F.lit(False)))


# Store ----------------------------------------------------------------------------------------------------------------
def _stored(spark, d):
    """The assets of even ids are stored; the batch is all of them. A source's id is its words' number, so ids clash."""
    df = assets(spark, d).withColumns({"source_id": F.col("height").cast("string"), "split": F.when(F.col("doc_id") % 3 == 0, "train"), "duplicate_of": F.lit(None).cast("string"), "duplicate_distance": F.lit(None).cast("int")})
    row = F.row_number().over(W.partitionBy("source", "source_id").orderBy("doc_id"))
    first = curate.exact_dedup(df.where("doc_id % 2 = 0"), [F.col("doc_id")]).kept
    have = first.withColumn("_r", row).where("_r = 1").drop("_r")
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp")
    have = have.withColumns({"first_seen_run_id": F.lit("r1"), "last_seen_run_id": F.lit("r1"), "created_at": stamp, "updated_at": stamp})
    return have, df


ST = f"""{A}, e AS (SELECT *, height::VARCHAR AS sid, CASE WHEN doc_id % 3 = 0 THEN 'train' END AS split FROM a),
h0 AS (SELECT * FROM e WHERE doc_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY doc_id) = 1),
h AS (SELECT * FROM h0 QUALIFY row_number() OVER (PARTITION BY source, sid ORDER BY doc_id) = 1),
b AS (SELECT sha256, min(doc_id) AS first_id, count(*) AS n, arg_max(split, CASE WHEN split IS NOT NULL THEN doc_id END) AS new_split FROM e GROUP BY 1),
n0 AS (SELECT e.*, b.n FROM e JOIN b ON e.sha256 = b.sha256 AND doc_id = first_id WHERE e.sha256 NOT IN (SELECT sha256 FROM h)),
n1 AS (SELECT *, EXISTS (SELECT 1 FROM h WHERE h.source = n0.source AND h.sid = n0.sid) AS taken FROM n0),
n2 AS (SELECT *, NOT taken AND row_number() OVER (PARTITION BY source, sid, taken ORDER BY doc_id) = 1 AS ins FROM n1)"""


@query(f"WITH {ST} SELECT h.sha256, h.source, h.sid AS source_id, 'r2' AS last_seen_run_id, 'r1' AS first_seen_run_id, coalesce(new_split, split) AS split FROM h JOIN b USING (sha256) UNION ALL SELECT sha256, source, sid, 'r2', 'r2', split FROM n2 WHERE ins")
def upsert_images(spark, d):
    have, batch = _stored(spark, d)
    return store.upsert(have, batch, "r2", [F.col("doc_id")])["images"].select("sha256", "source", "source_id", "last_seen_run_id", "first_seen_run_id", "split")


@query(f"WITH {ST} SELECT 'inserted' AS metric, count(*) FILTER (ins) AS value FROM n2 UNION ALL SELECT 'conflicted', coalesce(sum(n), 0)::BIGINT FROM n2 WHERE NOT ins UNION ALL SELECT 'already_known', ((SELECT coalesce(sum(n), 0) FROM b JOIN h USING (sha256)) + (SELECT coalesce(sum(n - 1), 0) FROM n2 WHERE ins))::BIGINT")
def upsert_counters(spark, d):
    have, batch = _stored(spark, d)
    return store.upsert(have, batch, "r2", [F.col("doc_id")])["counters"]


@query(f"""WITH {U}, k AS (SELECT sha256, lag(sha256) OVER (PARTITION BY class_label ORDER BY sha256) AS p, 'train' AS split FROM u),
m AS (SELECT *, substr(sha256, 1, 1) IN ('0', '5') AND p IS NOT NULL AS hit FROM k) SELECT sha256, CASE WHEN hit THEN p END AS duplicate_of, CASE WHEN hit THEN 3 END AS duplicate_distance, CASE WHEN NOT hit THEN split END AS split FROM m""")
def mark_duplicates(spark, d):
    df = unique(spark, d)
    none = {"duplicate_of": F.lit(None).cast("string"), "duplicate_distance": F.lit(None).cast("int"), "split": F.lit("train")}
    before = F.lag("sha256").over(W.partitionBy("class_label").orderBy("sha256"))
    marks = df.select("sha256", before.alias("duplicate_of"), F.lit(3).alias("distance")).where("substr(sha256, 1, 1) in ('0', '5') and duplicate_of is not null")
    marks = marks.union(spark.createDataFrame([("absent", "absent too", 1)], marks.schema))  # marks of absent rows change nothing
    return store.mark_duplicates(df.select("sha256").withColumns(none), marks)


@query(f"""WITH {A} SELECT 'sha256_unique' AS "constraint", count(*) AS n FROM (SELECT sha256 FROM a GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'source_id_unique', count(*) FROM (SELECT source, source_id FROM a GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'positive_height', count(*) FILTER (height IS NULL OR height <= 0) FROM a UNION ALL SELECT 'positive_width', count(*) FILTER (width IS NULL OR width <= 0) FROM a
UNION ALL SELECT 'positive_size', count(*) FILTER (file_size_bytes <= 0) FROM a UNION ALL SELECT 'sha256_not_null', 0 UNION ALL SELECT 'license_not_null', count(*) FILTER (({norm_sql("license_raw")}) IS NULL) FROM a
UNION ALL SELECT 'split_known', count(*) FILTER (doc_id % 7 = 0) FROM a UNION ALL SELECT 'not_own_duplicate', count(*) FILTER (doc_id % 11 = 0) FROM a UNION ALL SELECT 'duplicate_with_distance', count(*) FILTER (doc_id % 11 = 0) FROM a""")
def constraint_violations(spark, d):
    odd = {"split": F.when(F.col("doc_id") % 7 == 0, "test").otherwise("val"), "duplicate_of": F.when(F.col("doc_id") % 11 == 0, F.col("sha256")), "duplicate_distance": F.lit(None).cast("int"), "license": licenses.normalise_license(F.col("license_raw"))}
    return store.constraint_violations(assets(spark, d).withColumns(odd))


CHECKS = ", ".join(f"('{n}')" for n in store.PLANTED)


@query(f"""WITH {I}, c AS (SELECT class_label, split, count(*) AS n FROM i GROUP BY ALL)
SELECT check_name, 'PASS' AS outcome, (SELECT count(*) FROM u) AS images, (SELECT count(*) FROM a WHERE doc_id NOT IN (SELECT doc_id FROM u)) AS rejections, (SELECT count(*) FROM events) AS metrics,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM c) AS composition, 'all {len(store.PLANTED)} checks passed' AS verdict FROM (VALUES {CHECKS}) v(check_name)""")
def verify_schema(spark, d):
    """Planted violations of every rule against the curated set."""
    df = images(spark, d).withColumn("duplicate_distance", F.lit(None).cast("int"))
    rejected = curate.exact_dedup(assets(spark, d), [F.col("doc_id")]).rejections
    return store.verify_schema(df, rejected, _read(spark, d, "events"), views.dataset_composition(df))


LINKED = f"""{U}, k AS (SELECT *, CASE WHEN substr(sha256, 1, 1) = '0' THEN lag(sha256) OVER (PARTITION BY class_label ORDER BY sha256) END AS duplicate_of FROM u)"""


@query(f"WITH {LINKED} SELECT sha256 FROM k")
def known_sha256(spark, d):
    return store.known_hashes(_linked(spark, d))


@query(f"WITH {LINKED} SELECT sha256, class_label FROM k WHERE duplicate_of IS NULL")
def split_candidates(spark, d):
    return store.split_candidates(_linked(spark, d))


@query(f"WITH {LINKED} SELECT sha256, substr(sha256, 1, 16) AS phash, class_label, width, height, doc_id * 1000000 AS pos FROM k WHERE duplicate_of IS NULL AND doc_id % 4 <> 0")
def phash_index(spark, d):
    df = _linked(spark, d).withColumns({"phash": F.when(F.col("doc_id") % 4 != 0, F.substring("sha256", 1, 16)), "created_at": F.timestamp_seconds("doc_id")})
    return neardup.index_rows(df)


@query(f"WITH {LINKED} SELECT a.sha256, a.class_label, a.duplicate_of, 2 AS duplicate_distance, b.class_label AS original_class, b.width AS original_width FROM k a JOIN k b ON a.duplicate_of = b.sha256")
def duplicates_with_originals(spark, d):
    return store.duplicates_with_originals(_linked(spark, d).withColumn("duplicate_distance", F.lit(2)))


@query(f"WITH {V} SELECT coalesce(reason_code, 'kept') AS metric, count(*) AS value FROM v GROUP BY 1")
def stage_metrics(spark, d):
    return curate.validate(_measured(spark, d)).metrics()


@query("SELECT (user_id % 3 = 0) AS forgotten, count(*) AS n FROM events GROUP BY 1")
def delete_run_images(spark, d):
    """Images outlive the runs that saw them, and forget them."""
    runs, _, _ = _runs(spark, d)
    df = _read(spark, d, "events").select(F.col("user_id").cast("string").alias("first_seen_run_id"), F.col("user_id").cast("string").alias("last_seen_run_id"))
    out = store.delete_runs({"images": df}, runs.where("cast(run_id as bigint) % 3 = 0"))["images"]
    return out.groupBy(F.col("last_seen_run_id").isNull().alias("forgotten")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 1.5 END AS seconds FROM events")
def retry_after(spark, d):
    value = _dealt(["3", "1.5", "Wed, 21 Oct 2026 07:28:00 GMT", None], F.col("event_id"))
    return _read(spark, d, "events").select("event_id", scalars.retry_after(value).alias("seconds"))


# Runs -----------------------------------------------------------------------------------------------------------------
def _runs(spark, d):
    df = _read(spark, d, "events").withColumn("run_id", F.col("user_id").cast("string"))
    runs = df.groupBy("run_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last"))
    runs = runs.select("run_id", "started_at", F.when(F.col("run_id").cast("long") % 10 != 0, F.col("last")).alias("finished_at"), F.lit("success").alias("status"), F.lit("").alias("error_message"))
    metric = F.create_map(*[F.lit(x) for p in {"view": "fetched", "click": "downloaded", "purchase": "kept", "signup": "near_duplicates"}.items() for x in p])[F.col("event_type")]
    k = api.field("k", F.col("props")).cast("long")
    metrics = df.where(metric.isNotNull()).select("run_id", F.lit("ingest").alias("stage"), metric.alias("metric"), k.alias("value"))
    rejections = df.where("event_type = 'error'").select("run_id", F.when(F.col("value") < 50, "select").otherwise("download").alias("stage"), F.when(F.col("value") < 50, "OVER_TARGET").otherwise("HTTP_ERROR").alias("reason_code"))
    return runs, metrics, rejections


R = """m AS (SELECT user_id::VARCHAR AS run_id, 'ingest' AS stage, CASE event_type WHEN 'view' THEN 'fetched' WHEN 'click' THEN 'downloaded' WHEN 'purchase' THEN 'kept' ELSE 'near_duplicates' END AS metric,
  json_extract_string(props, '$.k')::BIGINT AS value FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')),
j AS (SELECT user_id::VARCHAR AS run_id, CASE WHEN value < 50 THEN 'select' ELSE 'download' END AS stage, CASE WHEN value < 50 THEN 'OVER_TARGET' ELSE 'HTTP_ERROR' END AS reason_code FROM events WHERE event_type = 'error')"""


@query(f"""WITH {R}, r AS (SELECT user_id::VARCHAR AS run_id, min(ts) AS started_at, CASE WHEN user_id % 10 <> 0 THEN max(ts) END AS finished_at FROM events GROUP BY user_id),
ms AS (SELECT run_id, sum(value) FILTER (metric = 'fetched') AS f, sum(value) FILTER (metric = 'downloaded') AS dl, sum(value) FILTER (metric = 'kept') AS k, sum(value) FILTER (metric = 'near_duplicates') AS nd FROM m GROUP BY 1),
js AS (SELECT run_id, count(*) FILTER (reason_code <> 'OVER_TARGET') AS rej, count(*) FILTER (reason_code = 'OVER_TARGET') AS trim FROM j GROUP BY 1),
z AS (SELECT run_id, epoch_us(coalesce(finished_at, TIMESTAMP '2030-01-01')) - epoch_us(started_at) AS us, coalesce(f, 0)::BIGINT AS fetched, coalesce(dl, 0)::BIGINT AS downloaded, coalesce(k, 0)::BIGINT AS kept,
  coalesce(rej, 0) AS rejected, coalesce(nd, 0)::BIGINT AS near_duplicates_marked, coalesce(trim, 0) AS trimmed_over_target FROM r LEFT JOIN ms USING (run_id) LEFT JOIN js USING (run_id))
SELECT run_id, ((us + 50000) // 100000) / 10.0 AS duration_seconds, fetched, downloaded, kept, rejected, near_duplicates_marked, trimmed_over_target,
  CASE WHEN fetched > 0 THEN ((2000 * rejected + fetched) // (2 * fetched)) / 10.0 END AS rejection_rate_pct FROM z""")
def run_summary(spark, d):
    runs, metrics, rejections = _runs(spark, d)
    out = views.run_summary(runs, metrics, rejections, F.lit("2030-01-01 00:00:00").cast("timestamp"))
    return out.drop("status", "started_at", "finished_at", "error_message")


@query(f"WITH {R} SELECT run_id, stage, metric, sum(value)::BIGINT AS value FROM m GROUP BY ALL")
def metrics_accumulate(spark, d):
    return views.accumulate(_runs(spark, d)[1])


@query(f"WITH {R} SELECT stage, reason_code, count(*) AS n FROM j GROUP BY ALL")
def rejection_breakdown(spark, d):
    return views.rejection_breakdown(_runs(spark, d)[2])


@query("SELECT user_id::VARCHAR AS run_id, min(ts) AS started_at FROM events GROUP BY user_id ORDER BY 2 DESC, 1 LIMIT 5")
def latest_runs(spark, d):
    """A top-5 report, which is the operator."""
    return _runs(spark, d)[0].orderBy(F.col("started_at").desc(), "run_id").limit(5).select("run_id", "started_at")


@query(f"WITH {R} SELECT stage, metric, count(*) AS n FROM m WHERE run_id NOT IN (SELECT user_id::VARCHAR FROM events WHERE user_id % 3 = 0) GROUP BY ALL")
def delete_run_cascade(spark, d):
    runs, metrics, _ = _runs(spark, d)
    gone = runs.where("cast(run_id as bigint) % 3 = 0")
    return store.delete_runs({"run_stage_metrics": metrics}, gone)["run_stage_metrics"].groupBy("stage", "metric").agg(F.count("*").alias("n"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def raw_payload_projection(spark, d):
    df = _read(spark, d, "events")
    return df.select("event_id", api.field("k", F.col("props")).alias("k"), api.field("absent", F.col("props")).alias("absent"))


# Pages ----------------------------------------------------------------------------------------------------------------
@query("""SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1))) AS href FROM pages""")
def html_links(spark, d):
    links = F.array_distinct(F.regexp_extract_all("html", F.lit('<a [^>]*?href="([^"]*)"'), F.lit(1)))
    return _read(spark, d, "pages").select("page_id", F.explode(links).alias("href"))


@query()
def html_license_box(spark, d):
    """Licence boxes of each page, its chrome removed."""
    return html.parse(_read(spark, d, "pages")).select("page_id", F.explode_outer("boxes").alias("box")).select("page_id", "box.kind", "box.text", "box.url")


@query()
def html_author(spark, d):
    return html.parse(_read(spark, d, "pages")).select("page_id", scalars.credit_line(F.col("author")).alias("author"), "error")


@query("SELECT page_id::VARCHAR AS source_id, 'MISSING_IMAGE_URL' AS reason_code FROM pages")
def scrape_rejections(spark, d):
    """Pages as file pages: none of them has an asset, and each says so once."""
    pages = _read(spark, d, "pages").select(F.col("page_id").cast("string").alias("url"), "html", F.lit("none").alias("class_label"), F.current_timestamp().alias("fetched_at"))
    return html.scraped_records(pages).rejections.select("source_id", "reason_code")


# Pages of a site, written from the given pages ----------------------------------------------------------------------
BASE = "https://commons.example.org"
HOST = "split_part(url, '/', 3)"


def _of_kind(n: int, *cases: str) -> Column:
    """The case of page_id % n, an SQL expression each."""
    return F.expr(f"CASE CAST(page_id % {n} AS INT) " + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(cases)) + " END")


def file_pages(spark: SparkSession, d: str) -> DataFrame:
    """url, html, class_label and fetched_at: a file page for each page, whose image, boxes and author come in kinds dealt by page_id, between chrome that claims another licence."""
    box = lambda inside: f'\'<div class="licensetpl">{inside}</div>\''
    name = lambda x: box(f'<span class="licensetpl_short">{x}</span>')
    deed = lambda x: box(f'<a href="{x}">deed</a>')
    full = "concat('<div class=\"fullImageLink\"><a href=\"//up.example.org/a/', page_id, '.jpg\">full</a></div>')"
    thumb = "concat('<div id=\"file\"><img src=\"https://up.example.org/thumb/a/ab/', page_id, '.png/220px-', page_id, '.png\"></div>')"
    image = _of_kind(4, full, thumb, f"concat({thumb}, {full})", "''")
    boxes = _of_kind(
        5, "''", f"concat({deed('https://creativecommons.org/licenses/by-sa/3.0/')}, {name('CC BY-NC 2.0')})", f"concat({name('CC BY 2.5')}, {deed('//creativecommons.org/licenses/by/4.0/')})",
        f"concat({deed('https://creativecommons.org/publicdomain/zero/1.0/')}, {deed('https://creativecommons.org/licenses/by-nd/2.0')})", box("This picture is in the public domain."),
    )
    labelled = f"concat('<table><tr><td id=\"fileinfotpl_aut\">Author</td><td> · ', {HOST}, '  by   the <b>press</b> VIAF 12</td></tr></table>')"
    long = f"concat('<table><tr><th class=\"fileinfo-paramfield\">Photographer:</th><td>', repeat(concat({HOST}, ' '), 40), '</td></tr></table>')"
    author = _of_kind(3, labelled, long, "''")
    chrome = F.lit('<div id="footer"><div class="licensetpl"><span class="licensetpl_short">CC BY-NC-ND 1.0</span></div></div>')
    page = F.concat(F.lit("<html><body>"), chrome, F.lit('<div id="mw-content-text">'), image, boxes, author, F.lit("</div></body></html>"))
    url = F.concat(F.lit(f"{BASE}/wiki/File:A_file%20"), "page_id")
    return _read(spark, d, "pages").select(url.alias("url"), page.alias("html"), F.lit("none").alias("class_label"), F.current_timestamp().alias("fetched_at"))


FILES = f"""f AS (SELECT '{BASE}/wiki/File:A_file%20' || page_id AS source_id, 'A file ' || page_id AS title,
  CASE page_id % 4 WHEN 1 THEN 'https://up.example.org/a/ab/' || page_id || '.png' WHEN 3 THEN NULL ELSE 'https://up.example.org/a/' || page_id || '.jpg' END AS image_url,
  (['CC BY-NC 2.0', 'CC BY 2.5', 'by-nd-2.0', 'Public domain'])[nullif(page_id % 5, 0)] AS license_raw,
  CASE WHEN page_id % 5 = 3 THEN 'https://creativecommons.org/licenses/by-nd/2.0' END AS license_url,
  CASE page_id % 3 WHEN 0 THEN {HOST} || ' by the press' WHEN 1 THEN regexp_replace(substr(repeat({HOST} || ' ', 40), 1, 200), ' [^ ]*$', '') || '…' END AS attribution FROM pages)"""


@query(f"WITH {FILES} SELECT * FROM f WHERE image_url IS NOT NULL AND license_raw IS NOT NULL")
def file_page_records(spark, d):
    """The most restrictive box of each file page, its image (full size, or from its preview), its author as a credit."""
    return html.scraped_records(file_pages(spark, d)).kept.select("source_id", "title", "image_url", "license_raw", "license_url", "attribution")


@query(f"WITH {FILES} SELECT source_id, CASE WHEN image_url IS NULL THEN 'MISSING_IMAGE_URL' ELSE 'MISSING_LICENSE' END AS reason_code FROM f WHERE image_url IS NULL OR license_raw IS NULL")
def file_page_rejections(spark, d):
    return html.scraped_records(file_pages(spark, d)).rejections.select("source_id", "reason_code")


TAILS = [".jpg", ".PNG", ".txt", "%20b.tiff"]
TOPICS = ["", "_by_year", "", "_by_country_and_date"]


def _named(spark: SparkSession, d: str) -> DataFrame:
    """page_id and names, the letters and digits of each of a page's links."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('href="([^"]*)"'), F.lit(1))
    return _read(spark, d, "pages").select("page_id", F.transform(links, lambda x: F.regexp_replace(x, "[^A-Za-z0-9]", "")).alias("names"))


def _tailed(kind: str, tails: list[str]):
    return lambda x, k: F.concat(F.lit(f"/wiki/{kind}:"), x, F.element_at(F.array(*map(F.lit, tails)), k % len(tails) + 1))


def category_pages(spark: SparkSession, d: str) -> DataFrame:
    """page_id, url, html: a category page for each page, whose links name files (in a gallery on even pages, elsewhere on the page on odd ones) and further categories."""
    link = lambda href: F.concat(F.lit('<a href="'), href, F.lit('">x</a>'))
    decoy = F.lit('<a href="/wiki/File:decoy.jpg">x</a>')
    boxed = lambda href: F.concat(F.lit('<li class="gallerybox">'), link(href), decoy, F.lit("</li>"))
    files = F.transform("names", _tailed("File", TAILS))
    listed = F.when(F.col("page_id") % 2 == 0, F.array_join(F.transform(files, boxed), "")).otherwise(F.array_join(F.transform(files, link), ""))
    topics = F.array_join(F.transform(F.transform("names", _tailed("Category", TOPICS)), link), "")
    page = F.concat(F.lit("<html><body>"), decoy, F.lit('<div id="mw-subcategories">'), topics, F.lit('</div><div id="mw-content-text">'), listed, F.lit("</div></body></html>"))
    return _named(spark, d).select("page_id", F.concat(F.lit(f"{BASE}/wiki/Category:"), F.coalesce(F.try_element_at("names", F.lit(1)), F.lit(""))).alias("url"), page.alias("html"))


NAMED = """n AS (SELECT page_id, list_transform(regexp_extract_all(coalesce(html, ''), 'href="([^"]*)"', 1), lambda x: regexp_replace(x, '[^A-Za-z0-9]', '', 'g')) AS names FROM pages),
x AS (SELECT page_id, names[1] AS own, unnest(names) AS name, unnest(range(len(names))) AS k FROM n)"""


def _first_places(name: str, where: str) -> str:
    """Distinct names of a page in the order of their first places."""
    return f"SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY min(k)) - 1)::INT AS place, {name} AS name FROM x WHERE {where} GROUP BY page_id, {name}"


@query(f"WITH {NAMED} {_first_places(f'{chr(39)}{BASE}/wiki/File:{chr(39)} || name || ' + _sql_dealt(TAILS, 'k'), 'k % 4 <> 2')}")
def category_files(spark, d):
    """Files that a category's page names, each once: the first link of a gallery's box, or all links in the content."""
    return html.parse(category_pages(spark, d), BASE).select("page_id", F.posexplode("files").alias("place", "name"))


@query(f"WITH {NAMED} {_first_places('name', 'k % 2 = 0 AND name <> own').replace('name AS name', chr(39) + 'Category:' + chr(39) + ' || name AS name')}")
def category_subcategories(spark, d):
    """Categories below, without the page itself and without those that only group others."""
    return html.parse(category_pages(spark, d), BASE).select("page_id", F.posexplode("subcategories").alias("place", "name"))


# Splits of marked rows, lines of the manifest -----------------------------------------------------------------------
@query(f"""WITH {LINKED}, r AS (SELECT sha256, row_number() OVER (PARTITION BY class_label ORDER BY {SCORE}, sha256) AS p, count(*) OVER (PARTITION BY class_label) AS n FROM k WHERE duplicate_of IS NULL)
SELECT k.sha256, CASE WHEN p IS NULL THEN NULL WHEN p <= CASE WHEN n > 1 THEN greatest(1, least(n - 1, round_even(n * 80 / 100.0, 0)::BIGINT)) ELSE n END THEN 'train' ELSE 'val' END AS split FROM k LEFT JOIN r USING (sha256)""")
def split_with_duplicates(spark, d):
    """All rows with their split; near duplicates have none."""
    return curate.split_in_memory(_linked(spark, d)).select("sha256", "split")


@query(f"""WITH {I}, m AS (SELECT row_number() OVER (ORDER BY class_label, split, sha256) AS place, to_json({{'path': relative_path, 'label': class_label, 'split': split, 'source': source, 'source_url': '', 'license': license, 'attribution': attribution,
'checksum': {{'algorithm': 'sha256', 'value': sha256}}, 'width': width, 'height': height}})::VARCHAR AS item FROM i)
SELECT CASE WHEN place = 1 THEN '    ' ELSE '  , ' END || item AS value FROM m""")
def manifest_items(spark, d):
    """Lines of the manifest's images."""
    lines = export.manifest_lines(export.dataset_rows(images(spark, d)), {"schema_version": export.VERSION})
    return lines.where(F.col("value").rlike(r"^(    |  , )\{"))
