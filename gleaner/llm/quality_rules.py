"""Quality rules: exact counts of a whole text, and its divergence from the references of its language.

Native: DataFrame functions only. Base counts (words are runs of anything but the six ASCII blanks): words, code
points in words, symbols of `#*$%&|<>`, lines with a word that equal an earlier line, and words inside 8-word windows
that occur twice or more in the text (windows are compared by 64-bit hashes of their word hashes).

Verdict: a text fails the base rules with under MIN_WORDS words or over 30 % repeat words. Otherwise the
Jensen-Shannon distance (base 2, 0 to 1) of its character-class histogram and of its common-word histogram to the
reference of its language decides. A reference is the sum of the histograms of all documents of that language that
pass the base rules; it is a row per language, gathered with map-side sums. A distance counts only for texts of at
least GUARD_WORDS words (common words: GUARD_COMMON); shorter ones keep the base verdict.

Defined results: null texts have no words and fail; a null or unknown language is a language of its own, and one
without a list of common words is judged by characters alone; repeated rows are judged alike; other columns pass
through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.texts import WORD, words
from gleaner.plans.storage import materialize

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
GUARD_WORDS = 40
GUARD_COMMON = 100
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.28
#: Reference rows up to which they are broadcast; more are joined by language.
BROADCAST_REFERENCES = 5000

# Symbols of the base rules.
SYMBOLS = "#*$%&|<>"
# Character classes after lower-case ASCII letters, which are the first bin; the last holds all else.
CLASSES = ["A-Z", "0-9", r"\x20\x09-\x0D", r".,;:'\"()\-", "!?", r"#*$%&|<>@^~=+_/\\\{\}\[\]`"]
# Ten very common words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "que"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las"],
}


def _count(text: str, chars: str) -> Column:
    """How often any of the characters stands in text; a pass over bytes for each."""
    left = F.col(text)
    for c in chars:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.length(text) - F.length(left)


def _repeat_words(n: str, hashes: str) -> list[tuple[str, Column]]:
    """Columns to add one after another; the last is the number of words in repeated windows."""
    has = F.col("_dup")
    return [
        ("_win", F.when(F.col(n) >= WINDOW, F.transform(F.sequence(F.lit(1), F.col(n) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))))),
        ("_dup", F.coalesce(F.size(F.array_distinct("_win")) < F.size("_win"), F.lit(False))),
        ("_win", F.when(has, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))),
        ("_at", F.when(has, F.sort_array(F.transform(F.filter("_win", lambda x, j: F.coalesce(x["h"] == F.get("_win", j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("_win", j + 1)["h"], F.lit(False))), lambda x: x["i"])))),
        ("n_repeat_words", F.coalesce(F.aggregate(F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", j + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")),
    ]


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    """row (the carried columns), the base counts, and the histograms chars and common with lang."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry])
    df = docs.select(row.alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang"), F.lit("")).alias("lang"))
    df = df.withColumn("_words", words(F.col("text"))).withColumn("n", F.size("_words"))
    df = df.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    for name, column in _repeat_words("n", "_hash"):
        df = df.withColumn(name, column)
    df = df.withColumn("_rest", F.regexp_replace("text", "[a-z]+", ""))
    df = df.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    of_class = [F.length("_rest") - F.length(F.regexp_replace("_rest", f"[{c}]+", "")) for c in CLASSES]
    df = df.withColumn("_classes", F.array(F.length("text") - F.length("_rest"), *of_class))
    hashed = lambda list_: F.array(*[F.xxhash64(F.lit(w)) for w in list_])
    common = F.create_map(*[x for lang, list_ in COMMON.items() for x in (F.lit(lang), hashed(list_))])[F.col("lang")]
    df = df.withColumn("_common", common).withColumn("_hits", F.filter("_hash", lambda h: F.array_contains(F.col("_common"), h)))
    found = F.transform("_common", lambda c: F.size(F.filter("_hits", lambda h: h == c)))
    total = F.aggregate("_classes", F.lit(0), lambda a, x: a + x)
    return df.select(
        "row",
        "lang",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count("_rest", SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.concat("_classes", F.array(F.length("text") - total)).alias("chars"),
        F.concat(found, F.array(F.col("n") - F.size("_hits"))).alias("common"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def references(metrics: DataFrame) -> DataFrame:
    """A row per language: ref_chars and ref_common, sums over all documents that pass the base rules."""
    bins = max(len(CLASSES) + 2, max(map(len, COMMON.values())) + 1)
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}_{i}") for c in ("chars", "common") for i in range(bins)]
    grouped = metrics.where("not base_failed").groupBy("lang").agg(*sums)
    arrays = [F.filter(F.array(*[f"{c}_{i}" for i in range(bins)]), lambda x: x.isNotNull()).alias(f"ref_{c}") for c in ("chars", "common")]
    return grouped.select("lang", *arrays)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if either is empty or their bins differ in number."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    share = lambda x: F.transform(x, lambda v: v / total(x))
    term = lambda v, m: F.when(v > 0, v * F.log2(v / m)).otherwise(0.0)
    both = F.zip_with(share(p), share(q), lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    defined = (F.size(p) == F.size(q)) & (total(p) > 0) & (total(q) > 0)
    return F.when(defined, F.sqrt(F.greatest(F.lit(0.0), total(both))))


def judged(docs: DataFrame, carry: list[str]) -> DataFrame:
    """row, the base counts, base_failed, char_distance, word_distance and kept."""
    metrics = materialize(measured(docs, carry), "quality")
    refs = materialize(references(metrics), "references")
    refs = F.broadcast(refs) if refs.count() <= BROADCAST_REFERENCES else refs
    far = lambda c, n, most: F.coalesce((F.col(c) > most) & (F.col("n_words") >= n), F.lit(False))
    out = metrics.join(refs, "lang", "left").withColumn("char_distance", js_distance(F.col("chars"), F.col("ref_chars")))
    out = out.withColumn("word_distance", js_distance(F.col("common"), F.col("ref_common")))
    kept = ~(F.col("base_failed") | far("char_distance", GUARD_WORDS, MAX_CHAR_DISTANCE) | far("word_distance", GUARD_COMMON, MAX_WORD_DISTANCE))
    return out.withColumn("kept", kept).drop("lang", "chars", "common", "ref_chars", "ref_common")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = judged(docs, ["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that the rules keep, with their own columns."""
    return judged(docs, docs.columns).where("kept").select("row.*")


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    part = lambda x, y: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({x} + {y}) / 2)) ELSE 0 END"
    a, b = f"({p}[k]::DOUBLE / list_sum({p}))", f"({q}[k]::DOUBLE / list_sum({q}))"
    total = f"list_sum(list_transform(range(1, len({p}) + 1), lambda k: ({part(a, b)} + {part(b, a)}) / 2))"
    return f"CASE WHEN len({p}) = len({q}) AND list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0::DOUBLE, {total})) END"


def _sql_sums(column: str, bins: int) -> str:
    return "[" + ", ".join(f"sum({column}[{k + 1}])" for k in range(bins)) + "]"


_SQL_CLASSES = ", ".join("length(rest) - length(regexp_replace(rest, '[" + c.replace("'", "''") + "]+', '', 'g'))" for c in CLASSES)
OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    regexp_replace(coalesce(text, ''), '[a-z]+', '', 'g') AS rest, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS pos FROM d WHERE len(w) >= {WINDOW}),
v AS (SELECT r, pos, count(*) OVER (PARTITION BY r, w[pos:pos + {WINDOW - 1}]) AS n FROM p),
c AS (SELECT r, count(DISTINCT x) AS n_repeat_words FROM (SELECT r, unnest(range(pos, pos + {WINDOW})) AS x FROM v WHERE n > 1) GROUP BY r),
k AS (SELECT d.r, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, length(t) AS total, [length(t) - length(rest), {_SQL_CLASSES}] AS classes,
    CASE lang {" ".join(f"WHEN '{lang}' THEN {_sql_list(list_)}" for lang, list_ in COMMON.items())} END AS list, w FROM d LEFT JOIN c ON d.r = c.r),
m AS (SELECT *, list_append(classes, total - list_sum(classes)) AS chars, list_transform(list, lambda x: len(list_filter(w, lambda y: y = x))) AS found,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM k),
h AS (SELECT *, CASE WHEN list IS NOT NULL THEN list_append(found, n_words - list_sum(found)) END AS common FROM m),
g AS (SELECT lang, {_sql_sums("chars", len(CLASSES) + 2)} AS ref_chars, {_sql_sums("common", max(map(len, COMMON.values())) + 1)} AS ref_common FROM h WHERE NOT base_failed GROUP BY lang),
s AS (SELECT h.*, {_sql_distance("chars", "ref_chars")} AS cd, CASE WHEN common IS NOT NULL THEN {_sql_distance("common", "ref_common")} END AS wd FROM h LEFT JOIN g ON h.lang = g.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR coalesce(cd > {MAX_CHAR_DISTANCE} AND n_words >= {GUARD_WORDS}, false) OR coalesce(wd > {MAX_WORD_DISTANCE} AND n_words >= {GUARD_COMMON}, false)) AS kept,
  round(cd, 6) AS char_distance, round(wd, 6) AS word_distance FROM s
"""
