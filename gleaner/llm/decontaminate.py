"""Benchmark decontamination by spaced seeds.

Native: DataFrame functions only. Words are lower-cased runs of anything but the six ASCII blanks. Each mask names
the offsets of a span that count; the others are ignored, so a substituted word there does not break the hash. Every
position of every document and of every benchmark item is hashed under each mask and the hashes are joined. A hit
puts the item's whole length on one diagonal of the document; hits are reduced to distinct diagonals, the words there
are compared one to one, and the item leaks if some WINDOW words in a row (the whole item, if shorter) agree in SHARE of
their places; items of EXACT words or fewer have to agree in all.

The masks reach every stretch of WINDOW words, and every item of 10 to 12, in which any two words are substituted, and
every item of 8 or 9 with one. Items of fewer words are met by their first and last RUN words, one of which a
substitution leaves whole. So all leaks by the rule above are found.

A seed that many items share, such as a common prompt, meets every document that holds it. Each seed therefore
carries seven bits of every word up to WINDOW - 1 places before and after it, and two seeds join only if those agree in
as many places as a window of the item needs. Bits of equal words agree, so no leak is lost.

The benchmark's hashes are broadcast only after they were counted and are BROADCAST_SEEDS at most; beyond that they are
joined by hash. Only documents that were hit are read again, with their words, for the comparison.

Defined results: null or blank texts match nothing; items of under MIN_ITEM words can't be told from chance and match
nothing; repeated documents or items give one pair; a null id is an id; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.texts import packed, read, row_key, words
from gleaner.plans.storage import materialize, scratch

# Counted offsets of each mask.
MASKS = [(0, 1, 2, 3, 5), (0, 1, 2, 5, 6), (0, 1, 3, 6, 7)]
#: Items of fewer words are met by runs instead of masks.
MASKED = 8
RUN = 3
MIN_ITEM = 4
EXACT = 5
WINDOW = 13
SHARE = 0.8
#: Seed rows (50 bytes each) up to which they are broadcast.
BROADCAST_SEEDS = 1_000_000
#: A byte of a context where there is no word; those of words are 80 or more.
NO_WORD, NO_ITEM_WORD = "00", "01"
#: Words of a context that are compared at once: 25 words are five parts, each a positive long.
AT_ONCE = 5


def _hashed_words(text: str) -> Column:
    return F.transform(words(F.lower(F.col(text))), lambda w: F.xxhash64(w))


def _needed(n: Column) -> Column:
    """Places that have to agree in a window of an item of n words."""
    return F.when(n <= EXACT, n).otherwise(F.ceil(SHARE * F.least(F.lit(WINDOW), n))).cast("int")


def _signature(hashes: str, outside: str) -> Column:
    """A byte for each word, between WINDOW - 1 bytes that stand for none."""
    edge = F.lit(outside * (WINDOW - 1))
    return F.unhex(F.concat(edge, F.array_join(F.transform(F.col(hashes), lambda h: F.hex(h.bitwiseAND(F.lit(127)).bitwiseOR(F.lit(128)))), ""), edge))


def _may_agree() -> Column:
    """Whether the contexts of two equal seeds agree in as many places as a window of the item needs."""
    part = lambda c, k: F.conv(F.substring(F.hex(c), 2 * k + 1, 2 * AT_ONCE), 16, 10).cast("long")
    differ = F.array(*[part("around", k).bitwiseXOR(part("item_around", k)) for k in range(0, 2 * WINDOW - 1, AT_ONCE)])
    lowest = sum(1 << 8 * k for k in range(AT_ONCE))

    def agreeing(x: Column) -> Column:
        any_bit = reduce(Column.bitwiseOR, [F.shiftright(x, k) for k in range(8)])
        return AT_ONCE - F.bit_count(any_bit.bitwiseAND(F.lit(lowest)))

    return F.aggregate(differ, F.lit(0), lambda n, x: n + agreeing(x)) >= F.col("need")


def _seeds(df: DataFrame, hashes: str, keep: list[str], outside: str, runs: Column | None, masked: Column | None = None) -> DataFrame:
    """keep, at (from 0), around and seed: a row for each position and mask, where masked, and for each run, where runs."""
    df = df.where(F.size(hashes) > 0).select(*keep, hashes, _signature(hashes, outside).alias("signature"))
    df = df.select("*", F.explode(F.sequence(F.lit(0), F.size(hashes) - 1)).alias("at"))
    masks = [(k, mask, masked) for k, mask in enumerate(MASKS)] + ([] if runs is None else [(-1, tuple(range(RUN)), runs)])
    there = lambda mask, also: (F.col("at") + max(mask) < F.size(hashes)) & (F.lit(True) if also is None else also)
    of_mask = [F.when(there(mask, also), F.xxhash64(F.lit(k), *[F.get(F.col(hashes), F.col("at") + o) for o in mask])) for k, mask, also in masks]
    around = F.substring("signature", F.col("at") + 1, F.lit(2 * WINDOW - 1))
    return df.select(*keep, "at", around.alias("around"), F.explode(F.array(*of_mask)).alias("seed")).where("seed is not null")


def _equal(own: str, item: str, shift: str) -> Column:
    """1 or 0 for each place of the item on the diagonal; shift: the document's place of the item's first word."""
    return F.transform(F.col(item), lambda w, k: F.coalesce((F.get(F.col(own), F.col(shift) + k) == w).cast("int"), F.lit(0)))


def leaks(docs: DataFrame, bench: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS, key: Column | None = None) -> DataFrame:
    """key (of the document's row), doc_id, item_id, n_equal (places that agree on the best diagonal), n_item (words of the item)."""
    items = materialize(bench.select("item_id", _hashed_words("text").alias("item")).where(F.size("item") >= MIN_ITEM).distinct(), "items")
    n = F.size("item")
    short = not items.where(n < MASKED).isEmpty()
    ends = (n < MASKED) & ((F.col("at") == 0) | (F.col("at") == n - RUN))
    of_item = _seeds(items.withColumn("need", _needed(n)), "item", ["item_id", "need"], NO_ITEM_WORD, ends, n >= MASKED)
    of_item = of_item.withColumnsRenamed({"at": "item_at", "around": "item_around"})
    seeds = materialize(of_item.distinct(), "seeds")
    small = seeds.count() <= broadcast_seeds
    key = row_key(docs) if key is None else key
    own = docs.select(key.alias("key"), "doc_id", _hashed_words("text").alias("own"))
    of_doc = _seeds(own, "own", ["key"], NO_WORD, F.lit(True) if short else None).withColumnRenamed("seed", "_seed")
    hits = of_doc.join(F.broadcast(seeds) if small else seeds, (F.col("_seed") == F.col("seed")) & _may_agree())
    hits = materialize(hits.select("key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")
    named = items.withColumnRenamed("item_id", "_id")
    texts = docs.select(key.alias("key"), "doc_id", "text").join(hits.select("key").distinct(), "key", "left_semi")
    hits = hits.join(texts.select("key", "doc_id", _hashed_words("text").alias("own")), "key").join(F.broadcast(named) if small else named, F.expr("item_id <=> _id"))
    win = F.least(F.lit(WINDOW), F.size("equal"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("equal") - win + 1), lambda i: F.aggregate(F.slice("equal", i, win), F.lit(0), lambda a, x: a + x)))
    found = hits.select("key", "doc_id", "item_id", F.size("item").alias("n_item"), _equal("own", "item", "shift").alias("equal"))
    found = found.withColumn("n_equal", F.aggregate("equal", F.lit(0), lambda a, x: a + x)).where(best >= _needed(F.size("equal")))
    return found.groupBy("key", "doc_id", "item_id").agg(F.max("n_equal").alias("n_equal"), F.max("n_item").alias("n_item"))


def op10(spark, sf_dir: str) -> DataFrame:
    found = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("n_equal").cast("long").alias("n_equal"), F.max("n_item").cast("long").alias("n_item"))


def drop_leaks(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows in which no item leaks."""
    key = row_key(docs)
    with scratch(docs.sparkSession) as keep:
        bad = materialize(leaks(docs, bench, key=key).select("key").distinct(), "leaks")
        keep.append(bad)
    return packed(docs, key).join(bad, "key", "left_anti").select("row.*")


# Independent of masks: on a leaking diagonal some RUN words in a row agree, whatever is substituted.
_RUN_SQL = " || ' ' || ".join(f"w[pos + {o + 1}]" for o in range(RUN))
OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS q, * FROM (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark) WHERE len(w) >= {MIN_ITEM}),
ip AS (SELECT q, w, unnest(range(0, len(w) - {RUN - 1})) AS pos FROM i),
js AS (SELECT q, pos, {_RUN_SQL} AS run FROM ip),
dp AS (SELECT r, w, unnest(range(0, len(w) - {RUN - 1})) AS pos FROM d),
ds AS (SELECT r, pos, {_RUN_SQL} AS run FROM dp),
h AS (SELECT DISTINCT r, q, ds.pos - js.pos AS shift FROM ds JOIN js USING (run)),
e AS (SELECT d.doc_id, i.item_id, len(i.w) AS n_item, list_transform(range(0, len(i.w)), lambda k:
    CASE WHEN shift + k >= 0 AND shift + k < len(d.w) AND d.w[shift + k + 1] = i.w[k + 1] THEN 1 ELSE 0 END) AS equal FROM h JOIN d USING (r) JOIN i USING (q)),
b AS (SELECT *, least({WINDOW}, n_item) AS win FROM e WHERE list_sum(equal) >= {MIN_ITEM}),
f AS (SELECT *, list_max(list_transform(range(1, n_item - win + 2), lambda k: list_sum(equal[k:k + win - 1]))) AS best FROM b)
SELECT doc_id, item_id, max(list_sum(equal))::BIGINT AS n_equal, max(n_item)::BIGINT AS n_item FROM f
WHERE best >= CASE WHEN n_item <= {EXACT} THEN n_item ELSE ceil({SHARE} * win) END GROUP BY doc_id, item_id
"""
