"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key -ln(u) / weight, u in (0, 1) from the MD5 of its id and text, weight its quality (any
positive column; quality_weight() unless one is given); within a source the smallest keys come first, by id and by the
text's MD5 among equals, which is weighted sampling without replacement and the same in every run. A source's target is its weight's share
of SHARE times all words, but at most LIMIT times its own words; the excess is reshared by weight until none is above.
The closed form: with caps c and weights w there is one level l with sum(min(c, l * w)) = total; targets are min(c, l * w).

A target of at least a source's words takes whole epochs of every document first. What is left is filled in key order
by prefix sums; the document on the edge gives the words that are still missing, so each source meets its target to
within a word.

The prefix sum of a hot source is not one task's: keys fall into BUCKETS monotone buckets, key / (1 + key) of the way, so
that no range of weights saturates them. Their sums alone are prefix-summed per source, coarse ones first, then those of
one coarse bucket. That names the bucket on the edge; buckets before it are taken whole, later ones not at all,
and only the edge bucket's documents are ordered one by one.

Defined results: null texts have size 0 and take 0; null sources are a source of their own, last in order; a total of
0 words gives targets of 0; rows that repeat id and text share their key and each count (which of them gets what is
all one); a null id is as good as any, as the text tells rows apart; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.texts import n_words, read
from gleaner.plans.storage import materialize

# Weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
BUCKETS = 1 << 16
#: Bits of a bucket's number that its coarse bucket leaves out: prefix sums run over coarse buckets, then within one.
COARSE = 8
SEED = "mix"
#: Sources up to which their targets are broadcast.
BROADCAST_SOURCES = 20_000
# Characters that count against a text, and the share of blanks under which its words are long.
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
MIN_BLANKS = 0.1


def quality_weight(text: str) -> Column:
    """From 1 for plain prose down to 1/46: less for symbols, digits and words of unusual length."""
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda chars: (F.length(text) - F.length(F.translate(F.col(text), chars, ""))) / size
    blanks = share(" \n\t")
    odd = F.greatest(F.lit(0.0), F.lit(MIN_BLANKS) - blanks) / MIN_BLANKS
    return F.coalesce(1 / (1 + 20 * share(SYMBOLS) + 5 * share(DIGITS) + 20 * odd), F.lit(1.0))


def text_md5(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def es_key(id_: str, text_hash: Column, weight: Column, seed: str = SEED) -> Column:
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_).cast("string"), F.lit("")), text_hash)
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def targets(sizes: DataFrame) -> DataFrame:
    """sizes: source and source_size, a row per source. Adds target."""
    df = sizes.withColumn("_n", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    df = df.withColumn("_w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_n") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    df = df.withColumn("_cap", F.lit(float(LIMIT)) * F.col("source_size")).withColumn("_r", F.col("_cap") / F.col("_w"))
    order, all_ = W.orderBy("_r", "_n"), W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    level = (SHARE * F.sum("source_size").over(all_) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    df = df.withColumn("_level", level).withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_r"), F.col("_level"))).over(all_))
    return df.select("source", "source_size", F.coalesce(F.least("_cap", F.col("_level") * F.col("_w")), F.col("_cap")).alias("target"))


def _edge(sums: DataFrame, plan: DataFrame) -> DataFrame:
    """sums: source, slot, words; plan: source, left. edge, the slot in which a source's words reach left, and room, what is left there."""
    upto = F.sum("words").over(W.partitionBy("source").orderBy("slot").rowsBetween(W.unboundedPreceding, 0))
    reached = sums.withColumn("upto", upto).join(plan.withColumnRenamed("source", "s"), F.expr("source <=> s")).where("upto > left and upto - words <= left")
    return reached.groupBy("source").agg(F.min("slot").alias("edge"), F.min_by(F.col("left") - (F.col("upto") - F.col("words")), "slot").alias("room"))


def mixed(docs: DataFrame, carry: list[str], weight: Column | None = None) -> DataFrame:
    """row (the carried columns), source, size, source_size, target and taken. weight: a positive column of docs, a document's quality."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry])
    df = docs.select(row.alias("row"), F.col("source"), n_words(F.col("text")).alias("size"), es_key("doc_id", text_md5("text"), quality_weight("text") if weight is None else weight).alias("key"), F.col("doc_id").alias("id"), text_md5("text").alias("tie"))
    df = df.withColumn("bucket", F.least(F.floor(F.col("key") / (1 + F.col("key")) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    df = materialize(df, "sizes")
    buckets = materialize(df.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    plan = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")))
    budget = F.floor("target").cast("long")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    plan = materialize(plan.withColumn("left", budget - F.col("epochs") * F.col("source_size")), "targets")
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    coarse = F.shiftright("bucket", COARSE).alias("slot")
    outer = _edge(buckets.groupBy("source", coarse).agg(F.sum("words").alias("words")), plan.select("source", "left"))
    inside = buckets.join(outer.withColumnRenamed("source", "s"), F.expr(f"source <=> s and shiftright(bucket, {COARSE}) = edge"))
    edge = _edge(inside.select("source", F.col("bucket").alias("slot"), "words"), outer.select("source", F.col("room").alias("left")))
    plan = materialize(plan.join(edge.withColumnRenamed("source", "s"), F.expr("source <=> s"), "left").drop("s"), "edges")
    plan = plan.withColumnRenamed("source", "s")
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    df = df.join(plan, F.expr("source <=> s"))
    inner = df.where("bucket = edge")
    before = F.coalesce(F.sum("size").over(W.partitionBy("source").orderBy("key", "id", "tie").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inner = inner.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - before)))
    outer = df.where("edge is null or bucket <> edge").withColumn("part", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0)))
    out = inner.unionByName(outer)
    return out.select("row", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def op6(spark, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"), ["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of docs with size, target and taken."""
    return mixed(docs, docs.columns).select("row.*", F.col("size").alias("mix_size"), F.col("target").alias("mix_target"), F.col("taken").alias("mix_taken"))


OP6_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / coalesce(1 / (1 + 20 * ((length(text) - length(translate(text, '#*$%&|<>', ''))) / greatest(length(text), 1)::DOUBLE)
        + 5 * ((length(text) - length(translate(text, '0123456789', ''))) / greatest(length(text), 1)::DOUBLE)
        + 20 * (greatest(0::DOUBLE, 0.1::DOUBLE - (length(text) - length(translate(text, ' ' || chr(10) || chr(9), ''))) / greatest(length(text), 1)::DOUBLE) / 0.1::DOUBLE)), 1.0) AS key,
    md5(coalesce(text, '')) AS tie
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
w AS (SELECT *, CASE n % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / w AS r,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY cap / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, coalesce(least(cap, w * max(CASE WHEN level <= r THEN level END) OVER ()), cap) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, size, source_size, target, epochs, floor(target)::BIGINT - epochs * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p
"""
