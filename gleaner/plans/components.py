"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each step is an aggregate and an equi-join on the
node. A node with more than HEAVY links (the centre of a large component becomes one) is dealt out over SALTS tasks: its
links are aggregated by salt, the salts' results (SALTS rows at most) by node, and those go back to the salts, so no task
holds all links of a node, without relying on AQE. Nothing is collected but a count, a checksum and the largest number
of links of a node per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.plans.storage import discard, materialize, shuffled

#: Links of a node up to which they are read by one task.
HEAVY = 1000
SALTS = 64


def with_group_min(rows: DataFrame, key: str, value, spread: str, salts: int = SALTS) -> DataFrame:
    """rows with least, the minimum of value over all rows of the same key; spread: a column by whose hash a key's rows are dealt out. With one salt it is one aggregate and one join."""
    if salts == 1:
        return rows.join(shuffled(rows.groupBy(key).agg(F.min(value).alias("least"))), key)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    of_salt = rows.groupBy(key, "_salt").agg(F.min(value).alias("least"))
    of_key = of_salt.withColumn("least", F.min("least").over(W.partitionBy(key)))
    return rows.join(shuffled(of_key), [key, "_salt"]).drop("_salt")


#: Keys with more than HEAVY rows up to which they are broadcast.
BROADCAST_HEAVY = 100_000


def spread_join(rows: DataFrame, table: DataFrame, key: str, spread: str, heavy: int = HEAVY, salts: int = SALTS) -> DataFrame:
    """rows joined with table (one row per key) on key. Rows of a key with over heavy of them are dealt out over salts tasks by the hash of spread, and the table's row for that key is repeated for each; there are at most one such key for every heavy rows, and their number is checked before they are broadcast."""
    busy = materialize(rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > heavy).select(key), "heavy")
    n = busy.count()
    if n == 0:
        return rows.join(table, key)
    busy = busy.withColumn("_busy", F.lit(True))
    busy = F.broadcast(busy) if n <= BROADCAST_HEAVY else busy
    salt = F.when(F.col("_busy"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    dealt = rows.join(busy, key, "left").withColumn("_salt", salt).drop("_busy")
    copies = table.join(busy.select(key), key).withColumn("_salt", F.explode(F.sequence(F.lit(1), F.lit(salts - 1))))
    held = table.withColumn("_salt", F.lit(0)).unionByName(copies)
    return dealt.join(held, [key, "_salt"]).drop("_salt")


def _large_star(edges: DataFrame, salts: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return with_group_min(both, "u", F.col("v"), "v", salts).where("v > u").select(F.col("v").alias("a"), F.least("u", "least").alias("b"))


def _small_star(edges: DataFrame, salts: int) -> DataFrame:
    """edges: a > b."""
    found = with_group_min(edges, "a", F.col("b"), "b", salts)
    moved = found.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(found.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def _state(edges: DataFrame):
    """Count, checksum, and the most links of a node."""
    ends = edges.select(F.col("a").alias("u"), F.xxhash64("a", "b").alias("h")).unionAll(edges.select(F.col("b").alias("u"), F.lit(0).cast("long").alias("h")))
    by_node = ends.groupBy("u").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h"))
    return by_node.agg(F.sum("n"), F.sum("h"), F.max("n")).first()


def components(edges: DataFrame, rounds: int = 60, heavy: int | None = None) -> DataFrame:
    """edges: columns a and b (long, not null); returns node and component (its smallest node) of every node that has a link.

    Loops and repeated links are ignored; an empty input gives an empty result.
    """
    heavy = HEAVY if heavy is None else heavy
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct(), "links"
    )
    mark = _state(now)
    for _ in range(rounds):
        if mark[0] is None:
            break
        # A step may triple a node's links before the next count; centres only grow towards their component.
        salts = 1 if mark[2] <= heavy else SALTS
        starred = materialize(_large_star(now, salts).distinct(), "links")
        after = materialize(_small_star(starred, salts), "links")
        discard(now)
        discard(starred)
        now, row = after, _state(after)
        if row[:2] == mark[:2]:
            break
        mark = row
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
