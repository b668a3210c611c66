"""Vectors by blocks: what searches for the nearest rows of a query share.

An index deals rows into blocks of bounded size. A search deals each query to the blocks that it has to visit; a task
reads a block's rows first, then streams the queries that visit it, in batches. Each visit leaves one row with its best
K, and merged() keeps the best K of a query over its visits, again as a stream. So a task holds one block and a batch of
queries, whatever the number of either. A block with many queries is read by several tasks (QUERIES_EACH).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.plans.storage import partitions

#: Rows of a block, and queries that one task takes through a block, on average.
BLOCK_ROWS = 1 << 17
QUERIES_EACH = 1 << 16
#: Rows of a block below which more blocks only cost more visits.
LEAST_ROWS = 1024


def finite(v: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def one_each(rows: DataFrame) -> DataFrame:
    """rows: id, v and others. Of rows that share an id the smallest stays."""
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return rows
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.min(F.struct(*rest)).alias("x")).select("id", *[F.col(f"x.{c}").alias(c) for c in rest])


def few_equal(rows: DataFrame, same: list[str], most: int) -> DataFrame:
    """rows without those that can't be among a query's best: of rows with equal columns same (v among them) the most smallest ids stay.

    Equal vectors score alike and ties go to smaller ids, so for a search of k rows besides the query's own, k + 1 are enough.
    """
    h = F.xxhash64(*same)
    if rows.groupBy(h.alias("h")).agg(F.count("*").alias("n")).where(F.col("n") > most).isEmpty():
        return rows
    nth = F.row_number().over(W.partitionBy("_h", *same).orderBy("id"))
    return rows.withColumn("_h", h).withColumn("_nth", nth).where(F.col("_nth") <= most).drop("_h", "_nth")


def padded(v: Column, width: int) -> Column:
    return F.concat(v, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(v)))


def n_blocks(spark, n: int) -> int:
    """Blocks for n rows: as many as the shuffle has partitions where the rows suffice, and no larger than BLOCK_ROWS."""
    return max(-(-n // BLOCK_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST_ROWS)), 1)


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column whose rows have one length."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(n, -1)


def visit(rows: DataFrame, visits: DataFrame, n_queries: int, build: Callable, answer: Callable, schema: str) -> DataFrame:
    """What answer(build(rows of a block), a batch of its visits) yields, over all blocks. rows and visits: block (long) and other columns; visits: id."""
    spark = rows.sparkSession
    chunks = -(-n_queries // QUERIES_EACH)
    rows = rows.withColumns({"_chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))) if chunks > 1 else F.lit(0), "_kind": F.lit(0)})
    visits = visits.withColumns({"_chunk": F.pmod(F.xxhash64("id"), F.lit(max(chunks, 1))).cast("int"), "_kind": F.lit(1)})
    both = rows.unionByName(visits, allowMissingColumns=True)

    def run(batches):
        now, held, built = None, [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "_chunk", "_kind")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if batch.num_rows else []
            starts = [0, *new, batch.num_rows]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if s == e:
                    continue
                part, at = batch.slice(s, e - s), (keys[0][s], keys[1][s])
                if at != now:
                    now, held, built = at, [], None
                if keys[2][s] == 0:
                    held.append(part)
                elif held:
                    built = built or build(pa.Table.from_batches(held).combine_chunks())
                    yield from answer(built, part)

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions(rows))
    return both.repartition(n, "block", "_chunk").sortWithinPartitions("block", "_chunk", "_kind").mapInArrow(run, schema)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def merged(found: DataFrame, k: int, kind: str) -> DataFrame:
    """found: id, part (int) and arrays ids and scores. id, part, rank (from 1), found and score (of type kind) of the k best of each id and part."""
    spark = found.sparkSession

    def run(batches):
        now, ids, scores = None, None, None
        out = [[], [], [], []]

        def end():
            if now is not None:
                for col, x in zip(out, (np.full(len(ids), now[0]), np.full(len(ids), now[1], np.int32), ids, scores), strict=True):
                    col.append(x)

        def rows():
            cols = [np.concatenate(c) for c in out]
            rank = np.concatenate([np.arange(1, len(x) + 1, dtype=np.int32) for x in out[2]])
            for c in out:
                c.clear()
            return pa.record_batch([pa.array(x) for x in (cols[0], cols[1], rank, cols[2], cols[3])], names=["id", "part", "rank", "found", "score"])

        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "part")]
            for j in range(batch.num_rows):
                at = (int(keys[0][j]), int(keys[1][j]))
                more = [batch.column(c)[j].values.to_numpy(zero_copy_only=False) for c in ("ids", "scores")]
                if at != now:
                    end()
                    now, ids, scores = at, *more
                else:
                    ids, scores = np.concatenate((ids, more[0])), np.concatenate((scores, more[1]))
                ids, scores = best(ids, scores, k)
            if out[0]:
                yield rows()
        end()
        if out[0]:
            yield rows()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return found.select("id", "part", "ids", "scores").repartition(n, "id").sortWithinPartitions("id", "part").mapInArrow(run, f"id long, part int, rank int, found long, score {kind}")
