"""A stored index of perceptual codes, to which batches are added.

codes holds each code once; keys holds it under all its segment keys (operators/neardup.py), in buckets of a key's part and
value; near holds the pairs within the distance. A batch files its new codes only, meets what is stored under the same
keys, and goes beside it, so stored codes are never filed or compared with each other again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import neardup
from gleaner.plans.buckets import Buckets
from gleaner.plans.storage import materialize


class CodeIndex:
    def __init__(self, spark: SparkSession, root: str, distance: int):
        self.spark, self.distance = spark, distance
        root = f"{root.rstrip('/')}/within-{distance}"
        self.codes = Buckets(spark, f"{root}/codes", "code long", ["code"])
        self.keys = Buckets(spark, f"{root}/keys", "code long, part int, value long, near int", ["part", "value"])
        self.near = Buckets(spark, f"{root}/near", "a long, b long, d int", ["a"])

    def add(self, codes: DataFrame) -> int:
        """codes: column code, repeats and known ones allowed. How many were new. A failure halfway leaves a batch that a repeated add() completes: codes, which says what is known, is written last, and what repeats in the others is dropped when it is read."""
        new = codes.select("code").where("code is not null").distinct().join(self.codes.read(), "code", "left_anti")
        new = materialize(new, "new-codes")
        n = new.count()
        if n:
            mine, stored = materialize(neardup.filed(new, self.distance), "filed"), self.keys.read()
            pairs = neardup.meeting(mine, stored.unionByName(mine), self.distance).unionByName(neardup.meeting(stored, mine, self.distance)).distinct()
            self.near.add(pairs)
            self.keys.add(mine)
            self.codes.add(new)
        return n

    def pairs(self, codes: DataFrame | None = None) -> DataFrame:
        """a < b and d of all stored pairs, or of those that have one of the codes."""
        near = self.near.read().distinct()
        if codes is None:
            return near
        own = codes.select("code").distinct()
        left = near.join(own.select(F.col("code").alias("a")), "a", "left_semi")
        return left.unionByName(near.join(own.select(F.col("code").alias("b")), "b", "left_semi").select("a", "b", "d")).distinct()
