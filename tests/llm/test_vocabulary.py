"""Words that no pattern names are not shuffled."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.llm import pii


def test_only_words_of_patterns_are_counted(spark):
    docs = spark.createDataFrame([(f"mail me w{k} mail",) for k in range(50)] + [(None,), (" ",)], "text string")
    word, two = F.xxhash64(F.lit(1), F.xxhash64(F.lit("mail"))), F.xxhash64(F.lit(2), F.xxhash64(F.lit("mail")), F.xxhash64(F.lit("me")))
    after = F.xxhash64(F.lit(3), F.xxhash64(F.lit("me")))
    pats = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(s).alias("sort"), p.alias("pat")) for s, p in ((1, word), (2, two), (3, after))])).alias("x")).select("x.*")
    want = {tuple(r) for r in pats.select("pat", F.when(F.col("sort") == 1, 100).otherwise(50)).collect()}
    for few in (1000, 1):
        pii.FEW_PATTERNS, before = few, pii.FEW_PATTERNS
        for small in (True, False):
            got = pii._totals(docs, pats, small)
            assert {(r["pat"], r["total"]) for r in got.collect()} == want
            assert (" IN (" in got._jdf.queryExecution().optimizedPlan().toString()) == (small and few == 1000)
        pii.FEW_PATTERNS = before
