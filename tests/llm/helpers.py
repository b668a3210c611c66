"""Fixtures of the operators' tests: odd tables, and plain versions to compare with."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside.
CLASH = ["key", "row", "n", "size", "kept", "node", "fp", "h", "spans", "score", "label", "taken", "target", "at", "words", "_m"]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    made = ["".join(r.choice(["ar", "en", "ti", "on", "the", "is", "mo", "la"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(w if i % 4 else r.choice(["the", "of", "and", "to", "in"]) for i, w in enumerate(made)).capitalize() + "."


def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeats, ties."""
    long_ = " ".join(prose(60, k) for k in range(150))
    base = prose(120, 1)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " end", "en", None, None), (4, None, "en", "b", 0), (5, "", None, "b", 0),
        (6, " \n\t ", "de", "", 3), (7, long_, "en", "c", len(long_)), (7, long_, "en", "c", len(long_)), (8, "one", "xx", "c", 3), (8, "two words", "xx", "c", 9),
        (None, prose(90, 2), "fr", "d", 5), (None, None, None, None, None), (None, prose(90, 2), "fr", "d", 5), (9, "é" * 5000, "en", "a", 5000), (10, "x" * 30000, "en", "a", 1),
        (11, "er " * 3000, "en", "a", 1), (12, "mail jo@site.org or +1 (555) 010-9999, 10.0.0.1 and 4111 1111 1111 1111 now", "en", "e", 1), (13, "\U0001f600 \U0001f600 a@b.cd", "en", "e", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted(map(str, df.collect()))
