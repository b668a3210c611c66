"""Parities of long sets of shingles."""

from __future__ import annotations

import numpy as np

from gleaner.llm import simhash
from tests.llm.helpers import prose


def test_parities_bound_the_difference():
    made = np.random.default_rng(1)
    sets = [made.integers(0, 2**63, n).astype(np.uint64) for n in (5, 250, 600, 1500, 3000, 6000)]
    sets += [np.concatenate((x[: int(0.9 * len(x))], made.integers(0, 2**63, len(x) // 10).astype(np.uint64))) for x in sets]
    bits = simhash.Parities([simhash.travelling(simhash.parity_bits(np.unique(x))) for x in sets])
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    least = bits.apart(i, j)
    true = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i.tolist(), j.tolist(), strict=True)])
    assert (least <= true).all()
    assert (np.bitwise_count(bits.sketches()[i] ^ bits.sketches()[j]).sum(axis=1) <= least).all()


def test_long_unlike_texts_that_share_a_shingle_are_not_proposed(spark, monkeypatch):
    made, apart = [], simhash._apart
    monkeypatch.setattr(simhash, "_apart", lambda *a: made.append((out := apart(*a)).count()) or out)
    shared = lambda i, j: " ".join(f"both{min(i, j)}x{max(i, j)}x{w}" for w in range(6))
    rows = [(k, " ".join(prose(60, 1000 * k + j) + " " + shared(k, j) for j in range(24) if j != k)) for k in range(24)]
    rows += [(100 + k, rows[k][1] + " and some more words of it") for k in range(3)]
    found = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.select("component").distinct().count() == 24
    assert sum(made) < 20  # 276 pairs of texts share shingles; a sketch of 256 bits can't tell texts of 1,500 shingles apart


def test_shingles_are_shuffled_once_to_be_counted_and_texts_are_not(spark, monkeypatch):
    """By plans: shingles meet in one shuffle for their number and first holder, and in one for their components; copies are dropped as sets."""
    plans, write = {}, simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and None or write(df, name))
    base = [prose(80, k) for k in range(12)]
    rows = [(k, base[k % 12] + (f" more{k}" if k > 24 else "")) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.near_copies(docs).select("component").distinct().count() == 12
    initial = {name: plan.split("== Initial Plan ==")[-1] for name, plan in plans.items()}
    assert initial["prefixes"].count("Exchange") == 1 and initial["mixed"].count("hashpartitioning(h#") == 1
    assert initial["sets"].index("Exchange") < initial["sets"].index("MapInArrow")


def test_parts_of_a_shingle_are_those_of_all_its_holders(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 4)
    rows = [(1, k, k % 2, 9, 0) for k in range(10)] + [(2, k, 0, 9, 1) for k in range(10)] + [(3, 1, 1, 9, 2), (3, 2, 2, 9, 2)]
    got = simhash._mixed(spark.createDataFrame(rows, "h long, node long, component long, size int, place int"))
    assert sorted({(r["h"], r["parts"]) for r in got.collect()}) == [(1, 3), (3, 1)] and got.count() == 12


def test_holders_of_a_shingle_get_the_first_of_their_band(spark):
    rows = [(1, 5, 100, 0), (1, 4, 101, 1), (1, 3, 900, 2), (2, 9, 50, 0)]
    got = simhash._shared(spark.createDataFrame(rows, "h long, node long, size int, place int"))
    assert sorted((r["h"], r["node"], r["size"], r["place"], r["least"]) for r in got.collect()) == [(1, 3, 900, 2, 3), (1, 4, 101, 1, 4), (1, 5, 100, 0, 4)]


def test_kept_keys_are_not_broadcast(spark):
    docs = spark.createDataFrame([(k, prose(30, k % 3)) for k in range(9)], "doc_id long, text string")
    kept = simhash.keep_first(docs)
    plan = kept._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]
