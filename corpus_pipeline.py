"""A corpus in five stages, each on all that the stage before kept.

quality rules drop what they reject; of near-duplicates the smallest doc_id stays; documents with a benchmark passage
go; personal data gives way to its kind in brackets; the last stage mixes sources and returns the documents' columns
with mix_size, mix_target and mix_taken (words that the mix takes, repeats counted).

Each stage has the defined results of its operator for nulls, empty and long texts, ties, repeats and other columns.

What a stage returns reads tables that it wrote. They stay until the next stage is called with documents that were written
after them, which are its result read again; documents from before them free nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import decontaminate, mixing, pii, quality_rules, simhash
from gleaner.llm.texts import read
from gleaner.plans.storage import delete, discard, materialize, recorded, written_after


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: The tables of each stage's last call, by its place.
_left: dict[int, list[str]] = {}


def _freeing(place: int, stage: Stage) -> Stage:
    """The stage, which first deletes what the stage before it left, if docs was written after that."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _left.get(place - 1, [])
        if before and written_after(docs, before):
            delete(spark, _left.pop(place - 1))
        with recorded() as tables:
            out = stage(spark, docs, sf_dir)
        _left[place] = tables
        return out

    return run_stage


STAGES = [
    (name, _freeing(place, stage))
    for place, (name, stage) in enumerate(
        [
            ("quality rules", quality),
            ("near duplicates", near_duplicates),
            ("decontamination", decontamination),
            ("personal data", personal_data),
            ("mixing", mix),
        ]
    )
]

#: Fingerprints and their components have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        before, docs = docs, materialize(out, name.replace(" ", "-"))
        if k:
            discard(before)
