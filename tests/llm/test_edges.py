"""Every operator and stage: odd rows, empty tables and clashing columns give defined results."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import chaining, decontaminate, knn_quality, mixing, pii, pseudo_likelihood, quality_rules, simhash, suffix_dedup, warc
from gleaner.plans.storage import new_path
from tests.llm.helpers import empty_docs, odd_docs, prose, rows, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def _bench(spark):
    return spark.createDataFrame([(1, prose(120, 1)[40:300]), (2, None), (3, ""), (None, "a b c"), (1, prose(120, 1)[40:300])], "item_id long, text string")


def _labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 0), (11, 0, None), (11, 0, 1), (None, 1, 0), (3, None, 0), (99, 1, 0)], LABELS)


def _likelihood(docs):
    model = pseudo_likelihood.untrained(docs)
    ids = pseudo_likelihood.encoded(docs, model)
    return pseudo_likelihood.scored(ids, pseudo_likelihood.fitted(ids, model))


OPERATORS = {
    "op1": lambda s, d: pii.personal_data(d, ["doc_id"]).selectExpr("row.doc_id as doc_id", "cast(spans as string) as spans"),
    "op2": lambda s, d: knn_quality.scored(d, knn_quality.fit(d, _labels(s))),
    "op3": lambda s, d: chaining.passage_classes(d),
    "op4": lambda s, d: suffix_dedup.deduplicated(d).drop("spans"),
    "op6": lambda s, d: mixing.mixed(d, ["doc_id"]).selectExpr("row.doc_id as doc_id", "size", "source_size", "target", "taken"),
    "op7": lambda s, d: simhash.simhash_components(d).select("doc_id", "fp", "component_id"),
    "op8": lambda s, d: _likelihood(d),
    "op9": lambda s, d: quality_rules.judged(d, ["doc_id"]).selectExpr("row.doc_id as doc_id", "n_words", "n_repeat_words", "kept"),
    "op10": lambda s, d: decontaminate.leaks(d, _bench(s)).select("doc_id", "item_id", "n_equal"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, name):
    plain = OPERATORS[name](spark, odd_docs(spark))
    got = rows(plain)
    if name != "op10":
        assert len(got) == odd_docs(spark).count()
    assert got == rows(OPERATORS[name](spark, with_clashes(odd_docs(spark))))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark, empty_docs(spark)).count() == 0


def test_training_on_odd_and_empty_tables(spark):
    odd, none = pseudo_likelihood.train(odd_docs(spark)), pseudo_likelihood.train(empty_docs(spark))
    assert set(odd.net) == set(none.net) and all((none.net[k] == v).all() for k, v in pseudo_likelihood.start().items())
    assert none.total == 0 and not len(none.own)


def test_no_labels_and_no_benchmark(spark):
    d = odd_docs(spark)
    no = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in knn_quality.scored(d, knn_quality.fit(d, no)).collect()} == {0.5}
    assert decontaminate.leaks(d, spark.createDataFrame([], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("step", range(5))
def test_stages_keep_columns(spark, step):
    name, stage = corpus_pipeline.STAGES[step]
    sf = "/root/testdata/sf0.001"
    for docs in (odd_docs(spark), empty_docs(spark), with_clashes(odd_docs(spark))):
        out = stage(spark, docs, sf)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert step == 4 or out.columns == docs.columns
        assert out.count() <= docs.count()


def test_warc_of_an_empty_table(spark):
    path = new_path(spark, "none")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_warc_of_odd_pages_and_clashing_columns(spark):
    made = [(1, "http://a/ b", "x" * 3000), (2, None, "x" * 3000), (2, "u", None), (None, "http://c", ""), (3, "", "é" * 700), (3, "", "é" * 700), (4, "u", "WARC/1.1\r\n" * 9)]
    pages = spark.createDataFrame(made, "page_id long, url string, html string")

    def back(df):
        path = new_path(spark, "odd")
        warc.write_archives(df, path, size=500)
        return rows(warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))

    got = back(pages)
    assert len(got) == len(made)
    clashing = pages.select("*", *[F.lit(k).alias(c) for k, c in enumerate(["payload", "n_bytes", "digest", "first", "revisit", "record", "value", "n"])])
    assert got == back(clashing)


def test_chunk_table_carries_the_running_digest(spark):
    pages = spark.createDataFrame([(1, "u", "abcdé" * 400)], "page_id long, url string, html string")
    chunks = warc.chunks(pages, size=300).orderBy("chunk_no").collect()
    payload, at = ("abcdé" * 400).encode(), 0
    assert len(chunks) > 5 and [c["chunk_no"] for c in chunks] == list(range(len(chunks)))
    for c in chunks:
        body = c["value"].encode().split(b"\r\n\r\n", 2)[-1]
        at += len(body)
        assert c["running_digest"] == base64.b32encode(hashlib.sha1(payload[:at]).digest()).decode()
    assert at == len(payload)
