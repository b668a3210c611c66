"""Words coded many at once, and counted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from gleaner.llm import hashes, pseudo_likelihood
from tests.llm.helpers import prose


def test_words_coded_at_once_are_those_coded_one_by_one(monkeypatch):
    texts = [None, "", "  ", "\ta  B\n\x0b c\x0c\r", "É é\xa0z A", *[prose(50, k) for k in range(9)], "x" * 300]
    memory = hashes.Codes()
    for size in (1, 200, 1 << 20):
        monkeypatch.setattr(hashes, "CODED", size)
        for column in (pa.array(texts), pa.array(["no", *texts]).slice(1)):
            got = list(hashes.coded(column))
            assert len(got) == len(texts) and all(np.array_equal(x, hashes.codes(t, memory)) for x, t in zip(got, texts, strict=True))
    assert not list(hashes.coded(pa.array([], pa.string())))


def test_words_of_all_texts_are_counted(spark):
    texts = [None, " ", "a B a", "b c", *[prose(80, k % 3) for k in range(20)]]
    memory = hashes.Codes()
    word, n = np.unique(np.concatenate([hashes.codes(t, memory) for t in texts]), return_counts=True)
    got = {r["word"]: r["n"] for r in pseudo_likelihood.word_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)).collect()}
    assert got == dict(zip(word.view(np.int64).tolist(), n.tolist(), strict=True))
