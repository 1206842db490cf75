from __future__ import annotations

import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.llm import langid

SF_DIR = "/root/testdata/sf0.001"


def test_held_out_accuracy_and_contract(spark):
    got = langid.op1_language_id(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    crc = dict(docs.select("doc_id", F.expr("crc32(cast(doc_id as string)) % 3 = 1")).collect())
    assert all(r.held_out == crc[r.doc_id] for r in rows)


def test_edges(spark):
    docs = edge.docs(spark)
    model = langid.fit(docs)
    assert set(model.languages) == {"en", "xx"}
    rows = langid.predict(docs, model, extra=[F.col("doc_id"), F.col("text")]).collect()
    assert len(rows) == len(edge.rows())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or (r.score == 0 and r.rejected)


def test_nothing_to_learn_from(spark):
    model = langid.fit(edge.empty(spark))
    assert {r.lang_pred for r in langid.predict(edge.docs(spark), model).collect()} == {"und"}
    assert langid.predict(edge.empty(spark), model).count() == 0


def test_nearest_centroid_by_hand():
    x = np.eye(4, dtype=np.float32)
    model = langid.Model(("a", "b"), np.ones(langid.DIM), np.zeros((2, langid.DIM), np.float32), np.array([0, 1]), np.zeros(2))
    centre = [langid.weigh(langid.counts(t)[None], model.idf)[0] for t in ("aaa bbb", "ccc ddd")]
    model.centroids[:] = centre
    langs, scores, _ = model.predict(["aaa bbb", "CCC, DDD!", "ccc", None])
    assert langs == ["a", "b", "b", "und"] and scores[0] == pytest.approx(1) and scores[1] == pytest.approx(1)
    assert len(langid.cluster(x, 9)[0]) == 4


def test_long_texts_are_read_whole(monkeypatch):
    whole = langid.counts("abc def " * 50)
    monkeypatch.setattr(langid, "CHUNK", 8)
    parts = langid.counts("abc def " * 50)
    # A piece ends like a word, so only n-grams across its edges differ.
    assert parts.sum() > 0.9 * whole.sum() and (parts > 0).sum() >= (whole > 0).sum() - 2
