from __future__ import annotations

import re
from collections import defaultdict

import edge
import pytest

from crestline.llm import mixing

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, out = set(order), {}
    while left:
        rest = sum(sizes.values()) - sum(out.values())
        level = rest / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > cap * sizes[s]}
        out |= {s: cap * sizes[s] for s in over} or {s: weight[s] * level for s in left}
        left = left - over if over else set()
    return out


def check(docs, rows: list, near: float) -> None:
    sizes: dict = defaultdict(int)
    for r in docs:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want, taken = targets(sizes), defaultdict(int)
    source = {r.doc_id: r.source for r in docs}
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near * t + 1


def test_query_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()
    rows = mixing.op10_source_mixing(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    check(docs, rows, 0.05)
    again = mixing.op10_source_mixing(spark, SF_DIR).collect()
    assert sorted(rows) == sorted(again)


def test_rates_are_tilted_exponentially(spark):
    rows = [(i, "w " * (i % 40 + 1), "a" if i % 3 else "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    state = mixing.solve(docs)
    for s in state.collect():
        words = [i % 40 + 1 for i in range(3000) if ("a" if i % 3 else "b") == s._source]
        rates = [min(3, 2.718281828459045 ** (s._lambda * z / s._scale)) for z in words]
        assert sum(r * z for r, z in zip(rates, words)) == pytest.approx(s._target, rel=1e-5)


def test_small_sources_stop_at_the_cap(spark):
    rows = [(i, "w " * 10, "a") for i in range(5)] + [(i, "w " * 10, "z") for i in range(10, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts["a"] == 15 and abs(counts["z"] - 380) <= 2 and mixed.columns == docs.columns


@pytest.mark.parametrize("same", [True, False])
def test_documents_of_no_or_one_id_meet_the_targets(spark, same):
    """Rows that only their place or only their text tells apart."""
    rows = [(None if i % 2 else 7, "w " * 10 + ("" if same else f"x{i}"), "a" if i < 450 else "b") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.apply_mix(docs, mixing.solve(docs)).collect()
    for s in ("a", "b"):
        own = [r for r in out if r._row.source == s]
        assert sum(r._copies * r._z for r in own) == pytest.approx(float(own[0]._target), rel=0.05)


def test_edges(spark):
    docs = edge.docs(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() > 0
    whole = mixing.apply_mix(docs, mixing.solve(docs)).collect()
    assert len(whole) == len(edge.rows()) and all(0 <= r._copies <= 3 for r in whole)
    sizes = {(r._row.doc_id, r._row.text): r._z for r in whole}
    assert all(z == len(WORD.findall(t or "")) for (_, t), z in sizes.items())
    assert mixing.mix(edge.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert {r._target for r in mixing.apply_mix(blank, mixing.solve(blank)).collect()} == {0.0}
