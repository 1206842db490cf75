from __future__ import annotations

import random

import edge
import pytest

from crestline.llm import decontam


def least(item: str, text: str) -> int:
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        before, column[0] = column[:], 0
        for i, x in enumerate(item, 1):
            column[i] = min(before[i] + 1, column[i - 1] + 1, before[i - 1] + (x != c))
        best = min(best, column[-1])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_matcher_equals_dynamic_programming(seed):
    r = random.Random(seed)
    word = lambda n: decontam.normalised("".join(r.choice("abc ") for _ in range(n)))
    items = [(i, t) for i, t in enumerate(word(r.randint(8, 90)) for _ in range(4)) if t]
    rate = r.choice([0.05, 0.1, 0.2])
    text = word(60)
    for _, t in items:
        e = list(t)
        for _ in range(r.randint(0, int(rate * len(t)) + 2)):
            e[r.randrange(len(e))] = r.choice(["", "x", "aa", "c"])
        text += "".join(e) + word(30)
    text = decontam.normalised(text)
    want = sorted((i, d) for i, t in items if (d := least(t, text)) <= int(rate * len(t)))
    assert [x[:2] for x in decontam.Matcher(items, rate).find(text)] == want


def test_pieces_make_the_item():
    for k in range(5):
        pieces = decontam.cut("abcdefghij", k)
        assert len(pieces) == k + 1 and "".join(p for _, p in pieces) == "abcdefghij"


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_edges(spark, monkeypatch):
    near = edge.prose(2, 300).split()
    item = " ".join(near[50:90])
    edited = item.replace("th", "ht", 2).upper().replace(" ", ", ")
    items = benchmark(spark, [(1, item), (2, item), (3, edited), (4, None), (5, ""), (6, "..."), (None, item), (7, edge.prose(77, 40))])
    docs = edge.docs(spark)
    got = sorted((r.doc_id, r.item_id) for r in decontam.matches(docs, items).collect())
    assert got == sorted((d, i) for d in (7, 8, 9, 13) for i in (1, 2, 3))
    clean = decontam.keep_clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in edge.rows() if r[0] not in (7, 8, 9, 13))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)  # several blocks, several passes
    assert sorted((r.doc_id, r.item_id) for r in decontam.matches(docs, items).collect()) == got
    assert decontam.keep_clean(docs, items).count() == clean.count()
    assert decontam.matches(edge.empty(spark), items).count() == 0
    assert decontam.matches(docs, items.limit(0)).count() == 0 and decontam.keep_clean(docs, items.limit(0)).count() == docs.count()


def test_repeated_items_are_held_once(spark, monkeypatch):
    item = edge.prose(8, 20)
    rows = [(1, item)] * 200 + [(1, item.upper())] * 50 + [(2, edge.prose(9, 20)), (3, edge.prose(10, 20))]
    items = benchmark(spark, rows).repartition(3)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 300)
    blocks = list(decontam._blocks(items, "item_id", "text"))
    assert sorted(i for b in blocks for i, _ in b) == [1, 2, 3] and len(blocks) < 5
    docs = spark.createDataFrame([(1, "before " + item + " after")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.matches(docs, items).collect()] == [(1, 1)]
    assert decontam.keep_clean(docs, items).count() == 0


def test_query_finds_what_contains_an_item(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, decontam.normalised(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    exact = {(d.doc_id, i) for d in docs for i, t in items if t in decontam.normalised(d.text)}
    got = decontam.op9_decontamination(spark, sf).collect()
    assert exact and {(r.doc_id, r.item_id) for r in got if r.distance == 0} == exact
    assert all(r.distance <= r.budget for r in got)
