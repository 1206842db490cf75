from __future__ import annotations

import math
import re
from collections import Counter

import edge
import numpy as np
import oracle
import pytest

from crestline.llm import lexical

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, q string, number string, docs string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n, total = len(bags), sum(s for _, _, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        found = []
        for d, b, size in bags:
            m = 75 + (25 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_sql(spark):
    got = oracle.spark_result(lexical.op12_lexical_search(spark, SF_DIR))
    assert got[1] and got == oracle.duckdb_result(oracle.connect(SF_DIR), lexical.LEXICAL_SQL)


def items():
    near = edge.prose(2, 300)
    return [
        (1, near[:200]), (1, near[:200]), (1, "word X x"), (2, None), (3, ""), (4, "... --"), (None, "漢字 é"), (5, "ZZZ nothing"),
        (6, edge.prose(1, 400) + " th th th"), (7, "1234"), (8, "É é"),
    ]


@pytest.mark.parametrize("block,first,chars", [(4096, 16, 200_000), (3, 2, 200_000), (1, 1, 2000)])
def test_edges_equal_brute_force(spark, monkeypatch, block, first, chars):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "FIRST", first)
    monkeypatch.setattr(lexical, "ITEM_CHARS", chars)
    asked = spark.createDataFrame([(*i, "x", "y", "z") for i in items()], ITEMS)
    want = brute([(r[0], r[1]) for r in edge.rows()], items())
    assert len(want) > 20
    assert result(lexical.search(edge.docs(spark), asked)) == want


def test_empty_tables(spark):
    asked = spark.createDataFrame([(*i, "x", "y", "z") for i in items()], ITEMS)
    assert result(lexical.search(edge.empty(spark), asked)) == []
    assert result(lexical.search(edge.docs(spark), asked.limit(0))) == []
    nothing = spark.createDataFrame([(1, None), (2, "?!")], "doc_id long, text string")
    assert result(lexical.search(nothing, asked)) == []


def test_most_documents_are_never_scored():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words, 60) if i % 7 else ["w1"] * (i % 40 + 1) + ["w2"]) for i in range(600)]
    bags = [Counter(t.split()) for t in texts]
    df = Counter(t.encode() for b in bags for t in b)
    sizes = [sum(b.values()) for b in bags]
    block = lexical._Class(2048)
    hashes = lexical._Hashes()
    for i, b in enumerate(bags):
        h = np.array([hashes[t.encode()] for t in b], np.uint64)
        n = np.array(list(b.values()))
        block.add(i, sizes[i], texts[i].encode(), np.concatenate([lexical.level_keys(h[n >= at], j) for j, at in enumerate(lexical.LEVELS)]), [t.encode() for t in b])
    bits = np.frombuffer(block.row(0).column("bits")[0].as_py(), np.uint8).reshape(2048, -1)
    asked = [["w1", "w2", "w7", "w7", "w9"], ["w11", "w12"], ["w1"]]
    queries = lexical.Queries([[t.encode() for t in a] for a in asked], df, 600, sum(sizes), 5)
    read = []
    got = list(queries.search(sizes, list(range(600)), bits, lambda d: read.append(d) or texts[d].encode(), [0, 0, 0]))
    want = brute(list(enumerate(texts)), [(i, " ".join(a)) for i, a in enumerate(asked)], 5)
    assert sorted((q, d, s) for q, d, s in got) == sorted((q, d, s) for q, _, d, s in want)
    assert len(set(read)) < 250
