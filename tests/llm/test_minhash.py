from __future__ import annotations

import random

import edge
import numpy as np
import oracle
import pytest

from crestline.llm import minhash

SF_DIR = "/root/testdata/sf0.001"


def shingles(text: str | None, width: int) -> frozenset:
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows: list[tuple], width: int, percent: int = 80) -> list[tuple]:
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [d]
        least = min([x for x in ids if x is not None], default=None)
        out.append((d, len(sets[i]), least, least is None or d == least))
    return sorted(out, key=str)


def family(seed: int) -> list[tuple]:
    """Chains and stars of edited copies around the threshold."""
    r = random.Random(seed)
    rows = []
    for base in range(6):
        words = edge.prose(seed * 100 + base, r.choice([6, 30, 120])).split()
        for _ in range(r.choice([1, 4, 12])):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                copy[r.randrange(len(copy))] = edge.prose(r.random(), 1)
            rows.append(" ".join(copy))
            if r.random() < 0.5:
                words = copy  # a chain: ends need not be linked with each other
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = family(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in minhash.near_duplicates(docs, width=4).collect()]
    assert sorted(got, key=str) == brute(rows, 4)


def test_edges(spark):
    rows = [r[:2] for r in edge.rows()]
    got = [tuple(r) for r in minhash.near_duplicates(edge.docs(spark)).collect()]
    assert sorted(got, key=str) == brute(rows, 5)
    assert minhash.near_duplicates(edge.empty(spark)).count() == 0


def test_one_row_of_each_class_stays(spark):
    docs = edge.docs(spark)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    # 10 stays twice: its second text is in a class of its own.
    assert ids == sorted(map(str, [None, 1, 2, 3, 4, 5, 7, 10, 10, 11, 12, 15]))


def test_no_text_without_a_partner_is_lost(spark):
    """Rows of one id, or of none, with different texts; repeats of them and near copies."""
    a, b, c = (edge.prose(s, 60) for s in (21, 22, 23))
    rows = [(1, a), (1, b), (1, b), (None, c), (None, c + " more"), (None, a), (2, a), (None, edge.prose(24, 60)), (1, None), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in minhash.keep_one(docs).collect()), key=str)
    lone = [k for k in kept if k not in ((None, c), (None, c + " more"))]
    assert lone == sorted([(1, a), (1, b), (None, rows[7][1]), (1, None), (1, None)], key=str) and len(kept) == 6


def test_words_that_collide_under_any_polynomial_hash(spark):
    """The Thue-Morse words of a and b and their complements: no polynomial modulo 2**64 parts them."""
    texts = []
    for n in (1024, 2048):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        texts += [word, word.translate(str.maketrans("ab", "ba"))]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs, width=4).collect()) == [(i, 1, i, True) for i in range(4)]


def test_bits_never_differ_more_than_the_sets():
    rng = np.random.default_rng(1)
    for n in (3, 200, 5000):
        x = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], rng.integers(0, 1 << 64, n // 3, np.uint64)]))
        differ = np.bitwise_count((minhash.parity(x) ^ minhash.parity(y)).view(np.uint64)).sum()
        assert differ <= np.setxor1d(x, y).size


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {r.node: r.root for r in minhash.components(links).collect()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_query_equals_sql(spark):
    got = oracle.spark_result(minhash.op3_minhash_dedup(spark, SF_DIR))
    assert got == oracle.duckdb_result(oracle.connect(SF_DIR), minhash.NEAR_SQL)


def test_known_components_are_not_found_anew(spark, monkeypatch):
    written, materialize = [], minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda df, purpose: written.append(purpose) or materialize(df, purpose))
    roots = minhash.components(spark.createDataFrame([(i, i + 1) for i in range(12)] + [(20, 21)], "a long, b long"))
    written.clear()
    again = minhash._more(roots, spark.createDataFrame([], "a long, b long"))
    assert written == ["components"] * 2 and sorted(again.collect()) == sorted(roots.collect())
    more = minhash._more(roots, spark.createDataFrame([(20, 12), (30, 31)], "a long, b long"))
    assert {r.node: r.root for r in more.collect()} == {**{i: 0 for i in [*range(1, 13), 20, 21]}, 31: 30}


def test_a_round_of_components_plans_its_links_once(spark, monkeypatch):
    """The driver holds and reports the plan of each round, so nothing in it is there twice."""
    scans, materialize = [], minhash.materialize

    def written(df, purpose, by=None):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return materialize(df, purpose, by)

    monkeypatch.setattr(minhash, "materialize", written)
    links = materialize(spark.createDataFrame([(1, 2), (2, 3), (3, 4), (5, 5), (9, 7), (7, 8)], "a long, b long"), "test-links")
    got = sorted(tuple(r) for r in minhash.components(links).collect())
    assert got == [(2, 1), (3, 1), (4, 1), (8, 7), (9, 7)]
    # Both directions of the links, and the least neighbours of either, for the links and for their own least.
    assert max(scans[1:]) <= 8
