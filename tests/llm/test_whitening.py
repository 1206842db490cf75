from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from crestline.llm import whitening
from crestline.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, id string, v string, d string, i string"


def brute(rows, k=8):
    ok = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    width = max(Counter(len(v) for _, v in ok).items(), key=lambda x: (x[1], x[0]))[0]
    ok = [(i, v) for i, v in ok if len(v) == width]
    n, x = len(ok), np.array([v for _, v in ok], object)
    z = x * n - x.sum(0)
    cov = ((z.T @ z) / n**3).astype(float)
    e, u = np.linalg.eigh(cov)
    return ok, n, (z * z).sum(1), (z / n).astype(float), cov, e[::-1][:k], u[:, ::-1][:, :k]


def check(got, rows):
    ok, n, deviation, y, cov, e, u = brute(rows)
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, len(e) + 1))
    for k, (value, axis) in enumerate(zip(e, u.T), 1):
        order = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, ok[i][0] or 0, deviation[i], y[i] @ axis))
        want = (y @ axis / np.sqrt(value))[order]
        mine = sorted(by[k], key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation, 0))
        assert [r.vec_id for r in mine] == [ok[i][0] for i in order]
        assert [r.deviation for r in mine] == [deviation[i] for i in order]
        have = np.array([r.whitened for r in mine])
        assert np.allclose(have, want, atol=1e-8) or np.allclose(have, -want, atol=1e-8)
        assert all(r.n == n and abs(r.explained * np.trace(cov) / value - 1) < 1e-10 for r in mine)
        assert all(0 <= r.identity_error < 1e-9 for r in mine)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, SF_DIR, "embeddings").collect()]
    check(whitening.op13_embedding_whitening(spark, SF_DIR).collect(), rows)


def test_nulls_lengths_repeats_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, [1, 2, 3, 4, 5]).tolist()) for i in range(200)]
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 5)]
    rows += [(305, [1.0] * 4), (None, [0.5] * 5), (7, rows[7][1]), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, "x", "y", "z", "w") for i, v in rows], SCHEMA).repartition(5)
    check(whitening.whiten(table).collect(), rows)


def test_empty_and_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = whitening.whiten(empty)
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    one = spark.createDataFrame([(1, [1.0, 2.0], "", "", "", ""), (2, [1.0, 2.0], "", "", "", "")], SCHEMA)
    got = whitening.whiten(one).collect()
    assert len(got) == 4 and all(r.whitened is None and r.deviation == 0 and r.identity_error == 0 for r in got)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], "", "", "", "") for i in range(9)], SCHEMA)
    got = whitening.whiten(line).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got)
    assert all(abs(r.explained - 1) < 1e-12 for r in got if r.component == 1)


def test_large_entries_have_exact_sums(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 2.0**36, 3).tolist()) for i in range(50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = whitening.whiten(table).collect()
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows], object)
    z = x * 50 - x.sum(0)
    e = np.linalg.eigvalsh(((z.T @ z) / 50**3).astype(float))[::-1]
    assert all(r.deviation is None for r in got)
    for r in got:
        assert abs(r.explained * e.sum() / e[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-9


@pytest.mark.parametrize("kind", ["random", "repeated", "diagonal", "tiny", "graded"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(3)
    d = 30
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    e = {"random": rng.uniform(0, 1, d), "repeated": np.repeat([5.0, 3.0, 1.0], 10), "diagonal": np.arange(d) // 3 * 1.0,
         "tiny": rng.uniform(0, 1e-250, d), "graded": 10.0 ** -np.arange(d)}[kind]
    a = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.principal(a, 12)
    size = np.abs(a).max()
    assert np.abs(values - np.sort(np.linalg.eigvalsh(a))[::-1][:12]).max() < 1e-13 * d * size
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-11
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * size


def test_sturm_counts():
    rng = np.random.default_rng(4)
    diagonal, off = rng.normal(size=12), rng.normal(size=11)
    off[4] = 0
    e = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    for x in np.linspace(-5, 5, 41):
        assert whitening.count_below(diagonal, off, x) == (e < x).sum()
