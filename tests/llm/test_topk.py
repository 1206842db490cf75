from __future__ import annotations

import math

import numpy as np
import oracle
from pyspark.sql import functions as F

from crestline.llm import topk

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, id string, v string, dim string"


def test_query_equals_sql(spark):
    got = oracle.spark_result(topk.op5_topk_search(spark, SF_DIR))
    assert got[1] and got == oracle.duckdb_result(oracle.connect(SF_DIR), topk.TOPK_SQL)


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, x in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        s = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in ok if i != q and len(v) == len(x))[:k]
        out += [(q, n + 1, i, -d) for n, (d, i) in enumerate(s)]
    return sorted(out)


def test_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)]
    rows += [(301, None), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan"), 0.0, 0.0, 0.0]), (304, [float("inf")] * 4), (None, [1.0] * 4)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(400, 500)] + [(7, rows[7][1]), (100, rows[100][1])]
    rows += [(550, [1.0, 2.0]), (551, [1.0, 3.0]), (600, []), (601, [])]
    docs = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in topk.top_k(docs, F.col("id") % 50 == 0).collect())
    assert got == brute(rows)


def test_blocks_and_large_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1e9, 6).astype(np.float32).astype(float).tolist()) for i in range(260)]
    docs = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    rows_small = [(i, rng.normal(0, 1, 6).astype(np.float32).astype(float).tolist()) for i in range(260)]
    small = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows_small], SCHEMA)
    assert sorted(tuple(r) for r in topk.top_k(small, F.col("id") % 50 == 0).collect()) == brute(rows_small)
    assert topk.top_k(docs.limit(0), F.col("id") % 50 == 0).count() == 0


def test_pruning_never_changes_the_result():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, 40, (500, 8)) + rng.integers(0, 4, (500, 1)) * 200)
    pivots = x[:9]
    far = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    table = pa.table({"id": np.arange(500), "v": [r.tobytes() for r in x], "norm": (x * x).sum(1), "far": [r.tobytes() for r in far]})
    q, v, s = topk._best(table.slice(0, 20), table, 5)
    want = []
    for i in range(20):
        want += sorted(((i, int(-(x[i] @ x[j])), j) for j in range(500) if j != i), key=lambda r: r[1:])[:5]
    assert list(zip(q, [-d for d in s], v)) == want
