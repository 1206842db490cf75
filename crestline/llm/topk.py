"""Exact top-k search by inner product with a pivot table.

Vectors are quantised to integers.  ``q.v = (|q|^2 + |v|^2 - d(q, v)^2) / 2`` and, for every
pivot p, ``d(q, v) >= |d(q, p) - d(v, p)|``: stored distances to many pivots give each
candidate an upper bound of its score without touching its vector.  Candidates are scored in
the order of their bounds until the next bound is below the k-th best score so far, which
is exact, ties included.

Queries and vectors meet block by block: each pair of a query block and a vector block is one
task with bounded content, and gives k rows per query; blocks are cut by a hash of the row, so
equal vectors spread.  Nothing is broadcast but the pivots, whose number is a parameter.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part;
vectors meet only vectors of the same length; a row is not a candidate of a query with its own
id; a query row given twice is asked once; fewer candidates than k give fewer rows; null ids
take no part; an empty table gives an empty result.

Only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.llm.common import materialize, read_table, ship_code, shuffle_partitions

K = 5
SCALE = 256
PIVOTS = 32
QUERY_BLOCK = 2_048
VECTOR_BLOCK = 4_096
CHUNK = 256
EXACT = float(1 << 53)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Quantised vectors of equal length, stored as little-endian doubles."""
    rows = column.to_pylist()
    width = len(rows[0]) // 8 if rows else 0
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), width)


def _quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """id, quantised vector as bytes, its squared length."""
    part = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    whole = vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & part)

    def quantise(batches):
        for b in batches:
            lists = b.column(1)
            size = np.diff(lists.offsets.to_numpy())
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            at = np.concatenate([[0], np.cumsum(size)])
            rows = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.astype("<f8").tobytes() for r in rows], pa.binary()),
                 pa.array(size.astype(np.int32)), pa.array([float(r @ r) for r in rows], pa.float64())],
                names=["id", "v", "dim", "norm"],
            )

    named = whole.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    return named.mapInArrow(quantise, "id long, v binary, dim int, norm double")


def pivot_table(quantised: DataFrame, pivots: int) -> DataFrame:
    """Distances of every vector to the pivots of its length.

    Pivots are the vectors with the least hashes: ``pivots`` rows, whatever the data.
    """
    chosen = (
        quantised.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v", "dim").collect()
    )
    by_dim: dict[int, np.ndarray] = {}
    for d in {r.dim for r in chosen}:
        by_dim[d] = np.stack([np.frombuffer(r.v, "<f8") for r in chosen if r.dim == d])

    def measure(batches):
        for b in batches:
            out = []
            for raw, dim in zip(b.column("v").to_pylist(), b.column("dim").to_pylist()):
                p = by_dim.get(dim)
                x = np.frombuffer(raw, "<f8")
                out.append(np.sqrt(((p - x) ** 2).sum(1)).astype("<f8").tobytes() if p is not None else b"")
            yield b.append_column("far", pa.array(out, pa.binary()))

    return quantised.mapInArrow(measure, "id long, v binary, dim int, norm double, far binary")


def _best(q: pa.Table, v: pa.Table, k: int) -> tuple[list, list, list]:
    """The k best vectors of a block for each query: query ids, vector ids, scores."""
    qx, vx = _matrix(q["v"]), _matrix(v["v"])
    qp, vp = _matrix(q["far"]), _matrix(v["far"])
    qn, vn = q["norm"].to_numpy(), v["norm"].to_numpy()
    qid, vid = q["id"].to_numpy(), v["id"].to_numpy()
    if qx.size and vx.size and np.abs(qx).max() * np.abs(vx).max() * qx.shape[1] >= EXACT:
        qx, vx = [np.array([[int(c) for c in r] for r in m], object) for m in (qx, vx)]
    queries, found, scores = [], [], []
    for i in range(len(qid)):
        gap = np.zeros(len(vid))
        for p in range(qp.shape[1]):
            np.maximum(gap, np.abs(vp[:, p] - qp[i, p]), out=gap)
        # Rounding errors must not turn a bound into less than the score.
        bound = (qn[i] + vn - gap * gap) / 2
        bound += 1 + 1e-9 * (qn[i] + vn)
        order = np.argsort(-bound)
        order = order[vid[order] != qid[i]]
        top_s, top_v = np.zeros(0, qx.dtype), np.zeros(0, np.int64)
        for at in range(0, len(order), CHUNK):
            if len(top_s) == k and bound[order[at]] < top_s[-1]:
                break
            part = order[at : at + CHUNK]
            if len(top_s) == k:
                part = part[bound[part] >= top_s[-1]]
            s, n = np.concatenate([top_s, vx[part] @ qx[i]]), np.concatenate([top_v, vid[part]])
            keep = np.lexsort((n, -s))[:k]
            top_s, top_v = s[keep], n[keep]
        queries += [qid[i]] * len(top_v)
        found += top_v.tolist()
        scores += [int(s) for s in top_s]
    return queries, found, scores


def top_k(
    vectors: DataFrame, is_query: Column, *, k: int = K, vec_id: str = "vec_id",
    vector: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query; ``is_query`` speaks of ``id``."""
    spark = vectors.sparkSession
    ship_code(spark)
    quantised = materialize(_quantised(vectors, vec_id, vector, scale), "topk-vectors")
    table = materialize(pivot_table(quantised, pivots), "topk-pivots")
    n, asked = table.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    query_blocks = max(1, -(-asked // QUERY_BLOCK))
    vector_blocks = max(1, -(-n // VECTOR_BLOCK), min(shuffle_partitions(spark), -(-n // 256)))

    def block(count: int, *of: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(count), *of), F.lit(count))

    def copies(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    asked_rows = table.where(is_query).dropDuplicates(["id", "v"])
    left = asked_rows.select("*", block(query_blocks, "id").alias("qb")).select("*", copies(vector_blocks).alias("vb"))
    # Rows of one id and vector may be many: the position in the input parts them.
    spread = table.select("*", F.monotonically_increasing_id().alias("row"))
    right = spread.select("*", block(vector_blocks, "id", "row").alias("vb")).drop("row").select("*", copies(query_blocks).alias("qb"))

    def meet(q: pa.Table, v: pa.Table) -> pa.Table:
        a, b, c = _best(q, v, k) if len(q) and len(v) else ([], [], [])
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.int64())})

    keys = ["dim", "qb", "vb"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.select("query_id", place.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


TOPK_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(v.e) = len(q.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= {K}"""
