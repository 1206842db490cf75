"""Embedding whitening: leading eigenvectors of an exact covariance, and vectors projected on them.

Every entry c becomes the integer x = floor(scale * c) + shift.  One pass adds up each dimension, a
second one the products of the vectors centred at the integer nearest to the mean; what is left of
the mean, less than one, is taken out afterwards.  Both are sums of integers, added up in the tasks
and then by (row, column) of the matrix, so the covariance is the same however the rows are dealt and
is rounded once.  The matrix of dimension x dimension is then made tridiagonal by Householder
reflections, its leading eigenvalues are bisected by Sturm counts, and inverse iteration gives their
vectors, each orthogonalised against those of close eigenvalues.  Projection needs only the few
vectors.  A third pass holds the covariance of the result against the identity.

Only sums leave the tasks: dimension ** 2 numbers from each, whatever its number of vectors.

Defined cases: a vector that is null, empty, or holds a null, non-finite or over 2 ** 43 large entry
takes no part; of vectors of several lengths those of the most frequent one do (the longest, if
several are), and the others take none; null and repeated ids are rows like any other; columns beside
id and vector are not read, whatever their names.  ``deviation`` is null where no long can hold it.
A component without variance has a null ``whitened`` and is left out of the identity; fewer
dimensions than components give one component for each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import read_table, ship_code

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LARGEST = float(1 << 43)
ROWS = 4_096
CLUSTER = 1e-3  # eigenvalues closer than this part of the matrix's norm share a cluster
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    def fine(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)

    named = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return named.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fine))


def _matrices(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of each length in a batch, ``ROWS`` at a time."""
    lists = batch.column("v")
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes).tolist():
        of = np.flatnonzero(sizes == d)
        for at in range(0, len(of), ROWS):
            part = of[at : at + ROWS]
            x = np.floor(values[starts[part][:, None] + np.arange(d)] * scale)
            yield part, x.astype(np.int64) + shift


def _sums_of(x: np.ndarray) -> np.ndarray:
    """Sums of columns as Python integers, which have no largest."""
    largest = int(np.abs(x).max(initial=0))
    return (x if largest * len(x) < 1 << 62 else x.astype(object)).sum(0).astype(object)


def _products_of(y: np.ndarray) -> np.ndarray:
    """y' y exactly: in doubles where every partial sum is an integer they can hold."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    f = y.astype(object)
    return f.T @ f


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def column_sums(usable: DataFrame, scale: int, shift: int) -> tuple[int, int, list[int]]:
    """Number and length of the vectors that take part, and the sum of each dimension."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        rows: dict[int, int] = {}
        for b in batches:
            for _, x in _matrices(b, scale, shift):
                d = x.shape[1]
                sums[d] = sums.get(d, 0) + _sums_of(x)
                rows[d] = rows.get(d, 0) + len(x)
        for d, s in sums.items():
            cols = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([rows[d]] * d, pa.int64()), _decimals(s)]
            yield pa.RecordBatch.from_arrays(cols, names=["d", "i", "n", "s"])

    parts = usable.select("v").mapInArrow(add, "d int, i int, n long, s decimal(38,0)")
    sums = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    # One row per length in a task of the result, and one per dimension of the one that is kept.
    found = sums.where("i = 0").orderBy(F.desc("n"), F.desc("d")).select("d", "n").first()
    if found is None:
        return 0, 0, []
    rows = sums.where(F.col("d") == found.d).select("i", "s").collect()
    return found.n, found.d, [int(r.s) for r in sorted(rows)]


def covariance(usable: DataFrame, n: int, d: int, sums: list[int], scale: int, shift: int) -> tuple[np.ndarray, float]:
    """Covariance of the vectors of length d, each entry rounded once, and its trace."""
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def add(batches):
        total, own = np.zeros((d, d), object), np.zeros(d, object)
        near = np.array(centre, np.int64)
        rows = 0
        for b in batches:
            for _, x in _matrices(b, scale, shift):
                if x.shape[1] == d:
                    rows += len(x)
                    total += _products_of(x - near)
                    own += _sums_of(x - near)
        if rows:
            for i in range(d):
                at = [pa.array([i] * (d - i + 1), pa.int32()), pa.array([-1, *range(i, d)], pa.int32())]
                yield pa.RecordBatch.from_arrays([*at, _decimals([own[i], *total[i, i:]])], names=["i", "j", "s"])

    parts = usable.select("v").mapInArrow(add, "i int, j int, s decimal(38,0)")
    cells = {(r.i, r.j): int(r.s) for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    left = [cells[i, -1] for i in range(d)]
    # Integers divided once: n * sum(y y') - sum(y) sum(y)' over n squared.
    whole = {(i, j): n * cells[i, j] - left[i] * left[j] for i in range(d) for j in range(i, d)}
    out = np.empty((d, d))
    for (i, j), w in whole.items():
        out[i, j] = out[j, i] = w / (n * n)
    return out, sum(whole[i, i] for i in range(d)) / (n * n)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and q of q' a q, by Householder reflections."""
    a, d = a.copy(), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        size = np.abs(x).max()
        if not size or not np.any(x[1:]):
            continue
        x /= size
        x[0] += np.copysign(np.sqrt(x @ x), x[0])
        v = x / np.sqrt(x @ x)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def count_below(diagonal: np.ndarray, off: np.ndarray, x: float) -> int:
    """How many eigenvalues are less than x: the negative terms of the Sturm sequence."""
    tiny = np.finfo(float).tiny
    squares = [0.0, *(off * off).tolist()]
    below, term = 0, 1.0
    for a, b in zip(diagonal.tolist(), squares):
        term = a - x - (b / term if b else 0.0)
        if abs(term) < tiny:
            term = -tiny
        below += term < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[float]:
    """The k largest eigenvalues, falling, each bisected until no double lies between."""
    d = len(diagonal)
    radius = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    span = max(abs(low), abs(high))
    low, high = low - 1e-12 * span - 1e-300, high + 1e-12 * span + 1e-300
    out = []
    for i in range(k):
        a, b = low, high
        while a < (mid := a + (b - a) / 2) < b and b - a > 1e-17 * span:
            if count_below(diagonal, off, mid) >= d - i:
                b = mid
            else:
                a = mid
        out.append(a + (b - a) / 2)
    return out


def _solve(diagonal: np.ndarray, off: np.ndarray, x: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - x) y = right by elimination with row exchanges; no pivot is under least."""
    d = len(diagonal)
    a, b, c = (diagonal - x).tolist(), [*off.tolist(), 0.0], [0.0] * d  # three upper diagonals
    low, y = off.tolist(), right.tolist()
    for i in range(d - 1):
        if abs(low[i]) > abs(a[i]):
            f = a[i] / low[i]
            a[i], b[i], c[i], a[i + 1], b[i + 1] = low[i], a[i + 1], b[i + 1], b[i] - f * a[i + 1], -f * b[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
        else:
            if abs(a[i]) < least:
                a[i] = least
            f = low[i] / a[i]
            a[i + 1] -= f * b[i]
            y[i + 1] -= f * y[i]
    if abs(a[-1]) < least:
        a[-1] = least
    for i in range(d - 1, -1, -1):
        more = (b[i] * y[i + 1] if i + 1 < d else 0.0) + (c[i] * y[i + 2] if i + 2 < d else 0.0)
        y[i] = (y[i] - more) / a[i]
    y = np.array(y)
    return y / np.abs(y).max()


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors as columns, orthogonalised within clusters of eigenvalues."""
    d = len(diagonal)
    norm = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)))
    least = max(np.finfo(float).eps * norm, 1e-300)
    rng = np.random.default_rng(0)
    out = np.zeros((d, len(values)))
    for k, value in enumerate(values):
        near = [j for j in range(k) if abs(values[j] - value) <= CLUSTER * norm]
        y = rng.uniform(-1, 1, d)
        for _ in range(5):
            y = _solve(diagonal, off, value, y, least)
            for _ in range(2):  # once more, as the first removal may leave mostly rounding
                y -= out[:, near] @ (out[:, near].T @ y)
            y /= np.sqrt(y @ y)
        out[:, k] = y
    return out


def principal(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    size = float(np.abs(matrix).max(initial=0))
    if not size:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, q = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = q @ eigenvectors(diagonal, off, values)
    return np.array(values) * size, vectors / np.sqrt((vectors * vectors).sum(0))


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Sums of (n * y + rest) ** 2 per row, null beyond a long."""
    d = y.shape[1]
    largest = n * int(np.abs(y).max(initial=0)) + n
    if d * largest * largest < 1 << 62:
        z = y * n + np.array(rest, np.int64)
        return pa.array((z * z).sum(1), pa.int64())
    about = ((y.astype(np.float64) * n + np.array(rest, np.float64)) ** 2).sum(1)
    out = [None] * len(y)
    for r in np.flatnonzero(about < 1.001 * 2.0**63).tolist():
        total = sum((n * v + e) ** 2 for v, e in zip(y[r].tolist(), rest))
        out[r] = total if total < 1 << 63 else None
    return pa.array(out, pa.int64())


def whiten(
    vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """One row per vector and component, as in ``RESULT``."""
    spark = vectors.sparkSession
    ship_code(spark)
    usable = _usable(vectors, vec_id, vector)
    n, d, sums = column_sums(usable, scale, shift)
    if not n:
        return spark.createDataFrame([], RESULT)
    matrix, trace = covariance(usable, n, d, sums, scale, shift)
    k = min(components, d)
    values, axes = principal(matrix, k)
    # What rounding leaves of an eigenvalue that is zero.
    some = values > 8 * d * np.finfo(float).eps * max(values[0], 0.0)
    explained = [float(v) / trace if s else 0.0 for v, s in zip(values, some)]
    scaled = np.where(some, axes, 0.0) / np.sqrt(np.where(some, values, 1.0))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [n * c - s for c, s in zip(centre, sums)]
    off = np.array([r / n for r in rest])
    live = np.flatnonzero(some)

    def projected(batch):
        for rows, x in _matrices(batch, scale, shift):
            if x.shape[1] == d:
                y = x - np.array(centre, np.int64)
                yield rows, y, (y + off) @ scaled

    def moments(batches):
        both, one = np.zeros((len(live), len(live))), np.zeros(len(live))
        for b in batches:
            for _, _, w in projected(b):
                both += w[:, live].T @ w[:, live]
                one += w[:, live].sum(0)
        for i in range(len(live)):
            at = [pa.array([i] * (len(live) + 1), pa.int32()), pa.array(range(-1, len(live)), pa.int32())]
            yield pa.RecordBatch.from_arrays([*at, pa.array([one[i], *both[i]])], names=["i", "j", "s"])

    found = usable.select("v").mapInArrow(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    second, mean = np.eye(len(live)), np.zeros(len(live))
    for r in found:
        if r.j < 0:
            mean[r.i] = r.s / n
        else:
            second[r.i, r.j] = r.s / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(live))).max(initial=0.0))

    def project(batches):
        for b in batches:
            ids = b.column("id")
            for rows, y, w in projected(b):
                w = np.where(some, w, np.nan).reshape(-1)
                every = np.repeat(np.arange(len(rows)), k)
                size = len(every)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(size, n, np.int64)), _deviations(y, n, rest).take(pa.array(every)),
                     pa.array(w, mask=np.tile(~some, len(rows))), pa.array(np.tile(explained, len(rows))), pa.array(np.full(size, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return usable.mapInArrow(project, RESULT)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
