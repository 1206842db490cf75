"""Ranking: the top rows of each group, and the rows of the latest window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# First-round groups per ranking group when the optimizer no longer prunes by itself.
SALTS = 64


def _prunes_early(df: DataFrame, n: int) -> bool:
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    return n <= limit


def top_n(
    df: DataFrame,
    *,
    partition_by: Sequence[str],
    order_by: str,
    n: int,
    tie_break: Sequence[str],
    position: str = "page_pos",
) -> DataFrame:
    """Rows ranked 1..n within ``partition_by``, highest ``order_by`` first.

    Equal values are ordered by ``tie_break``, so the result is the same on every run.
    Every task first keeps its own best n rows of each group, hence a group holding a large
    share of the rows sends n rows per task to the final ranking: the optimizer plans this
    by itself up to its limit, and beyond that a salted first round does the same.
    Batch only: rank streams inside a micro-batch.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    order: list[Column] = [F.desc(order_by), *[F.asc(c) for c in tie_break]]

    def ranked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn(position, place).where(F.col(position) <= F.lit(n))

    if not _prunes_early(df, n):
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*tie_break), F.lit(SALTS)))
        df = ranked(salted, [*partition_by, "_salt"]).drop("_salt", position)
    return ranked(df, partition_by)


def latest_window(df: DataFrame, *, window: str = "window") -> DataFrame:
    """Rows whose window ends last.  Batch only.

    For ranked rows, which are few: all rows given meet in one task, since a rank filter
    needs one pass over them where a maximum joined back would compute the input twice.
    ``top_n_latest`` prunes totals first.
    """
    newest = Window.orderBy(F.desc(f"{window}.end"))
    return (
        df.withColumn("_age", F.dense_rank().over(newest))
        .where(F.col("_age") == 1)
        .drop("_age")
    )


def top_n_latest(
    df: DataFrame,
    *,
    group: Sequence[str],
    item: Sequence[str],
    order_by: str,
    n: int,
    tie_break: Sequence[str],
    window: str = "window",
    position: str = "page_pos",
) -> DataFrame:
    """The top n rows of each group in the window that ends last.

    Each (group, item) first drops all but its own last window, spread over those keys, so what
    is ranked does not grow with the history.  The last window of all is the last one of each
    of its items and therefore whole; what is left of older ones goes at the end.
    """
    newest = Window.partitionBy(*group, *item).orderBy(F.desc(f"{window}.end"))
    last = df.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") == 1).drop("_age")
    ranked = top_n(
        last, partition_by=[*group, window], order_by=order_by, n=n, tie_break=tie_break, position=position
    )
    return latest_window(ranked, window=window)
