"""Totals and distinct counts over hopping or tumbling event-time windows.

Windows start at whole multiples of the slide since the epoch and exclude their end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

DISTINCT_MODES = ("exact", "approx", None)


def _seconds(n: int) -> str:
    return f"{n} seconds"


def check_window(size_seconds: int, slide_seconds: int) -> None:
    if size_seconds <= 0 or slide_seconds <= 0:
        raise ValueError(f"window size and slide must be positive: {size_seconds}, {slide_seconds}")
    if slide_seconds > size_seconds:
        raise ValueError(f"slide {slide_seconds}s exceeds window size {size_seconds}s")


def hopping_agg(
    df: DataFrame,
    *,
    time: str,
    size_seconds: int,
    slide_seconds: int,
    group: Sequence[str],
    measure: str | Column,
    entity: str | None = None,
    distinct: str | None = "exact",
    rsd: float = 0.05,
    total: str = "total_viewtime",
    distinct_total: str = "distinct_userid_count",
) -> DataFrame:
    """Sum of ``measure``, and distinct ``entity`` values, per group and window.

    ``distinct`` is ``exact``, ``approx`` (HyperLogLog with relative error ``rsd``) or
    ``None`` for the sum alone.  Windows carry TIMESTAMP bounds, whatever kind the time is.  A slide equal to the size gives tumbling windows.  On a
    stream, ``time`` needs a watermark and the result is meant for append mode; windows that overlap
    are put together from panes there, so a row counts in all of its windows, or in none if its
    pane is behind the watermark.
    """
    check_window(size_seconds, slide_seconds)
    if distinct not in DISTINCT_MODES:
        raise ValueError(f"distinct must be one of {DISTINCT_MODES}, got {distinct!r}")
    if distinct and entity is None:
        raise ValueError("counting distinct values needs an entity column")
    if not isinstance(df.schema[time].dataType, TimestampType):
        df = df.withColumn(time, F.col(time).cast("timestamp"))  # one type on every path
    measure = F.col(measure) if isinstance(measure, str) else measure
    summed = F.sum(measure).alias(total)
    window = F.window(time, _seconds(size_seconds), _seconds(slide_seconds))

    if not df.isStreaming:
        return _by_panes(
            df, time, size_seconds, slide_seconds, group, measure, entity if distinct else None,
            distinct, rsd, total, distinct_total,
        )
    exact = [entity] if distinct == "exact" else []
    sketch, distinct_of = [], F.approx_count_distinct(entity, rsd) if entity else None
    if size_seconds != slide_seconds:
        # Rows enter state once, in the pane they lie in; only its sums are copied to windows.
        if distinct == "approx":
            sketch = [F.hll_sketch_agg(F.col(entity).cast("string"), F.lit(_cells(rsd))).alias("_sketch")]
            distinct_of = F.hll_sketch_estimate(F.hll_union_agg("_sketch"))
        pane = F.window(time, _seconds(math.gcd(size_seconds, slide_seconds))).alias("_pane")
        df = df.groupBy(*group, *exact, pane).agg(F.sum(measure).alias("_sum"), *sketch)
        measure, summed = F.col("_sum"), F.sum("_sum").alias(total)
        window = F.window(F.window_time("_pane"), _seconds(size_seconds), _seconds(slide_seconds))
    if distinct is None:
        return df.groupBy(*group, window).agg(summed)
    if distinct == "approx":
        return df.groupBy(*group, window).agg(summed, distinct_of.alias(distinct_total))
    return _exact_on_stream(
        df, window, size_seconds, slide_seconds, group, measure, entity, total, distinct_total
    )


def _cells(rsd: float) -> int:
    """Logarithm of a sketch's cells: the standard error of 2**k is below 1.04 / sqrt(2**k)."""
    return min(max(math.ceil(2 * math.log2(1.04 / rsd)), 4), 21)


def _by_panes(
    df, time, size_seconds, slide_seconds, group, measure, entity, distinct, rsd, total, distinct_total
) -> DataFrame:
    """Batch windows put together from panes, the longest pieces all windows consist of.

    Rows are summed per pane before a pane is copied to the windows it is part of, instead
    of copying every row.  For exact distinct counts the summed rows are then brought together
    by entity, so that the copies find each other within a task and only counts travel; for
    approximate ones a pane carries a sketch, and sketches are merged per window.
    """
    slide, size = slide_seconds * 1_000_000, size_seconds * 1_000_000
    pane = math.gcd(slide, size)
    at = F.unix_micros(F.col(time))
    sketched = entity if distinct == "approx" else None
    keys = [*group, entity] if entity and not sketched else list(group)
    sums = [F.sum(measure).alias("_sum")]
    if sketched:
        sums.append(F.hll_sketch_agg(F.col(entity).cast("string"), F.lit(_cells(rsd))).alias("_sketch"))
    per_pane = (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, (at - F.pmod(at, F.lit(pane))).alias("_pane"))
        .agg(*sums)
    )
    if entity and not sketched:
        per_pane = per_pane.repartition(*keys)
    last = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(slide))
    reach = F.col("_pane") + F.lit(pane - size)
    first = reach + F.pmod(-reach, F.lit(slide))
    copies = per_pane.withColumn("_start", F.explode(F.sequence(first, last, F.lit(slide))))
    results = [F.sum("_sum").alias(total)]
    if sketched:
        results.append(F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias(distinct_total))
    elif entity:
        results.append(F.count_distinct(entity).alias(distinct_total))
    window = F.struct(
        F.timestamp_micros("_start").alias("start"),
        F.timestamp_micros(F.col("_start") + F.lit(size)).alias("end"),
    )
    return (
        copies.groupBy(*group, "_start")
        .agg(*results)
        .select(*group, window.alias("window"), *([total, distinct_total] if entity else [total]))
    )


def _exact_on_stream(
    df, window, size_seconds, slide_seconds, group, measure, entity, total, distinct_total
) -> DataFrame:
    """Exact distinct count from two chained aggregations.

    Streams reject ``count(distinct)``, and a set of entities per group would put all
    entities of a popular group into one state row.  Instead the first aggregation keeps
    one row per (group, window, entity), spread over all state partitions, and the second
    counts those rows.  Both close a window at the same watermark, so no delay is added.
    """
    per_entity = df.groupBy(*group, window, entity).agg(F.sum(measure).alias(total))
    # Window ends lie a slide apart, so a tumbling bucket of one slide that is aligned to
    # the ends holds exactly one window.
    ends = F.window(
        F.window_time("window"),
        _seconds(slide_seconds),
        _seconds(slide_seconds),
        _seconds(size_seconds % slide_seconds),
    ).alias("_closing")
    counted = per_entity.groupBy(*group, ends).agg(
        F.sum(total).alias(total), F.count(entity).alias(distinct_total)
    )
    end = F.col("_closing.end")
    start = end - F.make_dt_interval(secs=F.lit(size_seconds))
    return counted.select(
        *group,
        F.struct(start.alias("start"), end.alias("end")).alias("window"),
        total,
        distinct_total,
    )
