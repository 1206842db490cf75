"""Interval joins: rows of two sides with equal keys and nearby event times.

A left row at time ``t`` matches every right row of the same key with time ``r`` where
``r <= t <= r + bound`` (both ends included).

``join_within``   one output row per matching pair, in batch and on streams
``match_within``  batch only: one output row per left row and right attribute value,
                  carrying how many right rows match instead of repeating the left row

In batch both cut time into slots and shuffle on (key, slot), so that a key holding a
large share of the rows is spread over as many reducers as it has active slots.
``join_within`` copies a right row to the slots it reaches and lets adaptive execution split
uneven join partitions.  ``match_within`` copies nothing: a right row is two steps in a running
count, and what is alive at the start of a slot is carried in as one number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000

# Slots per join bound in ``match_within``.  More slots spread a hot key, on both sides, over
# more reducers; each slot in use costs one small row.
SLOTS_PER_BOUND = 64


def _micros(time: str | Column) -> Column:
    time = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(time.cast("timestamp"))


def _slot(micros: Column, width: int) -> Column:
    """Start of the slot holding a time, in microseconds (also right before 1970)."""
    return micros - F.pmod(micros, F.lit(width))


def _slots_between(first: Column, last: Column, width: int) -> Column:
    return F.explode(F.sequence(_slot(first, width), _slot(last, width), F.lit(width)))


def _check_bound(bound_seconds: int) -> None:
    if bound_seconds < 0:
        raise ValueError(f"join bound must not be negative, got {bound_seconds} seconds")


def join_within(
    left: DataFrame,
    right: DataFrame,
    *,
    on: str,
    left_time: str,
    right_time: str,
    bound_seconds: int,
    right_columns: Sequence[str],
    salts: int = 1,
) -> DataFrame:
    """Inner equi + interval join: all left columns plus ``right_columns``, a row per pair.

    On streams both sides must carry a watermark; the two time bounds then let Spark drop
    join state that can no longer match.  ``salts`` > 1 spreads each key over that many
    shuffle or state partitions: left rows pick one by hash, right rows go to all.
    """
    _check_bound(bound_seconds)
    if salts < 1:
        raise ValueError(f"salts must be at least 1, got {salts}")
    bound = F.make_dt_interval(secs=F.lit(bound_seconds))
    keep = [F.col(f"l.{c}") for c in left.columns] + [F.col(f"r.{c}") for c in right_columns]
    matched = (
        (F.col(f"l.{on}") == F.col(f"r.{on}"))
        & (F.col(f"l.{left_time}") >= F.col(f"r.{right_time}"))
        & (F.col(f"l.{left_time}") <= F.col(f"r.{right_time}") + bound)
    )
    needed = list(dict.fromkeys([on, right_time, *right_columns]))
    right = right.select(*needed)

    if salts > 1:
        spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts))
        left = left.withColumn("_salt", spread)
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        matched = matched & (F.col("l._salt") == F.col("r._salt"))

    if not (left.isStreaming or right.isStreaming):
        # A slot as wide as the bound: each right row reaches two slots at most.
        width = max(bound_seconds, 1) * MICROS
        reach = _micros(right_time)
        left = left.withColumn("_slot", _slot(_micros(left_time), width))
        right = right.withColumn(
            "_slot", _slots_between(reach, reach + F.lit(bound_seconds * MICROS), width)
        )
        matched = matched & (F.col("l._slot") == F.col("r._slot"))

    return left.alias("l").join(right.alias("r"), matched, "inner").select(*keep)


def _steps(
    right: DataFrame, *, on: str, time: str, attributes: Sequence[str], bound: int, width: int
) -> DataFrame:
    """Changes in how many right rows reach a moment, each in the slot of its own time.

    A right row at ``r`` adds one at ``r`` and takes it away just after ``r + bound``.  Rows are not
    moved for this: whoever reads the steps makes them anew from the rows.
    """
    begin = _micros(time)
    one = F.lit(1).cast("long")
    changes = F.array(
        F.struct(begin.alias("_at"), one.alias("_step")),
        F.struct((begin + F.lit(bound + 1)).alias("_at"), (-one).alias("_step")),
    )
    return (
        right.where(F.col(on).isNotNull() & F.col(time).isNotNull())
        .select(on, F.struct(*attributes).alias("_attributes"), F.inline(changes))
        .select(on, "_attributes", _slot(F.col("_at"), width).alias("_slot"), "_at", "_step")
    )


def _alive(steps: DataFrame, views: DataFrame, on: str) -> DataFrame:
    """Right rows alive at the start of each slot that a left row can match in.

    Sums of steps per slot are added up over the earlier slots of a (key, attributes): one
    row per slot, however many rows lie in it.  All slots of one (key, attributes) meet in a task, which
    bounds what is there by the time covered, not by the rows.
    """
    nets = steps.groupBy(on, "_attributes", "_slot").agg(
        F.sum("_step").alias("_net"), F.count(F.lit(1)).alias("_steps")
    )
    nothing = F.lit(0).cast("long")
    known = nets.select(on, "_attributes").distinct()
    looked_at = views.select(on, "_slot").distinct().join(known, on)
    slots = looked_at.select(
        on, "_attributes", "_slot", nothing.alias("_net"), nothing.alias("_steps"), F.lit(True).alias("_seen")
    ).unionByName(nets.withColumn("_seen", F.lit(False)))
    # A slot has one row of its steps and one of being looked at; the latter adds nothing, so the order
    # of the two does not matter to what earlier slots add up to.
    unit = Window.partitionBy(on, "_attributes")
    earlier = unit.orderBy("_slot").rangeBetween(Window.unboundedPreceding, -1)
    own = unit.orderBy("_slot").rangeBetween(Window.currentRow, Window.currentRow)
    return (
        slots.withColumn("_alive", F.coalesce(F.sum("_net").over(earlier), nothing))
        .withColumn("_steps", F.sum("_steps").over(own))
        .where(F.col("_seen") & ((F.col("_alive") > 0) | (F.col("_steps") > 0)))
        .select(on, "_attributes", "_slot", "_alive")
    )


def match_within(
    left: DataFrame,
    right: DataFrame,
    *,
    on: str,
    left_time: str,
    right_time: str,
    bound_seconds: int,
    attributes: Sequence[str],
    slots_per_bound: int = SLOTS_PER_BOUND,
) -> DataFrame:
    """Inner interval join that counts matches instead of listing them (batch only).

    Gives the same left rows and ``attributes`` values as ``join_within``, once each, with
    the number of pairs they stand for in ``matches``; sums over pairs then become
    ``sum(x * matches)``.  Both sides are swept in time order within (key, attributes, slot)
    with a running count that starts from what is alive at the start of the slot, so the work
    grows with the rows of the two sides and not with the number of pairs, and a key that is
    hot on either side is spread over its slots.
    """
    _check_bound(bound_seconds)
    if slots_per_bound < 1:
        raise ValueError(f"slots per bound must be at least 1, got {slots_per_bound}")
    if left.isStreaming or right.isStreaming:
        raise ValueError("match_within runs on batch frames; use join_within on streams")
    bound = bound_seconds * MICROS
    width = max(bound // slots_per_bound, MICROS)

    views = left.where(F.col(on).isNotNull() & F.col(left_time).isNotNull()).select(
        on,
        _slot(_micros(left_time), width).alias("_slot"),
        _micros(left_time).alias("_at"),
        F.struct(*left.columns).alias("_row"),
    )
    steps = _steps(right, on=on, time=right_time, attributes=attributes, bound=bound, width=width)
    alive = _alive(steps, views, on)

    unit = [on, "_slot", "_attributes"]
    nothing = F.lit(0).cast("long")
    swept = (
        Window.partitionBy(*unit)
        .orderBy("_at", F.col("_row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = alive.select(*unit, F.col("_slot").alias("_at"), F.col("_alive").alias("_step"))
    return (
        # Views meet the attribute values that can match in their slot.
        views.join(alive.select(*unit), [on, "_slot"])
        .select(*unit, "_at", nothing.alias("_step"), "_row")
        .unionByName(steps.select(*unit, "_at", "_step").unionByName(carried), allowMissingColumns=True)
        .select("_row", "_attributes", F.sum("_step").over(swept).alias("matches"))
        .where(F.col("_row").isNotNull() & (F.col("matches") > 0))
        .select("_row.*", *[F.col(f"_attributes.{c}") for c in attributes], "matches")
    )
