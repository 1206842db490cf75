"""Windows over an interval join on streams, without pairs in any state.

``hopping_agg_within`` is the stream's counterpart of ``match_within`` followed by
``hopping_agg``.  Four aggregations are chained, each closing what the watermark has passed:

1. equal rows of either side, by their own time: one state row for each (key, time, values).  Rows
   behind the watermark are dropped here, by their own time, and nowhere later
2. what is in a slot, by (key, slot): a left row is in its slot, a right row in its own and, if
   it still reaches that, the next one, as a slot is no shorter than the bound.  When
   a slot closes it is swept once: every left row gets the number of right rows in reach per
   attribute, and is summed into panes of gcd(size, slide)
3. sums of panes per (group, entity, window)
4. sums and entities per (group, window)

So a row enters two states, one after the other, and is copied to windows only as part of a pane
of its key.  A hot key is spread over its slots; no state row holds more than a key's slot.

What arrives and what leaves the first state are observed metrics, from which late rows are counted
exactly (``streaming.pipeline.RowCounts``).

A window is emitted when the slot that its end lies in is final: at most a slot after the window.

Defined cases: rows with a null key or time match nothing; equal rows count as often as they are
there; late rows are dropped whole (into no window), right rows too; results do not depend on how
rows are dealt to triggers as long as none is late.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.operators.windows import check_window

MICROS = 1_000_000

# Observed metrics of a trigger: rows of both sides that came, and rows that left the first aggregation.
ARRIVED, PASSED = "arrived", "passed"
_SWEPT = "array<struct<attribute:string,item:string,pane:bigint,total:bigint>>"


def slot_seconds(size_seconds: int, slide_seconds: int, bound_seconds: int) -> int:
    """The least number of panes that is no shorter than the bound."""
    pane = math.gcd(size_seconds, slide_seconds)
    return pane * max(1, -(-bound_seconds // pane))


def _sweep(bound: int, pane: int, slot: int) -> Column:
    """A function of (rows of a slot, its end): sums per (attribute, item, pane)."""

    @F.arrow_udf(_SWEPT)
    def swept(rows, ends):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["attribute", "item", "pane", "total"]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        flat = rows.flatten()
        at = flat.field("at").to_numpy(zero_copy_only=False)
        right = flat.field("right").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        # Times as places in the two slots that a row may come from, then one range per unit.
        place = at - np.repeat(ends.to_numpy(zero_copy_only=False), sizes) + 2 * slot + bound + 1
        span = 2 * slot + 2 * bound + 4
        attribute = flat.field("attribute").dictionary_encode()
        item = flat.field("item").dictionary_encode()
        code = pc.fill_null(attribute.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        many = len(attribute.dictionary) + 1
        own = row * many + code + 1
        units = np.unique(own[right])
        # Running count of right rows per unit, in the order of their times.
        unit = np.searchsorted(units, own[right])
        reached, here, since = place[right], place, place - bound
        if len(units) * span >= 2**62:
            grid = np.unique(np.concatenate([reached, here, since]))
            reached, here, since = (np.searchsorted(grid, x) for x in (reached, here, since))
            span = len(grid) + 1
        key = unit * span + reached
        order = np.argsort(key, kind="stable")
        key = key[order]
        n = flat.field("n").to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(n[right][order])])
        # Every left row meets the attributes of its key.
        first = np.searchsorted(units, np.arange(len(sizes)) * many)
        count = np.diff(np.append(first, len(units)))
        left = np.flatnonzero(~right)
        times = count[row[left]]
        of = np.repeat(left, times)
        meets = np.repeat(first[row[left]], times) + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        matches = upto[np.searchsorted(key, meets * span + here[of], "right")]
        matches -= upto[np.searchsorted(key, meets * span + since[of], "left")]
        some = matches > 0
        of, meets, matches = of[some], meets[some], matches[some]
        items = pc.fill_null(item.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)[of]
        panes = at[of] - at[of] % pane
        order = np.lexsort((panes, items, meets))
        of, meets, items, panes, matches = (x[order] for x in (of, meets, items, panes, matches))
        new = np.ones(len(of), bool)
        new[1:] = (meets[1:] != meets[:-1]) | (items[1:] != items[:-1]) | (panes[1:] != panes[:-1])
        starts = np.flatnonzero(new)
        values = flat.field("value")
        null = values.is_null().to_numpy(zero_copy_only=False)[of]
        value = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)[of]
        if len(of) and float(np.abs(value).max()) * float(matches.max()) * len(of) >= 2.0**62:
            value, matches = value.astype(object), matches.astype(object)
        total = np.add.reduceat(value * matches, starts) if len(starts) else np.zeros(0, np.int64)
        nothing = np.logical_and.reduceat(null, starts) if len(starts) else np.zeros(0, bool)
        unit = units[meets[starts]] if len(starts) else np.zeros(0, np.int64)
        fields = [
            attribute.dictionary.take(pa.array(unit % many - 1, mask=unit % many == 0)),
            item.dictionary.take(pa.array(items[starts], mask=items[starts] < 0)),
            pa.array(panes[starts]),
            pa.array([None if z else int(t) for t, z in zip(total, nothing)], pa.int64()),
        ]
        sums = pa.StructArray.from_arrays([f.cast(t) for f, t in zip(fields, types)], names=names)
        ends_at = np.searchsorted(unit // many, np.arange(len(sizes) + 1))
        return pa.ListArray.from_arrays(pa.array(ends_at.astype(np.int32)), sums)

    return swept


def hopping_agg_within(
    left: DataFrame,
    right: DataFrame,
    *,
    on: str,
    left_time: str,
    right_time: str,
    bound_seconds: int,
    attribute: str,
    item: str,
    measure: str,
    size_seconds: int,
    slide_seconds: int,
    distinct: str | None = "exact",
    rsd: float = 0.05,
    total: str = "total_viewtime",
    distinct_total: str = "distinct_userid_count",
) -> DataFrame:
    """Sum of a left ``measure`` over all pairs, and distinct keys, per (attribute, item, window).

    Both sides must be streams with a watermark on their time; the result is meant for append mode.
    """
    check_window(size_seconds, slide_seconds)
    if bound_seconds < 0:
        raise ValueError(f"join bound must not be negative, got {bound_seconds} seconds")
    slot = slot_seconds(size_seconds, slide_seconds, bound_seconds)
    size, slide, width, bound = (s * MICROS for s in (size_seconds, slide_seconds, slot, bound_seconds))
    pane = math.gcd(size, slide)

    def named(df: DataFrame, time: str, is_right: bool, **columns: Column) -> DataFrame:
        rows = df.where(F.col(on).isNotNull() & F.col(time).isNotNull())
        kinds = {"_attribute": "string", "_item": "string", "_value": "long"}
        rest = [columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]
        return rows.select(F.col(on).alias("_key"), F.col(time).alias("_at"), F.lit(is_right).alias("_right"), *rest)

    # The left side first: a union has the watermark column of its first side.
    rows = named(left, left_time, False, _item=F.col(item), _value=F.col(measure)).unionByName(
        named(right, right_time, True, _attribute=F.col(attribute))
    )
    rows = rows.observe(ARRIVED, F.count(F.lit(1)).alias("rows"))
    equal = rows.groupBy("_key", "_right", "_attribute", "_item", "_at").agg(
        F.sum("_value").alias("_value"), F.count(F.lit(1)).alias("_n")
    ).observe(PASSED, F.sum("_n").alias("rows"))

    # Windows of two slots, one slot apart: each row lies in two of them.
    placed = equal.withColumn("_slot", F.window("_at", f"{2 * slot} seconds", f"{slot} seconds"))
    begin = F.unix_micros(F.col("_slot.end")) - F.lit(width)  # of the slot that is swept
    micros = F.unix_micros("_at")
    here = micros >= begin
    reaches = F.col("_right") & (micros + F.lit(bound) >= begin)
    fields = {"at": micros, "right": F.col("_right"), "attribute": F.col("_attribute"), "item": F.col("_item"),
              "value": F.col("_value"), "n": F.col("_n")}
    slots = placed.where(here | reaches).groupBy("_key", "_slot").agg(
        F.collect_list(F.struct(*[c.alias(k) for k, c in fields.items()])).alias("_rows")
    )
    swept = _sweep(bound, pane, width)("_rows", F.unix_micros(F.col("_slot.end")))
    sums = slots.select("_key", F.window_time("_slot").alias("_time"), swept.alias("_sums")).select(
        "_key", "_time", F.inline("_sums").alias("_attribute", "_item", "_pane", "_value")
    )

    # A window closes with the slot that its end lies in: that of the pane, or one of the next.
    later = -(-size // width) + 1
    closing = sums.withColumn("_closing", F.window("_time", f"{later * slot} seconds", f"{slot} seconds"))
    last = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(slide))
    reach = F.col("_pane") + F.lit(pane - size)
    starts = F.sequence(reach + F.pmod(-reach, F.lit(slide)), last, F.lit(slide))
    end = F.unix_micros(F.col("_closing.end"))
    closes = F.filter(starts, lambda s: (s + F.lit(size) > end - F.lit(width)) & (s + F.lit(size) <= end))
    copies = closing.select("_key", "_attribute", "_item", "_value", "_closing", F.explode(closes).alias("_start"))
    window = F.struct(
        F.timestamp_micros("_start").alias("start"), F.timestamp_micros(F.col("_start") + F.lit(size)).alias("end")
    ).alias("window")
    group = [F.col("_attribute").alias(attribute), F.col("_item").alias(item), window]
    summed = F.sum("_value").alias(total)
    if distinct != "exact":
        results = [summed]
        if distinct == "approx":
            results.append(F.approx_count_distinct("_key", rsd).alias(distinct_total))
        whole = copies.groupBy("_attribute", "_item", "_start", "_closing").agg(*results)
        return whole.select(*group, *([total, distinct_total] if distinct else [total]))
    per_key = copies.groupBy("_attribute", "_item", "_start", "_closing", "_key").agg(summed)
    closed = F.window(F.window_time("_closing"), f"{slot} seconds", f"{slot} seconds").alias("_closed")
    whole = per_key.groupBy("_attribute", "_item", "_start", closed).agg(
        F.sum(total).alias(total), F.count(F.lit(1)).alias(distinct_total)
    )
    return whole.select(*group, total, distinct_total)
