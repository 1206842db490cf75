"""The counted stream leaderboard against lists of pairs."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crestline.operators import hopping_agg, hopping_agg_within
from crestline.operators.counted import _sweep, slot_seconds
from crestline.streaming import RowCounts, open_state

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
VIEW, USER = "userid string, pageid string, viewtime long, at timestamp", "userid string, gender string, at timestamp"


def at(second):
    return None if second is None else EPOCH + timedelta(seconds=second)


def brute(views, users, bound, size, slide):
    sums, keys = defaultdict(list), defaultdict(set)
    for u, page, value, t in views:
        for v, gender, r in users:
            if None not in (u, t, r) and u == v and r <= t <= r + bound:
                first = (t - size) // slide * slide + slide
                for start in range(int(first), int(t) + 1, slide):
                    if start <= t < start + size:
                        sums[gender, page, start].append(value)
                        keys[gender, page, start].add(u)
    return {(*k, sum(v for v in s if v is not None) if any(v is not None for v in s) else None, len(keys[k])) for k, s in sums.items()}


def made(seed, n=120, until=200):
    r = random.Random(seed)
    views = [(r.choice("abc"), r.choice(["p", "q", None]), r.choice([1, 5, None, 10**6]), 1000 + r.randrange(until)) for _ in range(n)]
    users = [(r.choice("abcd"), r.choice(["F", "M", None]), 1000 + r.randrange(until)) for _ in range(n // 2)]
    return views + [(None, "p", 1, 1005), ("a", "p", 1, None)], users + [(None, "F", 1000), ("a", "F", None)]


def stream(spark, root, name, schema, delay="10 seconds"):
    return spark.readStream.schema(schema).parquet(f"{root}/{name}").withWatermark("at", delay)


def write(spark, root, name, rows, schema):
    stamped = [(*r[:-1], at(r[-1])) for r in rows]
    spark.createDataFrame(stamped, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def run(df, root):
    query = (
        df.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def result(spark, root):
    rows = spark.read.parquet(f"{root}/out").select("gender", "pageid", F.unix_seconds("window.start"), "total_viewtime", "distinct_userid_count")
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("size,slide,bound", [(60, 10, 20), (15, 10, 0), (10, 10, 37)])
def test_stream_in_steps_equals_pairs(spark, tmp_path, size, slide, bound):
    views, users = made(size)
    for part in range(2):
        write(spark, tmp_path, "v", [v for v in views if (v[3] is not None and v[3] >= 1100) == part], VIEW)
        write(spark, tmp_path, "u", [u for u in users if (u[2] is not None and u[2] >= 1100) == part], USER)
        if part:
            write(spark, tmp_path, "v", [("flush v", None, None, 10**8)], VIEW)
            write(spark, tmp_path, "u", [("flush u", None, 10**8)], USER)
        run(
            hopping_agg_within(
                stream(spark, tmp_path, "v", VIEW), stream(spark, tmp_path, "u", USER), on="userid", left_time="at",
                right_time="at", bound_seconds=bound, attribute="gender", item="pageid", measure="viewtime",
                size_seconds=size, slide_seconds=slide,
            ),
            tmp_path,
        )
    assert result(spark, tmp_path) == brute(views, users, bound, size, slide)
    rows = {r.operator_id: r.rows for r in open_state(spark, f"{tmp_path}/c").collect()}
    assert rows == {0: 0, 1: 0, 2: 0, 3: 2}


def test_late_rows_are_counted_one_by_one(spark, tmp_path):
    """Repeated, early, late and just-in-time rows of both sides over five runs."""
    counts = RowCounts()
    spark.streams.addListener(counts)
    steps = [
        ([("a", "p", 1, 1000), ("a", "p", 1, 1100)], [("a", "F", 1000), ("a", "F", 1100)]),
        # The watermark is 1090.
        ([("a", "p", 2, 1090), ("a", "p", 2, 1050), ("a", "p", 2, 1050), ("b", "q", 2, 1091)], [("b", "F", 1000), ("b", "M", 1091)]),
        ([("a", "p", 7, 1002)] * 5, []), ([], [("a", "M", 1003)] * 2),
        ([("flush v", None, None, 10**8)], [("flush u", None, 10**8)]),
    ]
    queries = []
    try:
        for views, users in steps:
            write(spark, tmp_path, "v", views, VIEW)
            write(spark, tmp_path, "u", users, USER)
            frame = hopping_agg_within(
                stream(spark, tmp_path, "v", VIEW), stream(spark, tmp_path, "u", USER), on="userid", left_time="at",
                right_time="at", bound_seconds=20, attribute="gender", item="pageid", measure="viewtime",
                size_seconds=10, slide_seconds=10,
            )
            queries.append(run(frame, tmp_path))
        assert counts.late_rows(spark, queries, f"{tmp_path}/c") == 3 + 1 + 5 + 2
    finally:
        spark.streams.removeListener(counts)
    assert result(spark, tmp_path) == {("F", "p", 1000, 1, 1), ("F", "p", 1100, 1, 1), ("M", "q", 1090, 2, 1)}


@pytest.mark.parametrize("distinct", ["exact", "approx", None])
def test_overlapping_windows_of_a_stream_from_panes(spark, tmp_path, distinct):
    views, _ = made(3, until=90)
    write(spark, tmp_path, "v", [*views, ("flush", None, None, 10**8)], VIEW)
    how = {"time": "at", "size_seconds": 25, "slide_seconds": 10, "group": ["pageid"], "measure": "viewtime", "entity": "userid", "distinct": distinct}
    columns = ["pageid", "window", "total_viewtime", *(["distinct_userid_count"] if distinct else [])]
    run(hopping_agg(stream(spark, tmp_path, "v", VIEW), **how), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out").select(*columns)
    whole = spark.read.parquet(f"{tmp_path}/v").where("at < '1972-01-01'")
    batch = hopping_agg(whole, **how).select(*columns)
    assert got.count() > 20 and got.exceptAll(batch).count() == batch.exceptAll(got).count() == 0


def test_a_slot_holds_whole_panes_and_is_no_shorter_than_the_bound():
    assert slot_seconds(60, 10, 20) == 20 and slot_seconds(60, 10, 0) == 10
    assert slot_seconds(15, 10, 7) == 10 and slot_seconds(10, 10, 11) == 20


def test_sums_beyond_a_long_are_refused(spark):
    rows = spark.sql(
        "SELECT array(named_struct('at', 5L, 'right', true, 'attribute', 'F', 'item', cast(null as string), 'value', cast(null as long), 'n', 4L),"
        " named_struct('at', 6L, 'right', false, 'attribute', cast(null as string), 'item', 'p', 'value', 4611686018427387904L, 'n', 1L)) AS r, 10L AS e"
    )
    with pytest.raises(Exception, match="too large|OverflowError|out of bounds|convert"):
        rows.select(_sweep(5, 10, 10)("r", "e")).collect()
