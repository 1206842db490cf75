from __future__ import annotations

import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crestline.operators import hopping_agg

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
HOW = {"time": "at", "group": ["page"], "measure": "value", "entity": "user"}


def frame(spark, rows):
    return spark.createDataFrame(
        [(p, u, v, None if t is None else EPOCH + timedelta(seconds=t)) for p, u, v, t in rows],
        "page string, user string, value long, at timestamp",
    )


def brute_force(rows, size, slide):
    total, users = {}, defaultdict(set)
    for page, user, value, t in rows:
        if t is None:
            continue
        start = t // slide * slide
        while start > t - size:
            key = (page, start)
            if value is not None:
                total[key] = (total.get(key) or 0) + value
            total.setdefault(key, None)
            users[key] |= {user} - {None}
            start -= slide
    return {(p, s, total[(p, s)], len(users[(p, s)])) for p, s in total}


def result(df):
    start = F.unix_seconds("window.start")
    size = F.unix_seconds("window.end") - start
    rows = df.select("page", start.alias("s"), "total_viewtime", "distinct_userid_count", size)
    return {tuple(r[:4]) for r in rows.collect()}


def random_rows(seed):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["hot", "hot", "p", None]),
            rng.choice(["a", "b", "c", None]),
            rng.choice([None, 1, 2, 30]),
            rng.choice([None, *range(-50, 120, 7), *range(0, 120, 10)]),
        )
        for _ in range(150)
    ]


@pytest.mark.parametrize("size,slide", [(60, 10), (20, 20), (25, 10)])
def test_exact_equals_brute_force(spark, size, slide):
    rows = random_rows(size)
    totals = hopping_agg(frame(spark, rows), size_seconds=size, slide_seconds=slide, **HOW)
    assert result(totals) == brute_force(rows, size, slide)


@pytest.mark.parametrize("size,slide", [(60, 10), (25, 10)])
def test_sum_alone_and_approx(spark, size, slide):
    rows = random_rows(7)
    wanted = brute_force(rows, size, slide)
    df = frame(spark, rows)
    window = {"size_seconds": size, "slide_seconds": slide}
    approx = hopping_agg(df, distinct="approx", **window, **HOW)
    # Three users: far below where the sketch starts to err.
    assert result(approx) == wanted
    sums = hopping_agg(df, distinct=None, **window, **HOW)
    assert sums.columns == ["page", "window", "total_viewtime"]
    assert result(sums.withColumn("distinct_userid_count", F.lit(0))) == {
        (p, s, t, 0) for p, s, t, _ in wanted
    }


def test_window_end_is_excluded(spark):
    df = frame(spark, [("p", "a", 1, 9), ("p", "a", 1, 10)])
    tumbling = hopping_agg(df, size_seconds=10, slide_seconds=10, **HOW)
    assert result(tumbling) == {("p", 0, 1, 1), ("p", 10, 1, 1)}


def test_overflow_is_an_error_not_a_wrong_sum(spark):
    df = frame(spark, [("p", "a", 2**62, 1)] * 2)
    with pytest.raises(Exception, match="overflow"):
        hopping_agg(df, size_seconds=10, slide_seconds=10, **HOW).collect()


@pytest.mark.parametrize("size,slide", [(0, 10), (10, 0), (10, 20)])
def test_bad_windows(spark, size, slide):
    with pytest.raises(ValueError):
        hopping_agg(frame(spark, []), size_seconds=size, slide_seconds=slide, **HOW)


def test_bad_distinct(spark):
    df, window = frame(spark, []), {"size_seconds": 10, "slide_seconds": 10}
    with pytest.raises(ValueError, match="distinct"):
        hopping_agg(df, distinct="some", **window, **HOW)
    with pytest.raises(ValueError, match="entity"):
        hopping_agg(df, **window, **{**HOW, "entity": None})


@pytest.mark.parametrize("size,slide", [(60, 10), (50, 20), (60, 60)])
@pytest.mark.parametrize("distinct", [None, "exact", "approx"])
def test_zoneless_times_give_the_same_windows(spark, size, slide, distinct):
    rows = [(t % 3, float(t * 7 % 200), t % 5) for t in range(60)]
    df = spark.createDataFrame(rows, "g int, s double, e int").selectExpr("g", "timestamp_seconds(s) AS t", "e")
    plain = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    how = {"time": "t", "size_seconds": size, "slide_seconds": slide, "group": ["g"], "measure": "e", "entity": "e", "distinct": distinct}
    one, two = hopping_agg(df, **how), hopping_agg(plain, **how)
    assert one.dtypes == two.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
