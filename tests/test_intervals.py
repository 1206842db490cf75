from __future__ import annotations

import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crestline.operators import intervals, join_within, match_within

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
KEYS = {"on": "user", "left_time": "at", "right_time": "since", "bound_seconds": 10}


def moment(seconds: float) -> datetime:
    return EPOCH + timedelta(microseconds=round(seconds * 1_000_000))


def frames(spark, views, users):
    left = spark.createDataFrame(
        [(u, p, None if t is None else moment(t)) for u, p, t in views],
        "user string, page string, at timestamp",
    )
    right = spark.createDataFrame(
        [(u, g, None if t is None else moment(t)) for u, g, t in users],
        "user string, gender string, since timestamp",
    )
    return left, right


def brute_force(views, users, bound=10):
    """Pairs as (user, page, gender), compared in microseconds."""
    found = Counter()
    for u, p, t in views:
        for v, g, r in users:
            if None in (u, v, t, r) or u != v:
                continue
            gap = round(t * 1_000_000) - round(r * 1_000_000)
            if 0 <= gap <= bound * 1_000_000:
                found[(u, p, round(t * 1_000_000), g)] += 1
    return found


def counted(df, weight=None):
    out = Counter()
    columns = ["user", "page", F.unix_micros("at"), "gender"]
    for row in df.select(*columns, *([weight] if weight else [])).collect():
        out[tuple(row[:4])] += row[4] if weight else 1
    return out


def random_case(seed):
    rng = random.Random(seed)
    times = [round(rng.uniform(-60, 60), 3) for _ in range(40)]

    def some(kind, n):
        return [
            (
                rng.choice(["hot", "hot", "hot", "a", "b", None]),
                rng.choice(kind),
                rng.choice([None, *times, *times]),
            )
            for _ in range(n)
        ]

    return some(["p", "q"], 120), some(["F", "M", None], 80)


@pytest.mark.parametrize("salts", [1, 3])
def test_pairs_equal_brute_force(spark, salts):
    views, users = random_case(1)
    left, right = frames(spark, views, users)
    pairs = join_within(left, right, right_columns=["gender"], salts=salts, **KEYS)
    assert pairs.columns == ["user", "page", "at", "gender"]
    assert counted(pairs) == brute_force(views, users)


@pytest.mark.parametrize("seed,slots", [(2, 1), (3, 4), (4, 64)])
def test_counts_equal_brute_force(spark, seed, slots):
    views, users = random_case(seed)
    left, right = frames(spark, views, users)
    matched = match_within(left, right, attributes=["gender"], slots_per_bound=slots, **KEYS)
    assert counted(matched, "matches") == brute_force(views, users)


def test_hot_key_is_spread_over_its_slots_on_both_sides(spark):
    """A burst of one user within one bound: no slot holds more than its stretch of time."""
    views = [("hot", "p", t) for t in range(64)]
    users = [("hot", "F", t + 0.5) for t in range(64)]
    left, right = frames(spark, views, users)
    matched = match_within(left, right, attributes=["gender"], **KEYS)
    assert counted(matched, "matches") == brute_force(views, users)
    width = KEYS["bound_seconds"] * intervals.MICROS // intervals.SLOTS_PER_BOUND
    steps = intervals._steps(
        right, on="user", time=KEYS["right_time"], attributes=["gender"],
        bound=KEYS["bound_seconds"] * intervals.MICROS, width=max(width, intervals.MICROS),
    )
    assert steps.groupBy("user", "_slot").count().agg(F.max("count")).first()[0] <= 2


def test_both_bounds_are_included(spark):
    views = [("u", "early", 4.999999), ("u", "first", 5), ("u", "last", 15), ("u", "late", 15.000001)]
    left, right = frames(spark, views, [("u", "F", 5)])
    for joined in (
        join_within(left, right, right_columns=["gender"], **KEYS),
        match_within(left, right, attributes=["gender"], **KEYS),
    ):
        assert {r.page for r in joined.collect()} == {"first", "last"}


def test_every_registration_in_reach_counts(spark):
    left, right = frames(spark, [("u", "p", 9)], [("u", "F", 1), ("u", "F", 5), ("u", "M", 5)])
    pairs = join_within(left, right, right_columns=["gender"], **KEYS)
    assert sorted(r.gender for r in pairs.collect()) == ["F", "F", "M"]
    matched = match_within(left, right, attributes=["gender"], **KEYS)
    assert {(r.gender, r.matches) for r in matched.collect()} == {("F", 2), ("M", 1)}


def test_copies_stay_copies(spark):
    left, right = frames(spark, [("u", "p", 3)] * 4, [("u", "F", 1)] * 5)
    assert join_within(left, right, right_columns=["gender"], **KEYS).count() == 20
    matched = match_within(left, right, attributes=["gender"], **KEYS)
    assert [r.matches for r in matched.collect()] == [5] * 4


def test_zero_bound_matches_equal_times_only(spark):
    left, right = frames(spark, [("u", "p", 1), ("u", "q", 2)], [("u", "F", 1)])
    keys = {**KEYS, "bound_seconds": 0}
    assert join_within(left, right, right_columns=["gender"], **keys).count() == 1
    assert match_within(left, right, attributes=["gender"], **keys).count() == 1


def test_hot_key_is_shuffled_by_slot_and_nothing_is_crossed(spark):
    left, right = frames(spark, *random_case(6))
    pairs = join_within(left, right, right_columns=["gender"], **KEYS)
    plan = pairs._jdf.queryExecution().toString()
    assert "_slot" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    plan = match_within(left, right, attributes=["gender"], **KEYS)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "hashpartitioning(user" in plan and "_slot" in plan


def test_bad_arguments(spark):
    left, right = frames(spark, [("u", "p", 1)], [("u", "F", 1)])
    with pytest.raises(ValueError, match="bound"):
        join_within(left, right, right_columns=[], **{**KEYS, "bound_seconds": -1})
    with pytest.raises(ValueError, match="salts"):
        join_within(left, right, right_columns=[], salts=0, **KEYS)


@pytest.mark.parametrize("slots", [0, -1])
def test_slots_are_checked(spark, slots):
    left, right = frames(spark, [("u", "p", 1)], [("u", "F", 1)])
    with pytest.raises(ValueError, match="slots"):
        match_within(left, right, attributes=["gender"], slots_per_bound=slots, **KEYS)
