from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from crestline.operators import latest_window, top_n, top_n_latest


def frame(spark, rows):
    return spark.createDataFrame(rows, "gender string, page string, total long")


def ranked(df, n):
    out = top_n(df, partition_by=["gender"], order_by="total", n=n, tie_break=["page"])
    return [
        (r.gender, r.page_pos, r.page, r.total)
        for r in out.select("gender", "page_pos", "page", "total").orderBy("gender", "page_pos").collect()
    ]


def brute_force(rows, n):
    out = []
    for gender in sorted({g for g, _, _ in rows}):
        mine = sorted((r for r in rows if r[0] == gender), key=lambda r: (-r[2], r[1]))
        out += [(gender, i + 1, p, t) for i, (_, p, t) in enumerate(mine[:n])]
    return out


ROWS = [
    (random.Random(i).choice("FFFM"), f"page{i:03}", random.Random(-i).randrange(5))
    for i in range(300)
]


@pytest.mark.parametrize("n", [1, 10, 299, 1000])
def test_top_n_equals_brute_force_with_ties(spark, n):
    assert ranked(frame(spark, ROWS).repartition(4), n) == brute_force(ROWS, n)


def test_top_n_beyond_the_optimizers_limit(spark):
    """The salted first round gives the same ranks."""
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(key, "5")
    try:
        assert ranked(frame(spark, ROWS).repartition(4), 20) == brute_force(ROWS, 20)
    finally:
        spark.conf.unset(key)


def test_rows_are_pruned_before_the_ranking_shuffle(spark):
    out = top_n(
        frame(spark, ROWS).repartition(4),
        partition_by=["gender"],
        order_by="total",
        n=10,
        tie_break=["page"],
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_latest_window_keeps_all_rows_of_the_last_window(spark):
    df = spark.range(9).select(
        "id",
        F.struct(
            F.timestamp_seconds(F.col("id") % 3).alias("start"),
            F.timestamp_seconds(F.col("id") % 3 + 5).alias("end"),
        ).alias("window"),
    )
    assert sorted(r.id for r in latest_window(df).collect()) == [2, 5, 8]
    assert latest_window(df.where("id < 0")).count() == 0


def test_bad_n(spark):
    with pytest.raises(ValueError, match="at least 1"):
        ranked(frame(spark, ROWS), 0)


@pytest.mark.parametrize("seed", range(4))
def test_latest_leaders_equal_ranking_everything(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("FM"), f"p{rng.randrange(8)}", 10 * w, 10 * w + 60, rng.randrange(6)) for w in range(12) for _ in range(9)]
    totals = (
        spark.createDataFrame(rows, "g string, page string, a int, b int, n int")
        .groupBy("g", "page", F.struct(F.timestamp_seconds("a").alias("start"), F.timestamp_seconds("b").alias("end")).alias("window"))
        .agg(F.sum("n").alias("n"))
    )
    want = latest_window(top_n(totals, partition_by=["g", "window"], order_by="n", n=3, tie_break=["page"]))
    got = top_n_latest(totals, group=["g"], item=["page"], order_by="n", n=3, tie_break=["page"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
