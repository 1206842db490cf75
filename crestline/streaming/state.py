"""What a stopped stream still holds, read from its checkpoint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _operators(spark: SparkSession, checkpoint: str) -> list[tuple[int, str]]:
    """Stateful operators of a query, one entry each, from the last to the first that rows pass."""
    stores = spark.read.format("state-metadata").load(checkpoint)
    return [tuple(r) for r in stores.select("operatorId", "operatorName").distinct().orderBy("operatorId").collect()]


def _rows(spark: SparkSession, checkpoint: str, operator: int, name: str) -> DataFrame:
    reader = spark.read.format("statestore").option("operatorId", operator)
    if "Join" not in name:
        return reader.load(checkpoint)
    sides = [reader.option("joinSide", s).load(checkpoint).select("partition_id") for s in ("left", "right")]
    return sides[0].unionByName(sides[1])


def open_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows in the state of each operator: operator_id, operator, rows, and of its fullest partition.

    The query must be stopped.  Operators are counted from the last one, as Spark numbers them; an
    operator without rows is there with zero.
    """
    parts = []
    for operator, name in _operators(spark, checkpoint):
        per_partition = _rows(spark, checkpoint, operator, name).groupBy("partition_id").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_partition.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("fullest"))
            .select(F.lit(operator).alias("operator_id"), F.lit(name).alias("operator"), "rows", "fullest")
        )
    if not parts:
        return spark.createDataFrame([], "operator_id int, operator string, rows long, fullest long")
    return reduce(DataFrame.unionByName, parts)


def open_input_rows(spark: SparkSession, checkpoint: str) -> int:
    """Input rows that the first aggregation of a counted leaderboard has taken and not passed on."""
    operator = max(i for i, _ in _operators(spark, checkpoint))
    held = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return held.agg(F.coalesce(F.sum("value.count"), F.lit(0))).first()[0]
