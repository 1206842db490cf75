"""User and page-view frames derived from the ``events`` and ``customer`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = (
    "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
)
CUSTOMER = (
    "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
)


def users_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as user registrations; the market segment stands in for the gender."""
    signups = (
        spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
        .where(F.col("event_type") == "signup")
        .select("user_id", F.col("ts").cast("timestamp").alias("registertime"))
    )
    customers = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    return signups.join(customers, F.col("user_id") == F.col("c_custkey")).select(
        F.col("user_id").alias("userid"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").alias("regionid"),
        "registertime",
    )


def pageviews_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as page views; the value in whole cents is the view time."""
    return (
        spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
        .where(F.col("event_type") == "view")
        .select(
            F.round(F.col("value") * 100).cast("long").alias("viewtime"),
            F.col("user_id").alias("userid"),
            F.concat(F.lit("page_"), F.get_json_object("props", "$.k")).alias("pageid"),
            F.col("ts").cast("timestamp").alias("viewed_at"),
        )
    )
