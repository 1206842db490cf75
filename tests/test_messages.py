from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest
from fixtures import user_lines, view_lines
from pyspark.sql import functions as F

from crestline.functions import (
    decode_json,
    encode_value,
    rejected_json,
    with_event_time,
    with_watermark,
)
from crestline.functions.messages import SOURCE_TIMESTAMP
from crestline.schemas import PAGEVIEWS, USERS, get_schema, register_schema

SENT = datetime(2024, 1, 1, tzinfo=UTC)


def messages(spark, lines):
    """Rows as the Kafka source gives them."""
    return spark.createDataFrame(
        [(None, None if t is None else t.encode(), "topic", 0, i, SENT, 0) for i, t in enumerate(lines)],
        "key binary, value binary, topic string, partition int, offset long, "
        "timestamp timestamp, timestampType int",
    )


def test_payload_is_flattened_and_source_timestamp_kept(spark):
    df = decode_json(messages(spark, view_lines()), PAGEVIEWS)
    assert df.columns == ["viewtime", "userid", "pageid", SOURCE_TIMESTAMP]
    assert df.count() == 18
    assert df.agg(F.sum("viewtime")).first()[0] == sum(json.loads(v)["viewtime"] for v in view_lines())


def test_unreadable_messages_are_routed_not_lost(spark):
    good = view_lines()
    bad = ['{"viewtime": 1, "userid": "u"', "no json", "", None, '{"viewtime": "soon"}', "[1]"]
    df = messages(spark, [*good, *bad])
    assert decode_json(df, PAGEVIEWS).count() == len(good)
    rejected = [r.value for r in rejected_json(df, PAGEVIEWS).collect()]
    assert sorted(rejected, key=str) == sorted(bad, key=str)


def test_missing_fields_are_null_and_unknown_ones_ignored(spark):
    row = decode_json(messages(spark, ['{"userid": "u", "other": 1}']), PAGEVIEWS).first()
    assert (row.userid, row.viewtime, row.pageid) == ("u", None, None)


def test_event_time_from_field_of_the_same_name(spark):
    df = decode_json(messages(spark, user_lines()), USERS)
    timed = with_event_time(df, "registertime", unit="millis")
    assert timed.columns == USERS.names
    assert timed.select(F.unix_millis("registertime")).first()[0] == 500


def test_event_time_from_another_field_keeps_the_measure(spark):
    df = decode_json(messages(spark, view_lines()), PAGEVIEWS)
    timed = with_event_time(df, "at", time_field="viewtime", unit="seconds")
    row = timed.select("viewtime", F.unix_seconds("at").alias("s")).first()
    assert row.viewtime == row.s == 1000


def test_event_time_from_the_source(spark):
    df = decode_json(messages(spark, view_lines()), PAGEVIEWS)
    timed = with_event_time(df, "at")
    assert timed.select(F.unix_seconds("at")).first()[0] == SENT.timestamp()


def test_zoneless_times_become_instants(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS at")
    assert dict(with_event_time(df, "at").dtypes)["at"] == "timestamp"
    with_watermark(with_event_time(df, "at"), "at", 5)


def test_no_event_time(spark):
    with pytest.raises(ValueError, match="no source timestamp"):
        with_event_time(spark.range(1), "at")
    with pytest.raises(ValueError, match="not in"):
        with_event_time(spark.range(1), "at", time_field="gone")
    with pytest.raises(ValueError, match="unit"):
        with_event_time(spark.range(1), "id", unit="days")


def test_json_encoding(spark):
    df = spark.createDataFrame([("F", 3, 7)], "gender string, page_pos int, total long")
    out = encode_value(df, "json")
    assert out.columns == ["value"]
    assert json.loads(out.first().value) == {"gender": "F", "page_pos": 3, "total": 7}
    assert json.loads(encode_value(df, "json", ["gender"]).first().value) == {"gender": "F"}


def test_avro_encoding_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)avro"):
        encode_value(spark.range(1), "avro")


def test_unknown_encoding(spark):
    with pytest.raises(ValueError, match="encoding"):
        encode_value(spark.range(1), "xml")


def test_schema_registry():
    register_schema("only-users", USERS)
    assert get_schema("only-users") is USERS
    with pytest.raises(ValueError, match="unknown schema"):
        get_schema("none")
