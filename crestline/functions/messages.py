"""Message payloads: decode, give an event time, encode.  Same for batch and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import to_avro
from pyspark.sql.types import (
    DateType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The source's own timestamp, kept next to the payload under a name no payload uses.
SOURCE_TIMESTAMP = "_source_timestamp"
_CORRUPT = "_corrupt"

_TIMESTAMP_OF = {
    "seconds": F.timestamp_seconds,
    "millis": F.timestamp_millis,
    "micros": F.timestamp_micros,
}


def _parsed(df: DataFrame, schema: StructType) -> DataFrame:
    text = F.col("value").cast("string")
    with_corrupt = StructType([*schema.fields]).add(_CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    stamp = F.col("timestamp") if "timestamp" in df.columns else F.lit(None)
    return df.select(
        # As the output of a generator the payload is parsed once; as a plain expression it
        # would be parsed again for every filter that is moved below it.
        F.explode(F.array(F.from_json(text, with_corrupt, options))).alias("_payload"),
        text.alias("_text"),
        stamp.cast("timestamp").alias(SOURCE_TIMESTAMP),
    )


def _readable() -> Column:
    return F.col("_payload").isNotNull() & F.col(f"_payload.{_CORRUPT}").isNull()


def decode_json(df: DataFrame, schema: StructType) -> DataFrame:
    """Payload fields of JSON messages in ``value``, plus the source timestamp.

    Messages that do not parse are left out here and come out of ``rejected_json``.
    """
    fields = [F.col(f"_payload.{name}") for name in schema.names]
    return _parsed(df, schema).where(_readable()).select(*fields, SOURCE_TIMESTAMP)


def rejected_json(df: DataFrame, schema: StructType) -> DataFrame:
    """Messages ``decode_json`` leaves out: their whole text and source timestamp."""
    rejected = _parsed(df, schema).where(~_readable())
    return rejected.select(F.col("_text").alias("value"), SOURCE_TIMESTAMP)


def staged_json(df: DataFrame, schema: StructType) -> DataFrame:
    """Every message, parsed once: its payload, or its text if ``rejected``, and source timestamp."""
    fields = F.struct(*[F.col(f"_payload.{name}").alias(name) for name in schema.names])
    return _parsed(df, schema).select(
        F.when(_readable(), fields).alias("payload"),
        F.when(~_readable(), F.col("_text")).alias("value"),
        SOURCE_TIMESTAMP,
        (~_readable()).alias("rejected"),
    )


def _as_timestamp(df: DataFrame, name: str, unit: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, TimestampType | TimestampNTZType | DateType | StringType):
        # Watermarks need TIMESTAMP, not TIMESTAMP_NTZ.
        return F.col(name).cast("timestamp")
    return _TIMESTAMP_OF[unit](F.col(name))


def with_event_time(
    df: DataFrame, event_time: str, *, time_field: str | None = None, unit: str = "millis"
) -> DataFrame:
    """Add or replace the column ``event_time``.

    Taken from ``time_field`` when given, else from a payload field of the same name, else
    from the source timestamp.  Numbers count ``unit`` since the epoch.
    """
    if unit not in _TIMESTAMP_OF:
        raise ValueError(f"time unit must be one of {sorted(_TIMESTAMP_OF)}, got {unit!r}")
    if time_field is not None:
        if time_field not in df.columns:
            raise ValueError(f"time field {time_field!r} is not in {df.columns}")
        moment = _as_timestamp(df, time_field, unit)
    elif event_time in df.columns:
        moment = _as_timestamp(df, event_time, unit)
    elif SOURCE_TIMESTAMP in df.columns:
        moment = F.col(SOURCE_TIMESTAMP)
    else:
        raise ValueError(f"no field {event_time!r} and no source timestamp in {df.columns}")
    return df.withColumn(event_time, moment).drop(SOURCE_TIMESTAMP)


def with_watermark(df: DataFrame, event_time: str, delay_seconds: int) -> DataFrame:
    return df.withWatermark(event_time, f"{delay_seconds} seconds")


def encode_value(
    df: DataFrame, encoding: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One column ``value`` holding a row's columns as a JSON text or an Avro record."""
    record = F.struct(*(columns or df.columns))
    if encoding == "json":
        return df.select(F.to_json(record).alias("value"))
    if encoding == "avro":
        # Needs the spark-avro package of the running Spark version on the class path.
        return df.select(to_avro(record).alias("value"))
    raise ValueError(f"encoding must be 'json' or 'avro', got {encoding!r}")
