"""Named message schemas.  Streams are read with a schema from here, never an inferred one."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

# Field names and types of the two message kinds.
PAGEVIEWS = StructType(
    [
        StructField("viewtime", LongType()),
        StructField("userid", StringType()),
        StructField("pageid", StringType()),
    ]
)
USERS = StructType(
    [
        StructField("userid", StringType()),
        StructField("gender", StringType()),
        StructField("regionid", StringType()),
        StructField("registertime", LongType()),
    ]
)

_SCHEMAS: dict[str, StructType] = {"pageviews": PAGEVIEWS, "users": USERS}


def register_schema(name: str, schema: StructType) -> None:
    _SCHEMAS[name] = schema


def get_schema(name: str) -> StructType:
    try:
        return _SCHEMAS[name]
    except KeyError:
        raise ValueError(f"unknown schema {name!r}; known: {sorted(_SCHEMAS)}") from None
