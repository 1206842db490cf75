"""Sources by name, and the loader that turns each into an event-time stream.

A reader opens one source, as a stream or as a batch, and gives either message rows
(``value`` and, if known, ``timestamp``) or rows that already have their columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.config import PipelineConfig, SourceConfig
from crestline.functions.messages import decode_json, with_event_time, with_watermark
from crestline.schemas import get_schema

Reader = Callable[[SparkSession, SourceConfig, bool], DataFrame]

MESSAGE_COLUMNS = "value STRING, timestamp TIMESTAMP"


def _begin(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def _required(source: SourceConfig, option: str) -> str:
    try:
        return source.options[option]
    except KeyError:
        raise ValueError(f"source {source.name!r} needs the option {option!r}") from None


def read_kafka(spark: SparkSession, source: SourceConfig, streaming: bool) -> DataFrame:
    """A topic; every option is Spark's own, such as ``startingOffsets``."""
    _required(source, "kafka.bootstrap.servers")
    options = {"subscribe": source.name, **source.options}
    return _begin(spark, streaming).format("kafka").options(**options).load()


def read_files(spark: SparkSession, source: SourceConfig, streaming: bool) -> DataFrame:
    """A folder of files: ``path``, ``file_format`` and Spark's own reader options.

    Text files hold a message per line, stamped with the time the file was written.
    """
    options = dict(source.options)
    path = _required(source, "path")
    kind = options.pop("file_format", "parquet")
    options.pop("path")
    reader = _begin(spark, streaming).format(kind).options(**options)
    if kind == "text":
        written = F.col("_metadata.file_modification_time").alias("timestamp")
        return reader.load(path).select("value", written)
    messages = source.format == "json"
    return reader.schema(MESSAGE_COLUMNS if messages else get_schema(source.schema)).load(path)


def read_table(spark: SparkSession, source: SourceConfig, streaming: bool) -> DataFrame:
    """A catalog table: ``table`` and Spark's own reader options."""
    options = dict(source.options)
    table = _required(source, "table")
    options.pop("table")
    return _begin(spark, streaming).options(**options).table(table)


_READERS: dict[str, Reader] = {"kafka": read_kafka, "files": read_files, "table": read_table}


def register_reader(name: str, reader: Reader) -> None:
    _READERS[name] = reader


def get_reader(name: str) -> Reader:
    try:
        return _READERS[name]
    except KeyError:
        raise ValueError(f"unknown reader {name!r}; known: {sorted(_READERS)}") from None


def open_source(spark: SparkSession, source: SourceConfig, streaming: bool = True) -> DataFrame:
    """One source, decoded, with its event time and, on a stream, its watermark.

    Unreadable messages are left out before the watermark is set, as they have no time.
    """
    rows = get_reader(source.reader)(spark, source, streaming)
    if source.format == "json":
        rows = decode_json(rows, get_schema(source.schema))
    timed = with_event_time(
        rows, source.event_time, time_field=source.time_field, unit=source.time_unit
    )
    return with_watermark(timed, source.event_time, source.delay_seconds) if streaming else timed


def load_inputs(
    spark: SparkSession, config: PipelineConfig, streaming: bool = True
) -> dict[str, DataFrame]:
    """All sources of a pipeline by name."""
    return {s.name: open_source(spark, s, streaming) for s in config.sources}
