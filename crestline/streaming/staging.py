"""Messages read and parsed once, for both those that can be read and those that cannot.

A staging query parses each message and writes it to one table, parted by whether it was rejected.
Spark's file sink commits a micro-batch of that table as a whole, so both outputs are of the same
messages, each exactly once, whatever restarts.  The pipeline then reads the decoded part as its
source, and whoever looks after bad messages reads the other.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StringType, StructType, TimestampType

from crestline.config import PipelineConfig, SourceConfig
from crestline.functions.messages import SOURCE_TIMESTAMP, staged_json
from crestline.schemas import get_schema
from crestline.sources.readers import get_reader, register_reader


def _schema(source: SourceConfig) -> StructType:
    return (
        StructType().add("payload", get_schema(source.schema)).add("value", StringType())
        .add(SOURCE_TIMESTAMP, TimestampType()).add("rejected", BooleanType())
    )


def read_staged(spark: SparkSession, source: SourceConfig, streaming: bool) -> DataFrame:
    """The decoded messages of a staged source, with their source timestamp."""
    begin = spark.readStream if streaming else spark.read
    rows = begin.schema(_schema(source)).parquet(source.options["path"])
    return rows.where(~F.col("rejected")).select("payload.*", SOURCE_TIMESTAMP)


register_reader("staged", read_staged)


def staged(source: SourceConfig, folder: str) -> SourceConfig:
    """The same source read from where it is staged; a source that is not JSON stays as it is."""
    if source.format != "json":
        return source
    return replace(source, reader="staged", format="columns", options={"path": folder}, rejects=None)


def rejected_of(spark: SparkSession, source: SourceConfig) -> DataFrame:
    """The messages of a staged source that could not be read: value and source timestamp."""
    rows = spark.read.schema(_schema(source)).parquet(source.options["path"])
    return rows.where("rejected").select("value", SOURCE_TIMESTAMP)


def stage(spark: SparkSession, source: SourceConfig, folder: str, trigger_seconds: int | None = None) -> StreamingQuery:
    """Start the query that stages a source; it observes how many messages it ``decoded`` and ``rejected``."""
    rows = staged_json(get_reader(source.reader)(spark, source, True), get_schema(source.schema)).observe(
        "staged", F.count(F.when(~F.col("rejected"), 1)).alias("decoded"), F.count(F.when(F.col("rejected"), 1)).alias("rejected")
    )
    writer = (
        rows.writeStream.outputMode("append").format("parquet").partitionBy("rejected").option("path", folder)
        .option("checkpointLocation", f"{folder.rstrip('/')}-checkpoint")
    )
    when = {"availableNow": True} if trigger_seconds is None else {"processingTime": f"{trigger_seconds} seconds"}
    return writer.trigger(**when).start()


def stage_inputs(spark: SparkSession, config: PipelineConfig, root: str) -> tuple[PipelineConfig, list[StreamingQuery]]:
    """The pipeline over staged sources, and the queries started to stage them.

    With ``trigger_seconds=None`` those have ended when this returns.
    """
    started, sources = [], []
    for source in config.sources:
        folder = f"{root.rstrip('/')}/{source.name}"
        if source.format == "json":
            started.append(stage(spark, source, folder, config.sink.trigger_seconds))
        sources.append(staged(source, folder))
    for query in started:
        if config.sink.trigger_seconds is None:
            query.awaitTermination()
        else:
            query.processAllAvailable()  # the folders are there
    return replace(config, sources=tuple(sources)), started
