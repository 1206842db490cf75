"""Feed recorded messages to a pipeline as a stream, step by step.

For backfills into a new checkpoint and for comparing a stream with its batch result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crestline.config import PipelineConfig
from crestline.schemas import get_schema
from crestline.streaming.pipeline import run_pipeline

FLUSH_TIME = datetime(2999, 1, 1)


def as_messages(df: DataFrame, schema: str, time: str) -> DataFrame:
    """Rows as JSON messages of a named schema, stamped with their time."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in get_schema(schema)]
    return df.select(
        F.to_json(F.struct(*fields)).alias("value"), F.col(time).alias("timestamp")
    )


def flush_message(spark: SparkSession, source: str) -> DataFrame:
    """A message far in the future whose user exists in no other source.

    It moves the watermark past every open window and joins with nothing.  The move is kept
    in the checkpoint, so this is for replays that are finished, never for a live stream.
    """
    value = F.to_json(F.struct(F.lit(f"flush of {source}").alias("userid")))
    return spark.range(1).select(value.alias("value"), F.lit(FLUSH_TIME).alias("timestamp"))


def feed(
    spark: SparkSession, config: PipelineConfig, steps: Iterable[Mapping[str, DataFrame]]
) -> list[StreamingQuery]:
    """Run the pipeline once per step, resuming each time from its checkpoint.

    A step holds new messages per source.  Sources must be ``files`` sources over distinct
    folders, and the sink must stop when it has read what is there.  A step may hold any
    number of files: its run takes them all in one micro-batch, so which rows are late
    depends on the steps alone.
    """
    if config.sink.trigger_seconds is not None:
        raise ValueError("feeding in steps needs trigger_seconds=None")
    folders = {s.name: s.options["path"] for s in config.sources}
    finished = []
    for step in steps:
        for name, rows in step.items():
            rows.write.mode("append").parquet(folders[name])
        side: list[StreamingQuery] = []
        query = run_pipeline(spark, config, side)
        for each in (query, *side):
            each.awaitTermination()
        finished.append(query)
    return finished


def flush_step(spark: SparkSession, config: PipelineConfig) -> dict[str, DataFrame]:
    return {s.name: flush_message(spark, s.name) for s in config.sources}


def time_slices(
    messages: Mapping[str, DataFrame], borders: Sequence[datetime]
) -> Iterator[dict[str, DataFrame]]:
    """Steps that cut all sources at the same times; the last one takes all that is left."""
    time = F.col("timestamp")
    for start, end in zip([None, *borders], [*borders, None], strict=True):
        after = F.lit(True) if start is None else time >= F.lit(start)
        before = F.lit(True) if end is None else time < F.lit(end)
        yield {name: rows.where(after & before) for name, rows in messages.items()}
