"""Sinks by name.  Each starts a query that writes a stream in append mode.

All but ``memory`` pass every micro-batch through the transform's batch phase first.  Append
mode emits a window once, when it is final, and whole, so ranking a micro-batch is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from crestline.config import SinkConfig
from crestline.functions.messages import encode_value
from crestline.plans.transforms import BatchFn

Sink = Callable[[DataFrame, SinkConfig, BatchFn | None], StreamingQuery]
BatchWriter = Callable[[DataFrame, SinkConfig, int], None]


def _required(sink: SinkConfig, option: str) -> str:
    try:
        return sink.options[option]
    except KeyError:
        raise ValueError(f"sink {sink.writer!r} needs the option {option!r}") from None


def _writer(df: DataFrame, sink: SinkConfig) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", sink.checkpoint)
    if sink.query_name:
        writer = writer.queryName(sink.query_name)
    if sink.trigger_seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{sink.trigger_seconds} seconds")


def _per_batch(write: BatchWriter, *needs: str) -> Sink:
    def start(df: DataFrame, sink: SinkConfig, on_batch: BatchFn | None) -> StreamingQuery:
        for option in needs:
            _required(sink, option)

        def each(batch: DataFrame, batch_id: int) -> None:
            result = on_batch(batch, batch_id) if on_batch else batch
            write(result, sink, batch_id)

        return _writer(df, sink).foreachBatch(each).start()

    return start


def _encoded(batch: DataFrame, sink: SinkConfig) -> DataFrame:
    return encode_value(batch, sink.encoding) if sink.encoding else batch


def write_kafka(batch: DataFrame, sink: SinkConfig, batch_id: int) -> None:
    """A message per row, JSON unless Avro is asked for.  A batch run again sends again."""
    messages = encode_value(batch, sink.encoding or "json")
    messages.write.format("kafka").options(**sink.options).save()


COMMIT = "batch_id long, run string, state string"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of each batch that was written under a path, one row each."""
    try:
        return spark.read.schema(COMMIT).option("recursiveFileLookup", "true").json(f"{path.rstrip('/')}-commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _commit(spark: SparkSession, path: str, sink: SinkConfig, batch_id: int, state: str) -> None:
    row = spark.createDataFrame([(batch_id, sink.checkpoint, state)], COMMIT).coalesce(1)
    row.write.mode("overwrite").json(f"{path.rstrip('/')}-commits/{batch_id}")


# Last batch that this process has committed, by folder and run.
_last: dict[tuple[str, str], int] = {}


def write_files(batch: DataFrame, sink: SinkConfig, batch_id: int) -> None:
    """A folder per batch under ``path``, which counts once its manifest says so.

    Manifests lie in ``path`` + ``-commits`` and name the run, told by its checkpoint.  A batch
    run again takes its manifest back, replaces its folder and commits anew, so a crash at any
    point leaves it invisible to ``read_committed``, neither half nor twice.  A folder
    that holds batches of another run, or later ones, is refused.
    """
    spark = batch.sparkSession
    options = dict(sink.options)
    path = options.pop("path")
    run = (path, sink.checkpoint)
    if _last.get(run) != batch_id - 1:
        found = _commits(spark, path)
        other = (F.col("run") != sink.checkpoint) | (F.col("batch_id") > batch_id)
        if found.where(other).limit(1).count():
            raise ValueError(f"{path!r} holds batches of another run; give a new folder or its checkpoint")
        if found.where(F.col("batch_id") == batch_id).limit(1).count():
            _commit(spark, path, sink, batch_id, "writing")
    kind = options.pop("file_format", "parquet")
    target = f"{path.rstrip('/')}/batch_id={batch_id}"
    _encoded(batch, sink).write.mode("overwrite").format(kind).options(**options).save(target)
    _commit(spark, path, sink, batch_id, "committed")
    _last[run] = batch_id


def read_committed(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Rows of all committed batches of a files sink, with their ``batch_id``."""
    done = _commits(spark, path).where(F.col("state") == "committed").select("batch_id")
    rows = spark.read.format(kind).load(path)
    return rows.withColumn("batch_id", F.col("batch_id").cast("long")).join(done, "batch_id", "left_semi")


def write_console(batch: DataFrame, sink: SinkConfig, batch_id: int) -> None:
    """Shows the first ``numRows`` rows of a batch, 10 unless given."""
    _encoded(batch, sink).show(int(sink.options.get("numRows", 10)), truncate=False)


def write_noop(batch: DataFrame, sink: SinkConfig, batch_id: int) -> None:
    """Computes the batch and keeps nothing."""
    _encoded(batch, sink).write.format("noop").mode("overwrite").save()


def start_memory(df: DataFrame, sink: SinkConfig, on_batch: BatchFn | None) -> StreamingQuery:
    """A named in-memory table on the driver, for tests; rows go there as they are."""
    if on_batch is not None:
        raise ValueError("the memory sink cannot run a batch phase; use files, noop or console")
    if not sink.query_name:
        raise ValueError("the memory sink needs a query name")
    return _writer(_encoded(df, sink), sink).format("memory").start()


_SINKS: dict[str, Sink] = {
    "kafka": _per_batch(write_kafka, "kafka.bootstrap.servers", "topic"),
    "files": _per_batch(write_files, "path"),
    "parquet": _per_batch(write_files, "path"),
    "console": _per_batch(write_console),
    "noop": _per_batch(write_noop),
    "memory": start_memory,
}


def register_sink(name: str, sink: Sink) -> None:
    _SINKS[name] = sink


def get_sink(name: str) -> Sink:
    try:
        return _SINKS[name]
    except KeyError:
        raise ValueError(f"unknown sink {name!r}; known: {sorted(_SINKS)}") from None
