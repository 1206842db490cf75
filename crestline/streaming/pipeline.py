"""Run a configured pipeline as a stream or over the same sources as a batch."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from crestline.config import PipelineConfig
from crestline.functions.messages import rejected_json
from crestline.operators.counted import ARRIVED, PASSED
from crestline.plans.transforms import BatchFn, get_transform
from crestline.schemas import get_schema
from crestline.session import configure
from crestline.sources.readers import get_reader, load_inputs
from crestline.streaming.sinks import get_sink
from crestline.streaming.state import open_input_rows


def start_rejects(spark: SparkSession, config: PipelineConfig) -> list[StreamingQuery]:
    """A query for each source with a ``rejects`` folder, which gets its unreadable messages.

    Each has a checkpoint of its own beside the pipeline's and counts its rows as the observed
    metric ``rejects``.  It reads the source by itself: a message that cannot be read has no
    time, so it cannot pass the stateful operators of the pipeline's own query.
    """
    started = []
    for source in config.sources:
        if source.rejects is None or source.format != "json":
            continue
        rows = rejected_json(get_reader(source.reader)(spark, source, True), get_schema(source.schema))
        writer = (
            rows.observe("rejects", F.count(F.lit(1)).alias("rows"))
            .writeStream.outputMode("append").format("parquet")
            .option("path", source.rejects)
            .option("checkpointLocation", f"{config.sink.checkpoint.rstrip('/')}-rejects-{source.name}")
        )
        seconds = config.sink.trigger_seconds
        when = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
        started.append(writer.trigger(**when).start())
    return started


def newest_only(on_batch: BatchFn, checkpoint: str) -> BatchFn:
    """Lets a batch of leaders through only if its window ends after all that earlier batches had.

    The newest end is kept beside the checkpoint, in two places that take turns, so that one of them
    is whole whenever a run stops; a batch that is run again is compared with what was before it.
    The leaders of one window are kept while they are looked at and written.
    """
    where = f"{checkpoint.rstrip('/')}-newest"
    held: list[DataFrame] = []

    def each(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        while held:
            held.pop().unpersist()
        leaders = on_batch(batch, batch_id).persist()
        held.append(leaders)
        before = None
        for place in (0, 1):
            try:
                rows = spark.read.schema(_NEWEST).parquet(f"{where}/{place}").where(F.col("batch_id") < batch_id)
                found = rows.orderBy(F.desc("batch_id")).first()
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                found = None
            if found and (before is None or found.batch_id > before.batch_id):
                before = found
        newest = leaders.agg(F.max(F.unix_micros("window.end"))).first()[0]
        known = before.ends if before else None
        later = newest is not None and (known is None or newest > known)
        row = (batch_id, newest if later else known)
        spark.createDataFrame([row], _NEWEST).coalesce(1).write.mode("overwrite").parquet(f"{where}/{batch_id % 2}")
        return leaders if later else leaders.limit(0)

    return each


_NEWEST = "batch_id long, ends long"


def run_pipeline(
    spark: SparkSession, config: PipelineConfig, side: list[StreamingQuery] | None = None
) -> StreamingQuery:
    """Start the stream and return its query; waiting for and stopping it is the caller's.

    Every name in the configuration is resolved before anything is opened.  The queries that
    write rejected messages are started along with it and put into ``side``.
    """
    transform, sink = get_transform(config), get_sink(config.sink.writer)
    for source in config.sources:
        get_reader(source.reader)
    configure(spark)
    streamed = transform.on_stream(load_inputs(spark, config))
    on_batch = transform.on_batch
    if on_batch and config.window.emit == "latest":
        on_batch = newest_only(on_batch, config.sink.checkpoint)
    query = sink(streamed, config.sink, on_batch)
    rejects = start_rejects(spark, config)
    if side is not None:
        side.extend(rejects)
    return query


def run_batch(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """The same transform over everything the sources hold now, as one lazy frame."""
    transform = get_transform(config)
    configure(spark)
    result = transform.on_stream(load_inputs(spark, config, streaming=False))
    return transform.on_batch(result, 0) if transform.on_batch else result


class DroppedRows(StreamingQueryListener):
    """Adds up, over all triggers, what stateful operators drop behind the watermark.

    Operators count after partial sums and copies to windows, so one late row can count as
    less or more than one: a signal that rows are late, not their number.  Unlike a query's
    own progress, which keeps the last hundred triggers, this forgets nothing.  Register it with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self) -> None:
        self.total = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.total += sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class RowCounts(StreamingQueryListener):
    """Adds up the rows that a counted leaderboard observes, over all triggers and restarts.

    Its first aggregation has one count for equal rows and drops only what its own time puts behind
    the watermark.  So what arrived, less what has left it, less what it still holds, are the late
    rows: an exact number, however many triggers there were.  Register it with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self) -> None:
        self._rows: dict[str, dict[str, int]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._changed:
            of = self._rows.setdefault(str(event.progress.id), {})
            for name, row in event.progress.observedMetrics.items():
                of[name] = of.get(name, 0) + (row["rows"] or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def late_rows(self, spark: SparkSession, queries: list[StreamingQuery], checkpoint: str, wait_seconds: float = 60) -> int:
        """Late rows of a query that has ended, given its runs, all of the same checkpoint."""
        runs = {str(q.runId) for q in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: runs <= self._ended, wait_seconds):
                raise TimeoutError("a run's progress has not been reported yet; is it stopped?")
            of = self._rows.get(str(queries[0].id), {})
        return of.get(ARRIVED, 0) - of.get(PASSED, 0) - open_input_rows(spark, checkpoint)


def recently_dropped(query: StreamingQuery) -> int:
    """What ``DroppedRows`` counts, over the triggers the query still remembers."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
