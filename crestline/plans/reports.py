"""Reports over the event tables: every operator and the whole pipeline, batch and stream.

The events are sparse, so the leaderboards use windows of a week that move by a day and
registrations that count for a week; ``top_pages_requested_window`` uses a minute and ten
seconds.  Times are given as zone-less columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crestline.config import PipelineConfig, SinkConfig, SourceConfig, WindowConfig
from crestline.functions import decode_json, encode_value, rejected_json, with_event_time
from crestline.operators import hopping_agg, join_within, match_within, top_n, top_n_latest
from crestline.plans.activity import pageviews_from_events, users_from_events
from crestline.plans.applications import launch
from crestline.plans.transforms import NoOp, TopPagesByGroup, register_transform
from crestline.schemas import PAGEVIEWS, USERS
from crestline.session import configure, shared_dir
from crestline.streaming.pipeline import RowCounts, run_batch, run_pipeline
from crestline.streaming.replay import (
    FLUSH_TIME,
    as_messages,
    feed,
    flush_message,
    flush_step,
    time_slices,
)
from crestline.streaming.sinks import read_committed
from crestline.streaming.staging import rejected_of, stage, stage_inputs, staged
from crestline.streaming.state import open_state

DAY = 86_400
WEEK = 7 * DAY
HOUR = 3_600

JOIN = {
    "on": "userid",
    "left_time": "viewed_at",
    "right_time": "registertime",
    "bound_seconds": WEEK,
}
WEEKLY = {"time": "viewed_at", "size_seconds": WEEK, "slide_seconds": DAY}
GROUP = ["gender", "pageid"]
PAGES_FROM_LATE_SOURCES = 90


def _plain_times(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _flat(df: DataFrame) -> DataFrame:
    """The window as two zone-less columns."""
    return df.withColumns(
        {
            "window_start": F.col("window.start").cast("timestamp_ntz"),
            "window_end": F.col("window.end").cast("timestamp_ntz"),
        }
    ).drop("window")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _plain_times(users_from_events(spark, sf_dir), "registertime")


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _plain_times(pageviews_from_events(spark, sf_dir), "viewed_at")


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    pairs = join_within(
        pageviews_from_events(spark, sf_dir),
        users_from_events(spark, sf_dir),
        right_columns=["gender", "registertime"],
        **JOIN,
    )
    return _plain_times(pairs, "viewed_at", "registertime")


def interval_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    pairs = join_within(
        pageviews_from_events(spark, sf_dir),
        users_from_events(spark, sf_dir),
        right_columns=["gender", "registertime"],
        salts=4,
        **JOIN,
    )
    return _plain_times(pairs, "viewed_at", "registertime")


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return match_within(
        pageviews_from_events(spark, sf_dir),
        users_from_events(spark, sf_dir),
        attributes=["gender"],
        **JOIN,
    )


def interval_join_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(_counted(spark, sf_dir), "viewed_at")


def _aggregate(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return hopping_agg(
        _counted(spark, sf_dir),
        group=GROUP,
        measure=F.col("viewtime") * F.col("matches"),
        entity="userid",
        **{**WEEKLY, **how},
    )


def hopping_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_aggregate(spark, sf_dir, distinct=None))


def hopping_sum_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A size that is not a multiple of the slide."""
    return _flat(
        _aggregate(spark, sf_dir, distinct=None, size_seconds=5 * DAY, slide_seconds=2 * DAY)
    )


def tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_aggregate(spark, sf_dir, distinct=None, slide_seconds=WEEK))


def hopping_distinct_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_aggregate(spark, sf_dir, distinct="exact"))


def hopping_distinct_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View time, and whether the estimate of distinct users is as near as stated.

    Four standard errors of 5 % and one user; the estimate itself is no fixed value.
    """
    guess = _aggregate(spark, sf_dir, distinct="approx").withColumnRenamed("distinct_userid_count", "guess")
    exact = _aggregate(spark, sf_dir, distinct="exact").drop("total_viewtime")
    near = F.abs(F.col("guess") - F.col("distinct_userid_count")) <= 1 + 0.2 * F.col("distinct_userid_count")
    both = guess.join(exact, [*GROUP, "window"], "left")
    return _flat(both.select(*GROUP, "window", "total_viewtime", F.coalesce(near, F.lit(False)).alias("within_error")))


def _ranked(df: DataFrame, keys: list[str], order_by: str = "total_viewtime") -> DataFrame:
    ties = ["pageid"] if "window" in keys else ["pageid", "window"]
    return top_n(df, partition_by=keys, order_by=order_by, n=10, tie_break=ties)


def top_pages_by_group_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_ranked(_aggregate(spark, sf_dir), ["gender", "window"]))


def top_pages_by_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked by distinct users, where most places are tied."""
    totals = _aggregate(spark, sf_dir)
    return _flat(_ranked(totals, ["gender", "window"], "distinct_userid_count"))


def top_pages_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_ranked(_aggregate(spark, sf_dir), ["gender"]))


def top_pages_latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(
        top_n_latest(
            _aggregate(spark, sf_dir), group=["gender"], item=["pageid"], order_by="total_viewtime",
            n=10, tie_break=["pageid"],
        )
    )


def top_pages_latest_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest window through the transform, ranked per gender over all windows elsewhere."""
    full = _pipeline("unused", delay_seconds=HOUR)
    config = replace(full, window=replace(full.window, rank_scope="group", emit="latest"))
    return _flat(TopPagesByGroup(config).on_batch(_aggregate(spark, sf_dir), 0))


def interval_join_hot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all views and of all registrations made one user's, counted per page."""
    configure(spark)
    views, users = pageviews_from_events(spark, sf_dir), users_from_events(spark, sf_dir)
    one = lambda time: F.when(F.unix_micros(time) % 3 == 0, 1).otherwise(F.col("userid"))
    matched = match_within(
        views.withColumn("userid", one("viewed_at")),
        users.withColumn("userid", one("registertime")),
        attributes=["gender"],
        **JOIN,
    )
    return matched.groupBy("userid", "pageid", "gender").agg(
        F.sum("matches").alias("matches"), F.sum(F.col("viewtime") * F.col("matches")).alias("total_viewtime")
    )


def top_pages_requested_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _aggregate(spark, sf_dir, size_seconds=60, slide_seconds=10)
    return _flat(_ranked(totals, ["gender", "window"]))


def distinct_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pageviews_from_events(configure(spark), sf_dir).select("pageid").distinct()


def total_viewtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = pageviews_from_events(configure(spark), sf_dir)
    return views.agg(F.sum("viewtime").alias("total_viewtime"))


# Messages -------------------------------------------------------------------------------


def _view_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(pageviews_from_events(spark, sf_dir), "pageviews", "viewed_at")


def _user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = users_from_events(spark, sf_dir).withColumn("at", F.col("registertime"))
    return as_messages(
        millis.withColumn("registertime", F.unix_millis("at")), "users", "at"
    )


def decoded_pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary messages parsed with the named schema; the event time is the source's."""
    configure(spark)
    messages = _view_messages(spark, sf_dir)
    binary = messages.withColumn("value", F.col("value").cast("binary"))
    timed = with_event_time(decode_json(binary, PAGEVIEWS), "viewed_at")
    return _plain_times(timed, "viewed_at")


def decoded_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event time is a payload field in milliseconds, converted in place."""
    configure(spark)
    decoded = decode_json(_user_messages(spark, sf_dir), USERS)
    timed = with_event_time(decoded, "registertime", unit="millis")
    return _plain_times(timed, "registertime")


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view messages mixed with document texts, which are no such messages."""
    configure(spark)
    noise = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("text").alias("value"), F.lit(None).cast("timestamp").alias("timestamp")
    )
    return rejected_json(_view_messages(spark, sf_dir).unionByName(noise), PAGEVIEWS).select("value")


def encode_value_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaders = _ranked(_aggregate(spark, sf_dir), ["gender", "window"])
    columns = ["gender", "pageid", "total_viewtime", "distinct_userid_count", "page_pos"]
    return encode_value(leaders, "json", columns)


def noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = pageviews_from_events(configure(spark), sf_dir)
    return _plain_times(NoOp(None).on_stream({"pageviews": views}), "viewed_at")


def json_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views saved as JSON files and scanned with the named schema."""
    configure(spark)
    folder = shared_dir(spark, "json-scan")
    views = pageviews_from_events(spark, sf_dir)
    views.select(*PAGEVIEWS.names).write.mode("errorifexists").json(folder)
    return spark.read.schema(PAGEVIEWS).json(folder)


# Streams --------------------------------------------------------------------------------


def _pipeline(root: str, delay_seconds: int) -> PipelineConfig:
    def source(name: str, schema: str, event_time: str) -> SourceConfig:
        return SourceConfig(
            name=name,
            schema=schema,
            event_time=event_time,
            delay_seconds=delay_seconds,
            reader="files",
            options={"path": f"{root}/{name}"},
        )

    return PipelineConfig(
        sources=(
            source("page-topic", "pageviews", "viewed_at"),
            source("user-topic", "users", "registered_at"),
        ),
        # Here a user registers about as often as they view, so copies are dear: few salts.
        window=WindowConfig(
            size_seconds=WEEK, slide_seconds=DAY, join_bound_seconds=WEEK, salts=2
        ),
        sink=SinkConfig(
            checkpoint=f"{root}/checkpoint",
            writer="files",
            trigger_seconds=None,
            options={"path": f"{root}/leaders"},
        ),
    )


def _messages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "page-topic": _view_messages(spark, sf_dir),
        "user-topic": _user_messages(spark, sf_dir),
    }


def _written(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    return read_committed(spark, config.sink.options["path"]).drop("batch_id")


def top_pages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard computed as a stream, fed in three slices of time and flushed."""
    configure(spark)
    config = _pipeline(shared_dir(spark, "top-pages"), delay_seconds=HOUR)
    messages = _messages(spark, sf_dir)
    # Two values, whatever the size of the table.
    first, last = messages["page-topic"].agg(F.min("timestamp"), F.max("timestamp")).first()
    third = (last - first) / 3
    borders = [first + third, first + 2 * third]
    feed(spark, config, [*time_slices(messages, borders), flush_step(spark, config)])
    return _flat(_written(spark, config))


def top_pages_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured pipeline run as a batch over the same kind of message files."""
    configure(spark)
    config = _pipeline(shared_dir(spark, "top-pages-batch"), delay_seconds=HOUR)
    for source in config.sources:
        _messages(spark, sf_dir)[source.name].write.parquet(source.options["path"])
    return _flat(run_batch(spark, config))


def top_pages_latest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated requirement as a stream: the leaders of the latest window only.

    Nothing is final before the flush, so all windows come in the trigger that it starts.
    """
    configure(spark)
    full = _pipeline(shared_dir(spark, "latest-pages"), delay_seconds=60 * DAY)
    config = replace(full, window=replace(full.window, emit="latest"))
    feed(spark, config, [_messages(spark, sf_dir), flush_step(spark, config)])
    return _flat(_written(spark, config))


def top_pages_latest_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated requirement over several triggers: each publishes the latest window it closes."""
    configure(spark)
    full = _pipeline(shared_dir(spark, "latest-triggers"), delay_seconds=HOUR)
    config = replace(full, window=replace(full.window, emit="latest"))
    messages = _messages(spark, sf_dir)
    first, last = messages["page-topic"].agg(F.min("timestamp"), F.max("timestamp")).first()
    third = (last - first) / 3
    borders = [first + third, first + 2 * third]
    feed(spark, config, [*time_slices(messages, borders), flush_step(spark, config)])
    return _flat(_written(spark, config))


def top_pages_launched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application started from options, files at both ends, triggered every second."""
    configure(spark)
    root = shared_dir(spark, "launched")
    options = {
        "application": "challenge",
        "reader-type": "files",
        "reader.path": f"{root}/{{topic}}",
        "input-topics": "pageviews,users",
        "topic-watermark-pair": "pageviews=viewed_at,users=registered_at",
        "topic-delay-pair": f"pageviews={WEEK},users={WEEK}",
        "topic-schematype-pair": "pageviews=pageviews,users=users",
        "window-duration-seconds": str(WEEK),
        "sliding-window-seconds": str(DAY),
        "write-interval-seconds": "1",
        "writer-type": "files",
        "writer.path": f"{root}/leaders",
    }
    messages = {"pageviews": _view_messages(spark, sf_dir), "users": _user_messages(spark, sf_dir)}
    for name, rows in messages.items():
        rows.write.parquet(f"{root}/{name}")
    query = launch(spark, options, f"{root}/checkpoint")
    try:
        query.processAllAvailable()
        # The flush comes when all files have been read: in another order it would make them late.
        for name in messages:
            flush_message(spark, name).write.mode("append").parquet(f"{root}/{name}")
        query.processAllAvailable()  # also runs the triggers without data that close windows
    finally:
        query.stop()
    return _flat(read_committed(spark, f"{root}/leaders").drop("batch_id"))


def pageviews_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views read by the name of a table, through a pipeline without a computation."""
    configure(spark)
    name = f"pageviews_{uuid.uuid4().hex}"
    pageviews_from_events(spark, sf_dir).createOrReplaceTempView(name)
    source = SourceConfig(
        name="views", schema="pageviews", event_time="viewed_at", delay_seconds=HOUR,
        reader="table", format="columns", options={"table": name},
    )
    sink = SinkConfig(checkpoint="unused", writer="noop")
    return _plain_times(run_batch(spark, PipelineConfig((source,), sink, transform="noOp")), "viewed_at")


def _late_pages(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, list[StreamingQuery]]:
    config = _pipeline(shared_dir(spark, "late-rows"), delay_seconds=WEEK)
    messages = _messages(spark, sf_dir)
    page = F.regexp_extract(F.get_json_object("value", "$.pageid"), r"_(\d+)$", 1).cast("int")
    views = messages["page-topic"]
    on_time = {**messages, "page-topic": views.where(page < PAGES_FROM_LATE_SOURCES)}
    late = {"page-topic": views.where(page >= PAGES_FROM_LATE_SOURCES)}
    return config, feed(spark, config, [on_time, late, flush_step(spark, config)])


def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard when the views of some pages arrive after everything else.

    Of those, the ones behind the watermark (a week) are dropped, the others still count.
    """
    configure(spark)
    config, _ = _late_pages(spark, sf_dir)
    return _flat(_written(spark, config))


def late_rows_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows that stream dropped, exactly."""
    configure(spark)
    counts = RowCounts()
    spark.streams.addListener(counts)
    try:
        config, runs = _late_pages(spark, sf_dir)
        late = counts.late_rows(spark, runs, config.sink.checkpoint)
    finally:
        spark.streams.removeListener(counts)
    return spark.range(1).select(F.lit(late).cast("long").alias("late_rows"))


def state_after_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the leaderboard's operators hold once all is flushed: the two flush messages."""
    configure(spark)
    config = _pipeline(shared_dir(spark, "open-state"), delay_seconds=HOUR)
    feed(spark, config, [_messages(spark, sf_dir), flush_step(spark, config)])
    return open_state(spark, config.sink.checkpoint).select("operator_id", "rows")


def noop_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views passed through a pipeline unchanged."""
    configure(spark)
    full = _pipeline(shared_dir(spark, "noop"), delay_seconds=HOUR)
    config = replace(full, sources=full.sources[:1], transform="noOp")
    feed(spark, config, [{"page-topic": _view_messages(spark, sf_dir)}])
    return _plain_times(_written(spark, config), "viewed_at")


def rejected_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a pipeline writes of page views mixed with document texts, which it cannot read."""
    configure(spark)
    full = _pipeline(shared_dir(spark, "rejects"), delay_seconds=HOUR)
    source = replace(full.sources[0], rejects=f"{full.sink.checkpoint}-out")
    config = replace(full, sources=(source,), transform="noOp")
    noise = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("text").alias("value"), F.lit(None).cast("timestamp").alias("timestamp")
    )
    feed(spark, config, [{"page-topic": _view_messages(spark, sf_dir)}, {"page-topic": noise}])
    return spark.read.parquet(source.rejects).select("value")


def _noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as messages, none of which is one."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("text").alias("value"), F.lit(None).cast("timestamp").alias("timestamp")
    )


def top_pages_staged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard of topics with unreadable messages in them, all of them parsed once."""
    configure(spark)
    root = shared_dir(spark, "staged")
    config = _pipeline(root, delay_seconds=HOUR)
    messages = _messages(spark, sf_dir)
    folders = {s.name: s.options["path"] for s in config.sources}
    messages["page-topic"] = messages["page-topic"].unionByName(_noise(spark, sf_dir))
    for step in (messages, flush_step(spark, config)):
        for name, rows in step.items():
            rows.write.mode("append").parquet(folders[name])
        over, _ = stage_inputs(spark, config, f"{root}/parsed")
        run_pipeline(spark, over).awaitTermination()
    return _flat(_written(spark, config))


def rejected_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other output of such a read: what could not be parsed."""
    configure(spark)
    root = shared_dir(spark, "staged-rejects")
    source = _pipeline(root, delay_seconds=HOUR).sources[0]
    _view_messages(spark, sf_dir).unionByName(_noise(spark, sf_dir)).write.parquet(source.options["path"])
    stage(spark, source, f"{root}/parsed").awaitTermination()
    return rejected_of(spark, staged(source, f"{root}/parsed")).select("value")


class JoinedViews:
    """The interval join alone, as a stream."""

    on_batch = None

    def __init__(self, config: PipelineConfig) -> None:
        self.bound_seconds = config.window.join_bound_seconds
        self.salts = config.window.salts

    def on_stream(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        return join_within(
            inputs["page-topic"],
            inputs["user-topic"],
            on="userid",
            left_time="viewed_at",
            right_time="registered_at",
            bound_seconds=self.bound_seconds,
            right_columns=["gender"],
            salts=self.salts,
        )


class PageTotals:
    """View time and distinct users of each page and window, as a stream without a join."""

    on_batch = None

    def __init__(self, config: PipelineConfig) -> None:
        self.window = config.window

    def on_stream(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        return hopping_agg(
            inputs["page-topic"],
            time="viewed_at",
            size_seconds=self.window.size_seconds,
            slide_seconds=self.window.slide_seconds,
            group=["pageid"],
            measure="viewtime",
            entity="userid",
            distinct=self.window.distinct,
        )


register_transform("joinedViews", JoinedViews)
register_transform("pageTotals", PageTotals)


def interval_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs come out as soon as both rows are in, so nothing has to be flushed."""
    configure(spark)
    full = _pipeline(shared_dir(spark, "joined-views"), delay_seconds=HOUR)
    config = replace(full, transform="joinedViews")
    feed(spark, config, [_messages(spark, sf_dir)])
    return _plain_times(_written(spark, config), "viewed_at")


def _page_totals(spark: SparkSession, sf_dir: str, **window) -> DataFrame:
    configure(spark)
    full = _pipeline(shared_dir(spark, "page-totals"), delay_seconds=HOUR)
    config = replace(
        full, sources=full.sources[:1], transform="pageTotals", window=WindowConfig(**window)
    )
    views = {"page-topic": _view_messages(spark, sf_dir)}
    feed(spark, config, [views, flush_step(spark, config)])
    return _flat(_written(spark, config).where(F.col("window.end") < F.lit(FLUSH_TIME)))


def tumbling_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_totals(spark, sf_dir, size_seconds=DAY, slide_seconds=DAY)


def hopping_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows of a stream, put together from panes of a day."""
    return _page_totals(spark, sf_dir, size_seconds=WEEK, slide_seconds=DAY)


def hopping_distinct_approx_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View time, and whether merged sketches of panes are as near as stated (see the batch one)."""
    guess = _page_totals(spark, sf_dir, size_seconds=WEEK, slide_seconds=DAY, distinct="approx")
    exact = _flat(
        hopping_agg(
            pageviews_from_events(spark, sf_dir), group=["pageid"], measure="viewtime", entity="userid", **WEEKLY
        )
    ).select("pageid", "window_start", F.col("distinct_userid_count").alias("exact"))
    near = F.abs(F.col("distinct_userid_count") - F.col("exact")) <= 1 + 0.2 * F.col("exact")
    both = guess.join(exact, ["pageid", "window_start"], "left")
    return both.withColumn("within_error", F.coalesce(near, F.lit(False))).drop("distinct_userid_count", "exact")


def _one_user(messages: DataFrame) -> DataFrame:
    """A third of all messages made those of one user, by their time in microseconds."""
    hot = F.regexp_replace("value", '"userid":"[^"]*"', '"userid":"1"')
    return messages.withColumn("value", F.when(F.unix_micros("timestamp") % 3 == 0, hot).otherwise(F.col("value")))


def top_pages_hot_user_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard as a stream when one user makes a third of all views and registrations."""
    configure(spark)
    config = _pipeline(shared_dir(spark, "hot-user"), delay_seconds=HOUR)
    messages = {name: _one_user(rows) for name, rows in _messages(spark, sf_dir).items()}
    feed(spark, config, [messages, flush_step(spark, config)])
    return _flat(_written(spark, config))
