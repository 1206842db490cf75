from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime, timedelta

import fixtures
import pytest
from pyspark.sql import functions as F

from crestline.config import PipelineConfig, SinkConfig, SourceConfig, WindowConfig
from crestline.operators import hopping_agg
from crestline.sources import open_source
from crestline.streaming import DroppedRows, get_sink, recently_dropped, run_batch, run_pipeline
from crestline.streaming.replay import feed, flush_step, time_slices
from crestline.streaming.sinks import write_files

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def config(root, **window) -> PipelineConfig:
    """Fixture pipeline: tumbling windows of 10 s, the best 2 pages, times in milliseconds."""
    def source(name, schema, time_field):
        return SourceConfig(
            name=name,
            schema=schema,
            event_time="at",
            time_field=time_field,
            delay_seconds=60,
            reader="files",
            options={"path": f"{root}/{name}"},
        )

    settings = {
        "size_seconds": 10,
        "slide_seconds": 10,
        "join_bound_seconds": 10,
        "top": 2,
        "salts": 2,
        **window,
    }
    return PipelineConfig(
        sources=(source("v", "pageviews", "viewtime"), source("u", "users", "registertime")),
        window=WindowConfig(**settings),
        sink=SinkConfig(
            checkpoint=f"{root}/checkpoint",
            writer="files",
            trigger_seconds=None,
            options={"path": f"{root}/out"},
        ),
    )


def lines(spark, texts):
    return spark.createDataFrame([(t, EPOCH) for t in texts], "value string, timestamp timestamp")


def fixture_step(spark):
    return {"v": lines(spark, fixtures.view_lines()), "u": lines(spark, fixtures.user_lines())}


def flush_lines(spark):
    """Marker messages whose event time is a payload field."""
    far = 10**12
    return {
        "v": lines(spark, [f'{{"userid": "flush v", "viewtime": {far}}}']),
        "u": lines(spark, [f'{{"userid": "flush u", "registertime": {far}}}']),
    }


def leaders(df):
    start = F.unix_seconds("window.start")
    rows = df.select("gender", start, "page_pos", "pageid", "total_viewtime").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def written(spark, cfg):
    return spark.read.parquet(cfg.sink.options["path"])


@pytest.fixture
def stored(spark, tmp_path):
    """A configuration whose source folders hold the fixture messages."""
    cfg = config(tmp_path)
    for name, rows in fixture_step(spark).items():
        rows.write.parquet(f"{tmp_path}/{name}")
    return cfg


def test_batch_gives_the_fixture_results(spark, stored):
    assert leaders(run_batch(spark, stored)) == fixtures.TOP_2_PER_WINDOW
    everything = replace(stored, window=replace(stored.window, top=100))
    rows = run_batch(spark, everything).select(
        "gender",
        F.unix_seconds("window.start"),
        "pageid",
        "total_viewtime",
        "distinct_userid_count",
    )
    assert {tuple(r) for r in rows.collect()} == fixtures.TOTALS
    per_gender = replace(stored, window=replace(stored.window, rank_scope="group"))
    assert leaders(run_batch(spark, per_gender)) == fixtures.TOP_2_PER_GENDER
    latest = replace(stored, window=replace(stored.window, emit="latest"))
    assert leaders(run_batch(spark, latest)) == {r for r in fixtures.TOP_2_PER_WINDOW if r[1] == 10}


def test_seconds_instead_of_millis_match_nothing(spark, stored):
    """The fixtures' times only fit milliseconds; the unit is never guessed."""
    seconds = tuple(replace(s, time_unit="seconds") for s in stored.sources)
    assert run_batch(spark, replace(stored, sources=seconds)).count() == 0


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_stream_equals_batch(spark, tmp_path, distinct):
    cfg = config(tmp_path, distinct=distinct)
    feed(spark, cfg, [fixture_step(spark), flush_lines(spark)])
    assert leaders(written(spark, cfg)) == fixtures.TOP_2_PER_WINDOW
    assert written(spark, cfg).agg(F.max("distinct_userid_count")).first()[0] == 1


def test_stream_emits_only_the_latest_window_of_a_trigger(spark, tmp_path):
    cfg = config(tmp_path, emit="latest", distinct="approx")
    feed(spark, cfg, [fixture_step(spark), flush_lines(spark)])
    assert leaders(written(spark, cfg)) == {r for r in fixtures.TOP_2_PER_WINDOW if r[1] == 10}


def test_slices_and_restarts_equal_one_batch(spark, tmp_path):
    """Hopping windows over several runs of one checkpoint: nothing is lost or repeated.

        Times start after the epoch, where the first watermark of every stream stands.
        """
    def views(n):
        return spark.range(n).select(
            F.format_string('{"userid":"u%d","pageid":"p%d","viewtime":%d}',
                            F.col("id") % 5, F.col("id") % 7, F.col("id")).alias("value"),
            F.timestamp_seconds(F.col("id") + 1000).alias("timestamp"),
        )

    users = spark.range(40).select(
        F.format_string('{"userid":"u%d","gender":"%s"}',
                        F.col("id") % 5, F.when(F.col("id") % 5 < 3, "F").otherwise("M")).alias("value"),
        F.timestamp_seconds(F.col("id") * 7 + 1000).alias("timestamp"),
    )
    base = config(tmp_path, size_seconds=60, slide_seconds=10, join_bound_seconds=20, top=3)
    from_source = tuple(replace(s, time_field=None, delay_seconds=5) for s in base.sources)
    cfg = replace(base, sources=from_source)
    messages = {"v": views(300), "u": users}
    borders = [EPOCH + timedelta(seconds=s) for s in (1100, 1200)]
    runs = feed(spark, cfg, [*time_slices(messages, borders), flush_step(spark, cfg)])
    assert sum(recently_dropped(q) for q in runs) == 0
    columns = ["gender", "window", "pageid", "total_viewtime", "distinct_userid_count", "page_pos"]
    streamed = written(spark, cfg).select(*columns)
    batch = run_batch(spark, cfg).select(*columns)
    assert streamed.count() > 100
    assert streamed.exceptAll(batch).count() == batch.exceptAll(streamed).count() == 0
    # A further run with nothing new adds nothing.
    before = streamed.count()
    run_pipeline(spark, cfg).awaitTermination()
    assert written(spark, cfg).count() == before


def late_case(spark, tmp_path):
    """One source, 10 s windows, a delay of 5 s."""
    source = SourceConfig(
        name="v",
        schema="pageviews",
        event_time="at",
        delay_seconds=5,
        reader="files",
        options={"path": f"{tmp_path}/v"},
    )

    def add(page, *seconds):
        rows = [(f'{{"userid":"u","pageid":"{page}","viewtime":1}}', EPOCH + timedelta(seconds=s))
                for s in seconds]
        df = spark.createDataFrame(rows, "value string, timestamp timestamp")
        df.write.mode("append").parquet(f"{tmp_path}/v")

    def run():
        totals = hopping_agg(
            open_source(spark, source),
            time="at",
            size_seconds=10,
            slide_seconds=10,
            group=["pageid"],
            measure="viewtime",
            entity="userid",
        )
        sink = SinkConfig(
            checkpoint=f"{tmp_path}/c", writer="files", trigger_seconds=None,
            options={"path": f"{tmp_path}/out"},
        )
        query = get_sink("files")(totals, sink, None)
        query.awaitTermination()
        return recently_dropped(query)

    def totals():
        rows = spark.read.parquet(f"{tmp_path}/out").collect()
        return {(r.pageid, r.window.start.second, r.total_viewtime) for r in rows}

    return add, run, totals


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    add, run, totals = late_case(spark, tmp_path)
    add("on-time", 3, 26)
    assert run() == 0
    # The watermark is 21: the window up to 20 is closed, the one up to 30 is open.
    add("late", 4, 19)
    add("just-in-time", 20)
    assert run() > 0
    add("flush", 1000)
    run()
    assert totals() == {("on-time", 0, 1), ("on-time", 20, 1), ("just-in-time", 20, 1)}


def test_files_of_a_repeated_batch_replace_the_first_try(spark, tmp_path):
    sink = SinkConfig(checkpoint="/c", writer="files", options={"path": f"{tmp_path}/out"})
    write_files(spark.range(5), sink, 3)
    write_files(spark.range(2), sink, 3)
    write_files(spark.range(1), sink, 4)
    rows = spark.read.parquet(f"{tmp_path}/out").groupBy("batch_id").count().collect()
    assert {tuple(r) for r in rows} == {(3, 2), (4, 1)}


def test_json_encoded_files(spark, stored):
    sink = replace(
        stored.sink, encoding="json", options={**stored.sink.options, "file_format": "text"}
    )
    cfg = replace(stored, sink=sink, transform="noOp", sources=stored.sources[:1])
    run_pipeline(spark, cfg).awaitTermination()
    out = spark.read.text(sink.options["path"])
    assert out.where("get_json_object(value, '$.userid') is not null").count() == 18


def test_memory_sink(spark, stored):
    sink = SinkConfig(
        checkpoint=f"{stored.sink.checkpoint}-m", writer="memory", query_name="views",
        trigger_seconds=None,
    )
    cfg = replace(stored, sink=sink, transform="noOp", sources=stored.sources[:1])
    run_pipeline(spark, cfg).awaitTermination()
    assert spark.table("views").count() == 18
    with pytest.raises(ValueError, match="batch phase"):
        run_pipeline(spark, replace(stored, sink=sink))
    with pytest.raises(ValueError, match="query name"):
        run_pipeline(spark, replace(cfg, sink=replace(sink, query_name=None)))


@pytest.mark.parametrize("writer", ["noop", "console"])
def test_other_sinks_run(spark, stored, writer):
    sink = SinkConfig(checkpoint=f"{stored.sink.checkpoint}-{writer}", writer=writer,
                      trigger_seconds=None)
    cfg = replace(stored, sink=sink, transform="noOp", sources=stored.sources[:1])
    query = run_pipeline(spark, cfg)
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) > 0


def test_sink_options_are_checked(spark, stored):
    with pytest.raises(ValueError, match="path"):
        run_pipeline(spark, replace(stored, sink=replace(stored.sink, options={})))


def test_text_and_column_sources(spark, tmp_path):
    spark.createDataFrame([(t,) for t in fixtures.view_lines()], "value string").write.text(
        f"{tmp_path}/text"
    )
    text = SourceConfig(
        name="t", schema="pageviews", event_time="at", delay_seconds=0, reader="files",
        options={"path": f"{tmp_path}/text", "file_format": "text"},
    )
    rows = open_source(spark, text, streaming=False)
    assert rows.count() == 18 and rows.where("at is null").count() == 0
    assert open_source(spark, text).isStreaming

    spark.createDataFrame(fixtures.view_rows(), "viewtime long, userid string, pageid string") \
        .write.parquet(f"{tmp_path}/columns")
    columns = replace(
        text, format="columns", time_field="viewtime", options={"path": f"{tmp_path}/columns"}
    )
    assert open_source(spark, columns, streaming=False).count() == 18
    with pytest.raises(ValueError, match="'path'"):
        open_source(spark, replace(text, options={}))


def test_pretty_printed_json_files(spark, tmp_path):
    """An array over several lines is read whole, its first and last row included."""
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "users.json").write_text("[" + ",\n  ".join(fixtures.user_lines()) + "]")
    users = SourceConfig(
        name="u", schema="users", event_time="registertime", delay_seconds=0, reader="files",
        format="columns",
        options={"path": str(folder), "file_format": "json", "multiLine": "true"},
    )
    rows = open_source(spark, users, streaming=False)
    assert {r.userid for r in rows.collect()} == {u for u, *_ in fixtures.USERS}


def test_table_source(spark):
    spark.createDataFrame(fixtures.view_rows(), "viewtime long, userid string, pageid string") \
        .write.saveAsTable("stored_views")
    try:
        table = SourceConfig(
            name="t", schema="pageviews", event_time="at", time_field="viewtime", delay_seconds=0,
            reader="table", format="columns", options={"table": "stored_views"},
        )
        assert open_source(spark, table, streaming=False).count() == 18
        assert open_source(spark, table).isStreaming
    finally:
        spark.sql("DROP TABLE stored_views")


def test_a_first_batch_over_another_run_is_refused(spark, tmp_path):
    sink = SinkConfig(checkpoint="/c", writer="files", options={"path": str(tmp_path / "out")})
    write_files(spark.range(2), sink, 0)
    write_files(spark.range(3), sink, 0)  # the same batch again
    write_files(spark.range(1), sink, 1)
    with pytest.raises(ValueError, match="another run"):
        write_files(spark.range(2), sink, 0)


def test_dropped_rows_add_up_over_all_triggers():
    from types import SimpleNamespace as Any

    counter = DroppedRows()
    for n in range(250):
        counter.onQueryProgress(Any(progress=Any(stateOperators=[Any(numRowsDroppedByWatermark=n % 2), Any(numRowsDroppedByWatermark=1)])))
    assert counter.total == 375


def test_latest_window_whatever_the_rank_scope(spark, tmp_path):
    """Large totals of an older window do not take the places of the latest one."""
    cfg = config(tmp_path, emit="latest", rank_scope="group", top=2)
    rows = [("F", 0, "a", 100), ("F", 0, "b", 90), ("F", 60, "c", 5)]
    totals = spark.createDataFrame(rows, "gender string, at int, pageid string, total_viewtime long").select(
        "gender", "pageid", "total_viewtime",
        F.struct(F.timestamp_seconds("at").alias("start"), F.timestamp_seconds(F.col("at") + 60).alias("end")).alias("window"),
    )
    from crestline.plans.transforms import TopPagesByGroup

    assert [r.pageid for r in TopPagesByGroup(cfg).on_batch(totals, 0).collect()] == ["c"]


def test_a_crash_before_the_commit_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    from crestline.streaming import read_committed, sinks

    path = str(tmp_path / "out")
    sink = SinkConfig(checkpoint="/run", writer="files", options={"path": path})
    write_files(spark.range(3), sink, 0)
    commit = sinks._commit

    def crash(spark, path, sink, batch_id, state):
        if state == "committed":
            raise RuntimeError("lost")
        commit(spark, path, sink, batch_id, state)

    monkeypatch.setattr(sinks, "_commit", crash)
    with pytest.raises(RuntimeError):
        write_files(spark.range(10), sink, 1)
    assert read_committed(spark, path).count() == 3
    monkeypatch.setattr(sinks, "_commit", commit)
    sinks._last.clear()  # a new process
    write_files(spark.range(10), sink, 1)
    assert read_committed(spark, path).count() == 13
    # A batch whose commit did not reach the stream's checkpoint runs again and fails on the way.
    monkeypatch.setattr(sinks, "_commit", crash)
    sinks._last.clear()
    with pytest.raises(RuntimeError):
        write_files(spark.range(4), sink, 1)
    assert read_committed(spark, path).count() == 3
    monkeypatch.setattr(sinks, "_commit", commit)
    write_files(spark.range(10), sink, 1)
    assert read_committed(spark, path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 3), (1, 10)]
    with pytest.raises(ValueError, match="another run"):
        write_files(spark.range(1), replace(sink, checkpoint="/other"), 2)


def test_an_older_window_never_follows_a_newer_one(spark, tmp_path):
    from crestline.plans.transforms import TopPagesByGroup
    from crestline.streaming.pipeline import newest_only

    each = newest_only(TopPagesByGroup(config(tmp_path, emit="latest", top=5)).on_batch, f"{tmp_path}/c")

    def batch(*windows):
        rows = [("F", w, f"p{w}", 1) for w in windows]
        df = spark.createDataFrame(rows, "gender string, at int, pageid string, total_viewtime long")
        window = F.struct(F.timestamp_seconds("at").alias("start"), F.timestamp_seconds(F.col("at") + 60).alias("end"))
        return df.select("gender", "pageid", "total_viewtime", window.alias("window"))

    def pages(df, batch_id):
        return [r.pageid for r in each(df, batch_id).collect()]

    assert pages(batch(0, 60), 0) == ["p60"]
    assert pages(batch(0, 30), 1) == []  # an older window closes late
    assert pages(batch(60), 2) == []
    assert pages(batch(), 3) == []
    assert pages(batch(90, 120), 4) == ["p120"]
    assert pages(batch(90, 120), 4) == ["p120"]  # the same batch again
    assert pages(batch(180), 5) == ["p180"]
    assert pages(batch(120), 6) == []


def test_one_read_gives_decoded_and_rejected_messages(spark, tmp_path):
    """Over two runs: each message is in one of the two outputs, once."""
    from crestline.streaming.staging import rejected_of, stage_inputs

    cfg = config(tmp_path)
    bad = ["no json", '{"viewtime": "x"}', "", "[1"]
    steps = [fixture_step(spark), {k: v.unionByName(lines(spark, bad)) for k, v in flush_lines(spark).items()}]
    for step in steps:
        for name, rows in step.items():
            rows.write.mode("append").parquet(f"{tmp_path}/{name}")
        over, queries = stage_inputs(spark, cfg, f"{tmp_path}/staged")
        assert [s.reader for s in over.sources] == ["staged", "staged"] and len(queries) == 2
        run_pipeline(spark, over).awaitTermination()
    counts = [p.observedMetrics["staged"] for p in queries[0].recentProgress if p.numInputRows]
    assert [(c.decoded, c.rejected) for c in counts] == [(1, 4)]
    assert leaders(written(spark, cfg)) == fixtures.TOP_2_PER_WINDOW
    assert sorted(r.value for r in rejected_of(spark, over.sources[0]).collect()) == sorted(bad)
