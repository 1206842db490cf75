from __future__ import annotations

from dataclasses import FrozenInstanceError, replace

import pytest

from crestline.config import OPTION_NAMES, PipelineConfig, SinkConfig, SourceConfig, from_options
from crestline.config import WindowConfig
from crestline.plans.applications import get_application, launch, register_application
from crestline.plans.transforms import NoOp, TopPagesByGroup, get_transform, register_transform
from crestline.sources import get_reader, register_reader
from crestline.streaming import get_sink, register_sink, run_pipeline

OPTIONS = {
    "kafka-brokers": "one:9092,two:9092",
    "input-topics": "views-topic,users-topic",
    "topic-watermark-pair": "views-topic=timestamp,users-topic=timestamp",
    "topic-delay-pair": "views-topic=20,users-topic=30",
    "topic-schematype-pair": "views-topic=pageviews,users-topic=users",
    "output-topic": "top_pages",
    "window-duration-seconds": "60",
    "sliding-window-seconds": "30",
    "write-interval-seconds": "45",
    "reader-type": "kafka",
    "writer-type": "kafka",
    "transform-type": "top10ByGender",
    "top-pages": "7",
    "application": "challenge",
}


def source(name="v", schema="pageviews", **more):
    return SourceConfig(name=name, schema=schema, event_time="at", delay_seconds=5, **more)


def test_all_options_are_used():
    assert set(OPTIONS) == set(OPTION_NAMES)
    config = from_options(OPTIONS, checkpoint="/c")
    views, users = config.sources
    assert (views.name, views.schema, views.event_time) == ("views-topic", "pageviews", "timestamp")
    assert (views.delay_seconds, users.delay_seconds) == (20, 30)
    assert views.options["kafka.bootstrap.servers"] == "one:9092,two:9092"
    assert views.options["subscribe"] == "views-topic"
    assert config.window == WindowConfig(
        size_seconds=60, slide_seconds=30, join_bound_seconds=30, top=7
    )
    assert config.sink.options["topic"] == "top_pages"
    assert (config.sink.writer, config.sink.trigger_seconds) == ("kafka", 45)
    assert config.transform == "top10ByGender"
    assert from_options(OPTIONS, checkpoint="/c", join_bound_seconds=9).window.join_bound_seconds == 9


def test_defaults_are_the_stated_requirement():
    window = WindowConfig()
    assert (window.size_seconds, window.slide_seconds, window.top) == (60, 10, 10)
    assert (window.distinct, window.rank_scope, window.emit) == ("exact", "window", "all")


@pytest.mark.parametrize(
    "name",
    [
        "kafka-brokers",
        "input-topics",
        "topic-watermark-pair",
        "topic-delay-pair",
        "topic-schematype-pair",
        "output-topic",
    ],
)
def test_required_options(name):
    with pytest.raises(ValueError, match=name):
        from_options({k: v for k, v in OPTIONS.items() if k != name}, checkpoint="/c")


def test_every_topic_needs_its_pairs():
    with pytest.raises(ValueError, match="topic-delay-pair for topic 'users-topic'"):
        from_options({**OPTIONS, "topic-delay-pair": "views-topic=20"}, checkpoint="/c")


def test_other_ends_than_kafka_need_no_brokers():
    plain = {k: v for k, v in OPTIONS.items() if k not in ("kafka-brokers", "output-topic")}
    files = {"reader-type": "files", "writer-type": "files", "reader.path": "/in/{topic}", "writer.path": "/out"}
    config = from_options({**plain, **files}, checkpoint="/c")
    assert [s.options for s in config.sources] == [{"path": "/in/" + s.name} for s in config.sources]
    assert config.sink.options == {"path": "/out"}
    with pytest.raises(ValueError, match="kafka-brokers"):
        from_options({**plain, **files, "writer-type": "kafka"}, checkpoint="/c")
    mixed = from_options({**OPTIONS, "reader.startingOffsets": "earliest"}, checkpoint="/c")
    assert all(s.options["startingOffsets"] == "earliest" for s in mixed.sources)


def test_unknown_option():
    with pytest.raises(ValueError, match="colour"):
        from_options({**OPTIONS, "colour": "red"}, checkpoint="/c")


@pytest.mark.parametrize(
    "build",
    [
        lambda: source(schema="none"),
        lambda: source(time_unit="days"),
        lambda: source(format="xml"),
        lambda: replace(source(), delay_seconds=-1),
        lambda: replace(source(), event_time=""),
        lambda: WindowConfig(size_seconds=0),
        lambda: WindowConfig(slide_seconds=61),
        lambda: WindowConfig(distinct="some"),
        lambda: WindowConfig(emit="first"),
        lambda: WindowConfig(rank_scope="page"),
        lambda: WindowConfig(top=0),
        lambda: WindowConfig(join_bound_seconds=-1),
        lambda: SinkConfig(checkpoint=""),
        lambda: SinkConfig(checkpoint="/c", trigger_seconds=0),
        lambda: SinkConfig(checkpoint="/c", encoding="xml"),
        lambda: PipelineConfig(sources=(), sink=SinkConfig(checkpoint="/c")),
        lambda: PipelineConfig(sources=(source(), source()), sink=SinkConfig(checkpoint="/c")),
    ],
)
def test_bad_values_are_refused(build):
    with pytest.raises(ValueError):
        build()


def test_configuration_cannot_change():
    with pytest.raises(FrozenInstanceError):
        WindowConfig().top = 3


def test_registries():
    config = from_options(OPTIONS, checkpoint="/c")
    assert isinstance(get_transform(config), TopPagesByGroup)
    assert isinstance(get_transform(replace(config, transform="noOp")), NoOp)
    register_transform("mine", NoOp)
    assert isinstance(get_transform(replace(config, transform="mine")), NoOp)
    register_reader("mine", get_reader("files"))
    assert get_reader("mine") is get_reader("files")
    register_sink("mine", get_sink("noop"))
    assert get_sink("mine") is get_sink("noop")
    register_application("mine", get_application("challenge"))
    assert get_application("mine")(OPTIONS, "/c") == config


def test_unknown_names(spark):
    config = from_options(OPTIONS, checkpoint="/c")
    for get, name in [(get_reader, "reader"), (get_sink, "sink"), (get_application, "application")]:
        with pytest.raises(ValueError, match=f"unknown {name}"):
            get("none")
    with pytest.raises(ValueError, match="unknown transform"):
        run_pipeline(spark, replace(config, transform="none"))
    with pytest.raises(ValueError, match="unknown application 'nothing'"):
        launch(spark, {k: v for k, v in OPTIONS.items() if k != "application"}, "/c")


def test_a_schema_must_have_exactly_one_source():
    config = PipelineConfig(sources=(source(),), sink=SinkConfig(checkpoint="/c"))
    with pytest.raises(ValueError, match="'users'"):
        get_transform(config)


def test_kafka_job_reaches_the_connector(spark):
    """The connector is not part of this environment; Spark names what is missing."""
    with pytest.raises(Exception, match="kafka"):
        launch(spark, OPTIONS, "/c")


def test_kafka_reader_passes_options_on(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return "frame"

    from crestline.sources import readers

    monkeypatch.setattr(readers, "_begin", lambda spark, streaming: Reader())
    options = {"kafka.bootstrap.servers": "one:9092", "startingOffsets": "earliest"}
    assert readers.read_kafka(spark, source(name="topic", options=options), True) == "frame"
    assert seen == {"format": "kafka", "subscribe": "topic", **options}
    with pytest.raises(ValueError, match="kafka.bootstrap.servers"):
        readers.read_kafka(spark, source(), True)
