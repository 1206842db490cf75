"""What a pipeline reads, computes and writes, as immutable values checked on creation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from crestline.operators.windows import DISTINCT_MODES, check_window
from crestline.schemas import get_schema

TIME_UNITS = ("seconds", "millis", "micros")
EMIT_MODES = ("all", "latest")
RANK_SCOPES = ("window", "group")
SOURCE_FORMATS = ("json", "columns")


def _require(value: object, what: str) -> None:
    if not value:
        raise ValueError(f"{what} is required")


def _one_of(value: object, allowed: tuple, what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {allowed}, got {value!r}")


@dataclass(frozen=True)
class SourceConfig:
    """One input stream.

    ``event_time`` names the event-time column.  With ``time_field`` it is derived from that
    payload field; otherwise a payload field of the same name is converted in place, and
    failing that the source's own timestamp is used.  ``rejects`` is a folder for the messages
    that cannot be read; without one they are left out.
    """

    name: str
    schema: str
    event_time: str
    delay_seconds: int
    time_field: str | None = None
    time_unit: str = "millis"
    reader: str = "kafka"
    format: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)
    rejects: str | None = None

    def __post_init__(self) -> None:
        _require(self.name, "source name")
        _require(self.event_time, f"event-time column of source {self.name!r}")
        get_schema(self.schema)
        _one_of(self.time_unit, TIME_UNITS, "time unit")
        _one_of(self.format, SOURCE_FORMATS, "source format")
        if self.delay_seconds < 0:
            raise ValueError(f"delay of source {self.name!r} must not be negative")


@dataclass(frozen=True)
class WindowConfig:
    """Join bound, window, ranking and emission; the defaults are the stated requirement.

    ``salts`` is how many state partitions one user's page views are spread over in a
    stream, for the user who causes a third of them; registrations are kept once in each.
    """

    size_seconds: int = 60
    slide_seconds: int = 10
    join_bound_seconds: int = 20
    top: int = 10
    distinct: str = "exact"
    rank_scope: str = "window"
    emit: str = "all"
    salts: int = 8

    def __post_init__(self) -> None:
        check_window(self.size_seconds, self.slide_seconds)
        _one_of(self.distinct, tuple(m for m in DISTINCT_MODES if m), "distinct")
        _one_of(self.rank_scope, RANK_SCOPES, "rank scope")
        _one_of(self.emit, EMIT_MODES, "emit")
        if self.join_bound_seconds < 0:
            raise ValueError("join bound must not be negative")
        if self.top < 1 or self.salts < 1:
            raise ValueError("top and salts must be at least 1")


@dataclass(frozen=True)
class SinkConfig:
    """Where results go.  ``trigger_seconds=None`` processes what is there and stops."""

    checkpoint: str
    writer: str = "kafka"
    trigger_seconds: int | None = 60
    encoding: str | None = None
    query_name: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _require(self.checkpoint, "checkpoint location")
        _one_of(self.encoding, (None, "json", "avro"), "encoding")
        if self.trigger_seconds is not None and self.trigger_seconds <= 0:
            raise ValueError("trigger interval must be positive")


@dataclass(frozen=True)
class PipelineConfig:
    sources: tuple[SourceConfig, ...]
    sink: SinkConfig
    transform: str = "top10ByGender"
    window: WindowConfig = field(default_factory=WindowConfig)

    def __post_init__(self) -> None:
        _require(self.sources, "at least one source")
        names = [s.name for s in self.sources]
        if len(set(names)) != len(names):
            raise ValueError(f"source names must differ: {names}")

    def source_for(self, schema: str) -> SourceConfig:
        """The source that carries messages of a schema, whatever its topic is called."""
        found = [s for s in self.sources if s.schema == schema]
        if len(found) != 1:
            raise ValueError(f"need exactly one source with schema {schema!r}, got {len(found)}")
        return found[0]


# Names of the job options.
_LISTS = ("kafka-brokers", "input-topics")
_PAIRS = ("topic-watermark-pair", "topic-delay-pair", "topic-schematype-pair")
_OTHERS = (
    "output-topic",
    "window-duration-seconds",
    "sliding-window-seconds",
    "write-interval-seconds",
    "reader-type",
    "writer-type",
    "transform-type",
    "top-pages",
    "application",
)
OPTION_NAMES = (*_LISTS, *_PAIRS, *_OTHERS)


def _pairs(text: str) -> dict[str, str]:
    return dict(item.split("=", 1) for item in text.split(",") if item)


# Options of a reader or writer itself are passed on without these prefixes.
PASSED_ON = ("reader.", "writer.")


def _passed_on(options: Mapping[str, str], prefix: str, topic: str = "") -> dict[str, str]:
    """A value may name the topic it is for as ``{topic}``."""
    own = {k[len(prefix):]: v for k, v in options.items() if k.startswith(prefix)}
    return {k: v.replace("{topic}", topic) for k, v in own.items()}


def from_options(
    options: Mapping[str, str], *, checkpoint: str, join_bound_seconds: int | None = None
) -> PipelineConfig:
    """Build a configuration from job options given by name, all values as text.

    ``reader.x`` and ``writer.x`` become option x of every source or of the sink.  Brokers and
    the output topic are needed where Kafka is read or written.  The join bound defaults to
    the lateness of the users stream.
    """
    unknown = sorted(k for k in set(options) - set(OPTION_NAMES) if not k.startswith(PASSED_ON))
    if unknown:
        raise ValueError(f"unknown options: {unknown}")
    reader, writer = options.get("reader-type", "kafka"), options.get("writer-type", "kafka")
    brokers = {}
    if "kafka" in (reader, writer):
        _require(options.get("kafka-brokers"), "kafka-brokers")
        brokers = {"kafka.bootstrap.servers": options["kafka-brokers"]}
    for name in ("input-topics", *_PAIRS):
        _require(options.get(name), name)
    times, delays, schemas = (_pairs(options[name]) for name in _PAIRS)
    sources = []
    for topic in options["input-topics"].split(","):
        for name, values in zip(_PAIRS, (times, delays, schemas), strict=True):
            _require(values.get(topic), f"{name} for topic {topic!r}")
        kafka = {**brokers, "subscribe": topic} if reader == "kafka" else {}
        sources.append(
            SourceConfig(
                name=topic,
                schema=schemas[topic],
                event_time=times[topic],
                delay_seconds=int(delays[topic]),
                reader=reader,
                options={**kafka, **_passed_on(options, "reader.", topic)},
            )
        )
    if join_bound_seconds is None:
        late = [s.delay_seconds for s in sources if s.schema == "users"]
        join_bound_seconds = late[0] if late else WindowConfig.join_bound_seconds
    sink_options = _passed_on(options, "writer.")
    if writer == "kafka":
        _require(options.get("output-topic"), "output-topic")
        sink_options = {**brokers, "topic": options["output-topic"], **sink_options}
    return PipelineConfig(
        sources=tuple(sources),
        transform=options.get("transform-type", "top10ByGender"),
        window=WindowConfig(
            size_seconds=int(options.get("window-duration-seconds", 60)),
            slide_seconds=int(options.get("sliding-window-seconds", 10)),
            join_bound_seconds=join_bound_seconds,
            top=int(options.get("top-pages", 10)),
        ),
        sink=SinkConfig(
            checkpoint=checkpoint,
            writer=writer,
            trigger_seconds=int(options.get("write-interval-seconds", 60)),
            options=sink_options,
        ),
    )
