"""Ready-made pipelines by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from crestline.config import PipelineConfig, from_options
from crestline.streaming.pipeline import run_pipeline

Application = Callable[[Mapping[str, str], str], PipelineConfig]


def top_pages(options: Mapping[str, str], checkpoint: str) -> PipelineConfig:
    return from_options(options, checkpoint=checkpoint)


# The names applications are launched by.
_APPLICATIONS: dict[str, Application] = {"challenge": top_pages}
DEFAULT_APPLICATION = "nothing"


def register_application(name: str, application: Application) -> None:
    _APPLICATIONS[name] = application


def get_application(name: str) -> Application:
    try:
        return _APPLICATIONS[name]
    except KeyError:
        raise ValueError(f"unknown application {name!r}; known: {sorted(_APPLICATIONS)}") from None


def launch(spark: SparkSession, options: Mapping[str, str], checkpoint: str) -> StreamingQuery:
    """Start the application that the options name."""
    application = get_application(options.get("application", DEFAULT_APPLICATION))
    return run_pipeline(spark, application(options, checkpoint))
