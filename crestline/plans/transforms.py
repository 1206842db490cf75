"""What a pipeline computes, in two phases.

``on_stream`` builds one lazy frame from the named inputs.  ``on_batch`` then works on each
micro-batch of it, where operators that streams do not allow, such as ranking, may run; it
is ``None`` for a transform that has no such phase.  Both phases accept batch frames too.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.config import PipelineConfig
from crestline.operators import hopping_agg, hopping_agg_within, match_within, top_n, top_n_latest

BatchFn = Callable[[DataFrame, int], DataFrame]


class Transform(Protocol):
    on_batch: BatchFn | None

    def on_stream(self, inputs: Mapping[str, DataFrame]) -> DataFrame: ...


class TopPagesByGroup:
    """The most viewed pages of each gender and window, with view time and distinct users.

    Page views are joined to the registrations of the same user that happened up to the
    join bound before, summed per (gender, window, page), and ranked by total view time.
    """

    def __init__(self, config: PipelineConfig) -> None:
        self.window = config.window
        self.views = config.source_for("pageviews")
        self.users = config.source_for("users")

    def on_stream(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        missing = {self.views.name, self.users.name} - set(inputs)
        if missing:
            raise ValueError(f"missing inputs: {sorted(missing)}")
        views = inputs[self.views.name].select(
            "userid", "pageid", "viewtime", F.col(self.views.event_time).alias("_viewed")
        )
        users = inputs[self.users.name].select(
            "userid", "gender", F.col(self.users.event_time).alias("_registered")
        )
        keys = {
            "on": "userid",
            "left_time": "_viewed",
            "right_time": "_registered",
            "bound_seconds": self.window.join_bound_seconds,
        }
        if views.isStreaming:
            return hopping_agg_within(
                views,
                users,
                attribute="gender",
                item="pageid",
                measure="viewtime",
                size_seconds=self.window.size_seconds,
                slide_seconds=self.window.slide_seconds,
                distinct=self.window.distinct,
                **keys,
            )
        joined = match_within(views, users, attributes=["gender"], **keys)
        return hopping_agg(
            joined,
            time="_viewed",
            size_seconds=self.window.size_seconds,
            slide_seconds=self.window.slide_seconds,
            group=["gender", "pageid"],
            measure=F.col("viewtime") * F.col("matches"),
            entity="userid",
            distinct=self.window.distinct,
        )

    def on_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The leaders of every window of the batch, or of its latest one.

        The latest window is ranked by itself whatever the scope: ranked over all windows, it
        could lose its places to older ones.
        """
        if self.window.emit == "latest":
            return top_n_latest(
                batch,
                group=["gender"],
                item=["pageid"],
                order_by="total_viewtime",
                n=self.window.top,
                tie_break=["pageid"],
            )
        per_window = self.window.rank_scope == "window"
        return top_n(
            batch,
            partition_by=["gender", "window"] if per_window else ["gender"],
            order_by="total_viewtime",
            n=self.window.top,
            tie_break=["pageid"] if per_window else ["pageid", "window"],
        )


class NoOp:
    """Hands its only input through."""

    on_batch = None

    def __init__(self, config: PipelineConfig) -> None:
        pass

    def on_stream(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        if len(inputs) != 1:
            raise ValueError(f"noOp takes one input, got {sorted(inputs)}")
        return next(iter(inputs.values()))


# The names transforms are selected by.
_TRANSFORMS: dict[str, Callable[[PipelineConfig], Transform]] = {
    "top10ByGender": TopPagesByGroup,
    "noOp": NoOp,
}


def register_transform(name: str, factory: Callable[[PipelineConfig], Transform]) -> None:
    _TRANSFORMS[name] = factory


def get_transform(config: PipelineConfig) -> Transform:
    try:
        factory = _TRANSFORMS[config.transform]
    except KeyError:
        raise ValueError(
            f"unknown transform {config.transform!r}; known: {sorted(_TRANSFORMS)}"
        ) from None
    return factory(config)
