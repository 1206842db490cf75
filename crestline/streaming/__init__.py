from crestline.streaming.pipeline import DroppedRows, RowCounts, recently_dropped, run_batch, run_pipeline
from crestline.streaming.sinks import get_sink, read_committed, register_sink

from crestline.streaming.state import open_state

__all__ = [
    "DroppedRows", "RowCounts", "get_sink", "open_state", "read_committed", "recently_dropped", "register_sink",
    "run_batch", "run_pipeline",
]
