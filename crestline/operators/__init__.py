from crestline.operators.counted import hopping_agg_within
from crestline.operators.intervals import join_within, match_within
from crestline.operators.leaderboard import latest_window, top_n, top_n_latest
from crestline.operators.windows import hopping_agg

__all__ = [
    "hopping_agg", "hopping_agg_within", "join_within", "latest_window", "match_within", "top_n", "top_n_latest",
]
