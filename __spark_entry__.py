
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from crestline.plans import reports  # noqa: E402

# The training-data operators and their pipeline are a part that may be left out whole.
try:
    import corpus_pipeline  # noqa: E402
    from crestline import llm  # noqa: E402
except ImportError as missing:
    if (missing.name or "").split(".")[:2] not in (["corpus_pipeline"], ["crestline", "llm"]) and (
        missing.name != "crestline"
    ):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Top pages per gender and window on the smallest test data."""
    return reports.top_pages_by_group_window(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    more = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return more | {
        "users_from_events": reports.users,
        "pageviews_from_events": reports.pageviews,
        "interval_join": reports.interval_join,
        "interval_join_salted": reports.interval_join_salted,
        "interval_join_counts": reports.interval_join_counts,
        "hopping_sum": reports.hopping_sum,
        "hopping_sum_uneven": reports.hopping_sum_uneven,
        "tumbling_sum": reports.tumbling_sum,
        "hopping_distinct_exact": reports.hopping_distinct_exact,
        "hopping_distinct_approx": reports.hopping_distinct_approx,
        "top_pages_by_group_window": reports.top_pages_by_group_window,
        "top_pages_by_users": reports.top_pages_by_users,
        "top_pages_by_group": reports.top_pages_by_group,
        "top_pages_latest_window": reports.top_pages_latest_window,
        "top_pages_latest_by_group": reports.top_pages_latest_by_group,
        "top_pages_latest_stream": reports.top_pages_latest_stream,
        "top_pages_latest_triggers": reports.top_pages_latest_triggers,
        "top_pages_launched": reports.top_pages_launched,
        "pageviews_from_table": reports.pageviews_from_table,
        "interval_join_hot_user": reports.interval_join_hot_user,
        "top_pages_requested_window": reports.top_pages_requested_window,
        "distinct_pages": reports.distinct_pages,
        "total_viewtime": reports.total_viewtime,
        "decoded_pageviews": reports.decoded_pageviews,
        "decoded_users": reports.decoded_users,
        "rejected_messages": reports.rejected_messages,
        "rejected_stream": reports.rejected_stream,
        "rejected_staged": reports.rejected_staged,
        "top_pages_staged_stream": reports.top_pages_staged_stream,
        "encode_value_json": reports.encode_value_json,
        "noop": reports.noop,
        "json_file_scan": reports.json_file_scan,
        "top_pages_from_files": reports.top_pages_from_files,
        "top_pages_stream": reports.top_pages_stream,
        "late_rows_dropped": reports.late_rows_dropped,
        "late_rows_count": reports.late_rows_count,
        "state_after_flush": reports.state_after_flush,
        "noop_stream": reports.noop_stream,
        "interval_join_stream": reports.interval_join_stream,
        "tumbling_totals_stream": reports.tumbling_totals_stream,
        "hopping_totals_stream": reports.hopping_totals_stream,
        "hopping_distinct_approx_stream": reports.hopping_distinct_approx_stream,
        "top_pages_hot_user_stream": reports.top_pages_hot_user_stream,
    }


# The two streams, and the pairs of the interval join.
_STREAMS = """
users AS (
  SELECT user_id AS userid, c_mktsegment AS gender, c_nationkey AS regionid, ts AS registertime
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'signup'
),
views AS (
  SELECT CAST(round(value * 100) AS BIGINT) AS viewtime, user_id AS userid,
         'page_' || json_extract_string(props, '$.k') AS pageid, ts AS viewed_at
  FROM events WHERE event_type = 'view'
)"""

_PAIRS = """
pairs AS (
  SELECT v.userid, v.viewtime, v.pageid, v.viewed_at, u.gender, u.registertime
  FROM views v JOIN users u ON v.userid = u.userid
   AND v.viewed_at >= u.registertime AND v.viewed_at <= u.registertime + INTERVAL 7 DAYS
)"""

# Page views by themselves, in the shape of pairs.
_ALONE = """
pairs AS (SELECT userid, viewtime, pageid, viewed_at, 'any' AS gender FROM views)"""


def _hopping(size: int, slide: int, extra: str = "") -> str:
    """Windows from the slide-aligned start at or before a view, back over the size."""
    hops = -(-size // slide)
    return f"""
starts AS (
  SELECT p.*, time_bucket(to_seconds({slide}), viewed_at, TIMESTAMP '1970-01-01')
              - to_seconds({slide} * k) AS window_start
  FROM pairs p, range({hops}) AS hops(k)
),
totals AS (
  SELECT gender, pageid, window_start, window_start + to_seconds({size}) AS window_end,
         CAST(sum(viewtime) AS BIGINT) AS total_viewtime{extra}
  FROM starts WHERE viewed_at < window_start + to_seconds({size})
  GROUP BY gender, pageid, window_start
)"""


_USERS_TOO = ", count(DISTINCT userid) AS distinct_userid_count"
_WEEK, _DAY = 7 * 86_400, 86_400


def _ranked(keys: str, order: str = "total_viewtime", ties: str = "pageid") -> str:
    return f"""
ranked AS (
  SELECT *, CAST(row_number() OVER (
           PARTITION BY {keys} ORDER BY {order} DESC, {ties}) AS INTEGER) AS page_pos
  FROM totals
  QUALIFY page_pos <= 10
)"""


def _query(*parts: str, select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


# A third of both streams made one user's.
_HOT = ["""
hot_views AS (SELECT * REPLACE (CASE WHEN epoch_us(viewed_at) % 3 = 0 THEN 1 ELSE userid END AS userid) FROM views)""",
        """
hot_users AS (SELECT * REPLACE (CASE WHEN epoch_us(registertime) % 3 = 0 THEN 1 ELSE userid END AS userid) FROM users)"""]


def oracle_sql() -> dict[str, str]:
    weekly = _hopping(_WEEK, _DAY, _USERS_TOO)
    per_window = _ranked("gender, window_start")
    flagship = _query(_STREAMS, _PAIRS, weekly, per_window, select="SELECT * FROM ranked")
    latest = _query(
        _STREAMS, _PAIRS, weekly, per_window,
        select="SELECT * FROM ranked WHERE window_end = (SELECT max(window_end) FROM totals)",
    )
    views = _query(_STREAMS, select="SELECT * FROM views")
    text_views = _query(
        _STREAMS,
        select="SELECT viewtime, CAST(userid AS VARCHAR) AS userid, pageid, viewed_at FROM views",
    )
    pairs = _query(_STREAMS, _PAIRS, select="SELECT * FROM pairs")
    on_time = """
arrived AS (
  SELECT *, CAST(replace(pageid, 'page_', '') AS INTEGER) >= 90 AS is_late FROM views
),
mark AS (
  SELECT date_trunc('milliseconds', least(
           (SELECT max(viewed_at) FROM arrived WHERE NOT is_late),
           (SELECT max(registertime) FROM users))) - INTERVAL 7 DAYS AS watermark
),
pairs AS (
  SELECT v.userid, v.viewtime, v.pageid, v.viewed_at, u.gender
  FROM (SELECT a.* FROM arrived a, mark WHERE NOT is_late OR viewed_at > watermark) v
  JOIN users u ON v.userid = u.userid
   AND v.viewed_at >= u.registertime AND v.viewed_at <= u.registertime + INTERVAL 7 DAYS
)"""
    more = dict(llm.oracle_sql()) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return more | {
        "users_from_events": _query(_STREAMS, select="SELECT * FROM users"),
        "pageviews_from_events": views,
        "interval_join": pairs,
        "interval_join_salted": pairs,
        "interval_join_counts": _query(
            _STREAMS,
            _PAIRS,
            # The time of a view is unique within its user, so it identifies the view.
            select="""
SELECT userid, viewtime, pageid, viewed_at, gender, count(*) AS matches
FROM pairs GROUP BY userid, viewtime, pageid, viewed_at, gender""",
        ),
        "hopping_sum": _query(
            _STREAMS, _PAIRS, _hopping(_WEEK, _DAY), select="SELECT * FROM totals"
        ),
        "hopping_sum_uneven": _query(
            _STREAMS, _PAIRS, _hopping(5 * _DAY, 2 * _DAY), select="SELECT * FROM totals"
        ),
        "tumbling_sum": _query(
            _STREAMS, _PAIRS, _hopping(_WEEK, _WEEK), select="SELECT * FROM totals"
        ),
        "hopping_distinct_exact": _query(_STREAMS, _PAIRS, weekly, select="SELECT * FROM totals"),
        "top_pages_by_group_window": flagship,
        "top_pages_by_users": _query(
            _STREAMS,
            _PAIRS,
            weekly,
            _ranked("gender, window_start", "distinct_userid_count"),
            select="SELECT * FROM ranked",
        ),
        "top_pages_by_group": _query(
            _STREAMS,
            _PAIRS,
            weekly,
            _ranked("gender", ties="pageid, window_start"),
            select="SELECT * FROM ranked",
        ),
        "top_pages_latest_window": latest,
        "top_pages_latest_by_group": latest,
        "top_pages_latest_stream": latest,
        # Three slices of time and a flush; a window closes with the slot of a week its end lies in.
        "top_pages_latest_triggers": _query(
            _STREAMS, _PAIRS, weekly, per_window,
            """
cuts AS (
  SELECT k, min(epoch_us(viewed_at)) + k * (max(epoch_us(viewed_at)) - min(epoch_us(viewed_at))) / 3.0 AS cut
  FROM views, range(1, 4) r(k) GROUP BY k
),
marks AS (
  SELECT k, (least(
      (SELECT max(epoch_us(viewed_at)) FROM views WHERE k = 3 OR epoch_us(viewed_at) < cut),
      (SELECT max(epoch_us(registertime)) FROM users WHERE k = 3 OR epoch_us(registertime) < cut)
    ) // 1000) * 1000 - 3600000000 AS mark
  FROM cuts
),
closed AS (
  SELECT DISTINCT window_end,
         (SELECT count(*) FROM marks WHERE mark < (epoch_us(window_end) + 604799999999) // 604800000000 * 604800000000) AS slice
  FROM (SELECT DISTINCT window_end FROM totals)
),
published AS (SELECT max(window_end) AS window_end FROM closed GROUP BY slice)""",
            select="SELECT ranked.* FROM ranked JOIN published USING (window_end)",
        ),
        "top_pages_launched": flagship,
        "pageviews_from_table": views,
        "interval_join_hot_user": _query(
            _STREAMS,
            *_HOT,
            select="""
SELECT v.userid, v.pageid, u.gender, count(*) AS matches, CAST(sum(viewtime) AS BIGINT) AS total_viewtime
FROM hot_views v JOIN hot_users u ON v.userid = u.userid
 AND v.viewed_at >= u.registertime AND v.viewed_at <= u.registertime + INTERVAL 7 DAYS
GROUP BY v.userid, v.pageid, u.gender""",
        ),
        "hopping_distinct_approx": _query(
            _STREAMS, _PAIRS, _hopping(_WEEK, _DAY), select="SELECT *, TRUE AS within_error FROM totals"
        ),
        "top_pages_requested_window": _query(
            _STREAMS,
            _PAIRS,
            _hopping(60, 10, _USERS_TOO),
            per_window,
            select="SELECT * FROM ranked",
        ),
        "distinct_pages": _query(_STREAMS, select="SELECT DISTINCT pageid FROM views"),
        "total_viewtime": _query(
            _STREAMS, select="SELECT CAST(sum(viewtime) AS BIGINT) AS total_viewtime FROM views"
        ),
        "decoded_pageviews": text_views,
        "decoded_users": _query(
            _STREAMS,
            select="""
SELECT CAST(userid AS VARCHAR) AS userid, gender, CAST(regionid AS VARCHAR) AS regionid,
       date_trunc('milliseconds', registertime) AS registertime
FROM users""",
        ),
        # No document is a JSON object, hence every one is turned away and no view is.
        "rejected_messages": "SELECT text AS value FROM documents",
        "rejected_stream": "SELECT text AS value FROM documents",
        "rejected_staged": "SELECT text AS value FROM documents",
        "top_pages_staged_stream": flagship,
        "encode_value_json": _query(
            _STREAMS,
            _PAIRS,
            weekly,
            per_window,
            select="""
SELECT '{"gender":"' || gender || '","pageid":"' || pageid
       || '","total_viewtime":' || total_viewtime
       || ',"distinct_userid_count":' || distinct_userid_count
       || ',"page_pos":' || page_pos || '}' AS value
FROM ranked""",
        ),
        "noop": views,
        "json_file_scan": _query(
            _STREAMS,
            select="SELECT viewtime, CAST(userid AS VARCHAR) AS userid, pageid FROM views",
        ),
        "top_pages_from_files": flagship,
        "top_pages_stream": flagship,
        "late_rows_dropped": _query(
            _STREAMS, on_time, weekly, per_window, select="SELECT * FROM ranked"
        ),
        "late_rows_count": _query(
            _STREAMS, on_time,
            select="SELECT count(*) AS late_rows FROM arrived, mark WHERE is_late AND viewed_at <= watermark",
        ),
        # Four aggregations; all that is left is in the first one, numbered last.
        "state_after_flush": """
SELECT CAST(i AS INTEGER) AS operator_id, CASE WHEN i = 3 THEN 2 ELSE 0 END::BIGINT AS rows FROM range(4) t(i)""",
        "noop_stream": text_views,
        "interval_join_stream": _query(
            _STREAMS,
            _PAIRS,
            select="""
SELECT viewtime, CAST(userid AS VARCHAR) AS userid, pageid, viewed_at, gender FROM pairs""",
        ),
        "tumbling_totals_stream": _query(
            _STREAMS,
            select="""
SELECT pageid, date_trunc('day', viewed_at) AS window_start,
       date_trunc('day', viewed_at) + INTERVAL 1 DAY AS window_end,
       CAST(sum(viewtime) AS BIGINT) AS total_viewtime,
       count(DISTINCT userid) AS distinct_userid_count
FROM views GROUP BY ALL""",
        ),
        "hopping_totals_stream": _query(
            _STREAMS, _ALONE, weekly, select="SELECT * EXCLUDE (gender) FROM totals"
        ),
        "hopping_distinct_approx_stream": _query(
            _STREAMS, _ALONE, _hopping(_WEEK, _DAY),
            select="SELECT * EXCLUDE (gender), TRUE AS within_error FROM totals",
        ),
        "top_pages_hot_user_stream": _query(
            _STREAMS, *_HOT, _PAIRS.replace("views v", "hot_views v").replace("users u", "hot_users u"),
            weekly, per_window, select="SELECT * FROM ranked",
        ),
    }
