"""Click-stream sessions (WL-SESSION) over the events table."""

from __future__ import annotations

import datetime as dt

from kestrel.operators import sessions
from kestrel.plans.registry import query
from kestrel.sources.tables import Tables

# Oracle form of the reference job: LAG gap in whole seconds, flag, running sum.
SESSION_SQL = """
WITH g AS (
  SELECT user_id, ts AS logtime, CAST(ts AS DATE) AS source_date,
         COALESCE(CAST(floor(epoch(ts)) AS BIGINT)
                  - lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts), 0) AS total_activity_time
  FROM events),
f AS (SELECT *, CASE WHEN total_activity_time >= 1800 THEN 1 ELSE 0 END AS new_session FROM g),
s AS (
  SELECT user_id,
         CAST(user_id AS VARCHAR) || '_' || CAST(CAST(sum(new_session) OVER (PARTITION BY user_id ORDER BY logtime) AS BIGINT) AS VARCHAR) AS session_id,
         logtime, total_activity_time,
         CASE WHEN total_activity_time >= 1800 THEN 0 ELSE total_activity_time END AS session_active_time,
         source_date
  FROM f)
"""

MONTH_START = dt.date(2024, 1, 1)
MONTH_END = dt.date(2024, 1, 31)


def _sessions(spark, sf):
    return sessions.assign_sessions(Tables(spark, sf).events, "user_id", "ts", 1800)


@query("session_assign", SESSION_SQL + "SELECT * FROM s")
def session_assign(spark, sf):
    """PIP-05: the gold click-stream table (skew-safe day-chunked windows)."""
    return _sessions(spark, sf)


@query("session_count_per_day", SESSION_SQL + """
SELECT source_date, count(DISTINCT session_id) AS session_count FROM s GROUP BY source_date""")
def session_count_per_day(spark, sf):
    return sessions.sessions_per_day(_sessions(spark, sf))


@query("session_time_user_day", SESSION_SQL + """
SELECT user_id, source_date, CAST(sum(total_activity_time) AS BIGINT) AS total_time,
       CAST(sum(session_active_time) AS BIGINT) AS active_time FROM s GROUP BY user_id, source_date""")
def session_time_user_day(spark, sf):
    return sessions.time_per_user_day(_sessions(spark, sf))


@query("session_time_user_month", SESSION_SQL + f"""
SELECT user_id, CAST(sum(total_activity_time) AS BIGINT) AS total_time,
       CAST(sum(session_active_time) AS BIGINT) AS active_time FROM s
WHERE source_date BETWEEN DATE '{MONTH_START}' AND DATE '{MONTH_END}' GROUP BY user_id""")
def session_time_user_month(spark, sf):
    return sessions.time_per_user_range(_sessions(spark, sf), MONTH_START, MONTH_END)
