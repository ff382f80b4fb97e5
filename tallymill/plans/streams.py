"""Streaming forms of the event windows.

The checks describe what an append-mode stream must have written: windows and
sessions whose end the watermark (latest event time less the delay) has passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.plans.events import SESSION_SQL
from tallymill.plans.registry import query
from tallymill.session import scratch_path
from tallymill.sources.tables import table, table_path
from tallymill.streaming import jobs
from tallymill.streaming.alarms import silences


def _streamed(spark: SparkSession, folder: str, job: jobs.Transform, label: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    # A table may be one file or a folder of files. A stream accepts either if the
    # path is a pattern, here one that matches only the table itself.
    return jobs.streamed(spark, table_path(folder, "{events}"), schema, job, label)


@query(
    "stream_tumble",
    """
    SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           count(*) AS n_events, round(sum(value), 2) AS total_value
    FROM events GROUP BY 1, 2
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)
    """,
)
def stream_tumble(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, jobs.tumbling("2 hours", "1 hour"), "stream-tumble")


@query(
    "stream_slide",
    """
    SELECT start AS window_start, count(*) AS n_events
    FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events)
    WHERE start + INTERVAL 2 HOURS <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)
    GROUP BY start
    """,
)
def stream_slide(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, jobs.sliding("2 hours", "2 hours", "1 hour"), "stream-slide")


@query(
    "stream_session",
    f"""
    SELECT * FROM ({SESSION_SQL})
    WHERE session_end <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)
    """,
)
def stream_session(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, jobs.sessions("2 hours", "1 hour"), "stream-session")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    # The delay covers the whole month of events, so every repeat is dropped.
    return _streamed(spark, folder, jobs.first_seen("31 days", ["user_id", "event_type"]), "stream-dedup")


@query(
    "stream_late",
    """
    WITH marks AS (
      SELECT max(ts) FILTER (WHERE event_type <> 'error') - INTERVAL 2 DAYS AS first_mark,
             max(ts) - INTERVAL 2 DAYS AS last_mark FROM events)
    SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end,
           count(*) AS n_events, round(sum(value), 2) AS total_value
    FROM (SELECT date_trunc('day', ts) AS day, event_type, value FROM events), marks
    WHERE (event_type <> 'error' OR day + INTERVAL 1 DAY > first_mark) AND day + INTERVAL 1 DAY <= last_mark
    GROUP BY day
    """,
)
def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Daily totals when all error events arrive after everything else.

    The first run closes the days behind its watermark. The second run restarts
    from the saved state, finds the errors, and drops those of closed days.
    """
    events = table(spark, folder, "events")
    place = scratch_path(spark, "stream-late")
    arrived = f"{place}/arrived"
    for part in ("event_type <> 'error'", "event_type = 'error'"):
        events.filter(part).write.mode("append").parquet(arrived)
        stream = jobs.tumbling("2 days", "1 day")(jobs.arrivals(spark, arrived, events.schema))
        jobs.run_once(stream, place)
    return jobs.output(spark, place, stream.schema)


@query(
    "stream_join",
    """
    WITH mark AS (
      SELECT least(max(ts) FILTER (WHERE event_type = 'error'), max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 2 HOURS AS reached
      FROM events)
    SELECT e.event_id, e.user_id, e.ts AS asked_at, count(p.ts) AS n_answers, min(p.ts) AS answered_at
    FROM events e LEFT JOIN events p
      ON p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts > e.ts AND p.ts <= e.ts + INTERVAL 1 HOUR
    -- An hour is closed once no purchase in time for its last error can come any more.
    WHERE e.event_type = 'error' AND date_trunc('hour', e.ts) + INTERVAL 2 HOURS <= (SELECT reached FROM mark)
    GROUP BY e.event_id, e.user_id, e.ts
    """,
)
def stream_join(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams joined by time: for each error the purchases that its user makes within the next hour."""
    job = jobs.answers("2 hours", F.expr("event_type = 'error'"), F.expr("event_type = 'purchase'"))
    return _streamed(spark, folder, job, "stream-join")


@query(
    "stream_silence",
    f"""
    SELECT user_id, last_ts, n_events, alarm_no
    FROM (SELECT user_id, session_end - INTERVAL 1 HOUR AS last_ts, n_events, session_end,
                 row_number() OVER (PARTITION BY user_id ORDER BY session_end) AS alarm_no FROM ({SESSION_SQL}))
    WHERE session_end < (SELECT max(ts) - INTERVAL 2 HOURS FROM events)
    """,
)
def stream_silence(spark: SparkSession, folder: str) -> DataFrame:
    """A stream with timers of its own: an alarm whenever a user has done nothing for an hour, numbered per user."""
    return _streamed(spark, folder, silences("2 hours", 3600), "stream-silence")
