"""Overlaps of spans without a common key, and sequences of events. ``*_hot`` forces small blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators.overlaps import overlap_join, overlap_totals
from tallymill.operators.patterns import sequences
from tallymill.operators.sessions import micros, sessions
from tallymill.plans.events import SESSION_SQL
from tallymill.plans.registry import query
from tallymill.sources.tables import table

# Outages are stretches of errors, of any users, less than ten minutes apart.
_SPANS_SQL = f"""
    visits AS ({SESSION_SQL}),
    outages AS (
      SELECT min(ts) AS outage_start, max(ts) + INTERVAL 10 MINUTES AS outage_end, count(*) AS n_errors
      FROM (SELECT *, sum(new) OVER (ORDER BY ts, event_id) AS outage
            FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (ORDER BY ts, event_id) + INTERVAL 10 MINUTES THEN 0 ELSE 1 END AS new
                  FROM events WHERE event_type = 'error'))
      GROUP BY outage)
    """


def _spans(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    visits = sessions(events, ["user_id"], "ts", 3600)
    # All errors have one key: one row per ten minutes with errors is left of them before any window.
    errors = events.filter("event_type = 'error'").select("ts", F.lit(0).alias("one"))
    outages = sessions(errors, ["one"], "ts", 600).select(
        F.col("session_start").alias("outage_start"), F.col("session_end").alias("outage_end"), F.col("n_events").alias("n_errors")
    )
    return visits, outages


OVERLAP_SQL = f"""
    WITH {_SPANS_SQL}
    SELECT user_id, session_start, session_end, outage_start, outage_end, n_errors,
           epoch_us(least(session_end, outage_end)) - epoch_us(greatest(session_start, outage_start)) AS overlap_micros
    FROM visits JOIN outages ON outage_start < session_end AND session_start < outage_end
    """


def _overlap_query(spark: SparkSession, folder: str, **sizes: int) -> DataFrame:
    visits, outages = _spans(spark, folder)
    pairs = overlap_join(
        visits.drop("n_events"), outages, ("session_start", "session_end"), ("outage_start", "outage_end"), **sizes
    )
    pairs = pairs.withColumnsRenamed({f"right_{c}": c for c in outages.columns})
    both = pairs.withColumns({"_from": F.greatest("session_start", "outage_start"), "_to": F.least("session_end", "outage_end")})
    return both.withColumn("overlap_micros", micros("_to") - micros("_from")).drop("_from", "_to")


@query("overlap_join", OVERLAP_SQL)
def overlap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _overlap_query(spark, folder)


@query("overlap_join_hot", OVERLAP_SQL)
def overlap_pairs_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _overlap_query(spark, folder, block_rows=400, pair_rows=16)


@query(
    "overlap_totals",
    f"""
    WITH {_SPANS_SQL}
    SELECT user_id, session_start, session_end, v.n_events, count(outage_start) AS n_overlaps,
           CAST(coalesce(sum(epoch_us(least(session_end, outage_end)) - epoch_us(greatest(session_start, outage_start)))
                         FILTER (WHERE outage_start IS NOT NULL), 0) AS DECIMAL(38, 0)) AS overlap
    FROM visits v LEFT JOIN outages ON outage_start < session_end AND session_start < outage_end
    GROUP BY user_id, session_start, session_end, v.n_events
    """,
)
def overlapping(spark: SparkSession, folder: str) -> DataFrame:
    visits, outages = _spans(spark, folder)
    visits = visits.withColumns({"_from": micros("session_start"), "_to": micros("session_end")})
    outages = outages.select(micros("outage_start").alias("_from"), micros("outage_end").alias("_to"))
    return overlap_totals(visits, outages, ("_from", "_to"), ("_from", "_to")).drop("_from", "_to")


SEQUENCE_SQL = """
    SELECT p.event_id, p.user_id, p.ts, max(v.ts) AS started
    FROM events p
    JOIN events c ON c.user_id IS NOT DISTINCT FROM p.user_id AND (c.ts, c.event_id) < (p.ts, p.event_id)
    JOIN events v ON v.user_id IS NOT DISTINCT FROM p.user_id AND (v.ts, v.event_id) < (c.ts, c.event_id)
    WHERE p.event_type = 'purchase' AND c.event_type = 'click' AND v.event_type = 'view' AND v.ts >= p.ts - INTERVAL 1 DAY
      AND NOT EXISTS (
        SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.user_id IS NOT DISTINCT FROM p.user_id
          AND (e.ts, e.event_id) > (v.ts, v.event_id) AND (e.ts, e.event_id) < (p.ts, p.event_id))
    GROUP BY p.event_id, p.user_id, p.ts
    """


def _sequence_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    steps = [F.col("event_type") == kind for kind in ("view", "click", "purchase")]
    found = sequences(events, ["user_id"], "ts", "event_id", steps, "1 DAY", F.col("event_type") == "error", **limits)
    return found.select("event_id", "user_id", "ts", "started")


@query("event_sequence", SEQUENCE_SQL)
def event_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return _sequence_query(spark, folder)


@query("event_sequence_hot", SEQUENCE_SQL)
def event_sequence_hot(spark: SparkSession, folder: str) -> DataFrame:
    # Users have about 66 events each: some fit, the others are cut into several blocks.
    return _sequence_query(spark, folder, group_rows=66, block_rows=16)
