"""Event-time windows over the events table, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators.sessions import sessions, sliding_counts
from tallymill.plans.registry import query
from tallymill.sources.tables import table

SESSION_SQL = """
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS n_events
    FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
          FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 1 HOUR
                          THEN 0 ELSE 1 END AS new FROM events))
    GROUP BY user_id, session
    """


@query(
    "tumble",
    """
    SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           count(*) AS n_events, round(sum(value), 2) AS total_value
    FROM events GROUP BY 1, 2
    """,
)
def tumble(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total_value"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events", "total_value")
    )


@query(
    "slide",
    """
    SELECT start AS window_start, count(*) AS n_events, round(sum(value), 2) AS total_value
    FROM (SELECT value, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events)
    GROUP BY start
    """,
)
def slide(spark: SparkSession, folder: str) -> DataFrame:
    counted = sliding_counts(table(spark, folder, "events"), "ts", "value", 7200, 3600)
    return counted.withColumn("total_value", F.round("total_value", 2))


@query("session", SESSION_SQL)
def session(spark: SparkSession, folder: str) -> DataFrame:
    return sessions(table(spark, folder, "events"), ["user_id"], "ts", 3600)


@query("session_hot", SESSION_SQL)
def session_hot(spark: SparkSession, folder: str) -> DataFrame:
    # The form for users of very many slots, forced by low limits.
    return sessions(table(spark, folder, "events"), ["user_id"], "ts", 3600, group_rows=60, block_rows=400)
