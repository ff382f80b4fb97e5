"""Window functions and top-k. ``*_hot`` forces the form for oversized keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tallymill.operators.layout import BLOCK_ROWS, GROUP_ROWS, find_large
from tallymill.operators.ordered import frame, neighbour, ranks, windowed
from tallymill.operators.timejoin import asof_join, trailing
from tallymill.plans.registry import query
from tallymill.session import written
from tallymill.sources.tables import table

# Limits for the forced forms. Each event type counts as oversized; users, who
# have about 66 events each, fall on both sides of the limit.
HOT = {"group_rows": 5, "block_rows": 400}
HOT_USERS = {"group_rows": 66, "block_rows": 400}

RANK_SQL = """
    SELECT event_id, event_type, value,
           row_number() OVER r AS row_number, rank() OVER p AS rank, dense_rank() OVER p AS dense_rank,
           CAST(ntile(4) OVER r AS INTEGER) AS ntile,
           round(percent_rank() OVER p, 9) AS percent_rank, round(cume_dist() OVER p, 9) AS cume_dist
    FROM events
    WINDOW p AS (PARTITION BY event_type ORDER BY value NULLS FIRST),
           r AS (PARTITION BY event_type ORDER BY value NULLS FIRST, event_id)
    """


def _rank_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    ranked = ranks(events, ["event_type"], "value", ["event_id"], **limits)
    return ranked.withColumns({c: F.round(c, 9) for c in ["percent_rank", "cume_dist"]})


@query("rank_family", RANK_SQL)
def rank_family(spark: SparkSession, folder: str) -> DataFrame:
    return _rank_query(spark, folder)


@query("rank_family_hot", RANK_SQL)
def rank_family_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _rank_query(spark, folder, **HOT)


LAG_SQL = """
    SELECT event_id, user_id, lag(value) OVER w AS prev_value, lead(event_type, 2) OVER w AS after_next_type,
           first_value(value) OVER w AS first_value, nth_value(value, 3) OVER w AS third_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """


def _lag_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value", "event_type")
    return windowed(
        events,
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        {"prev_value": neighbour("value", -1), "after_next_type": neighbour("event_type", 2)},
        nth={"first_value": ("value", 1), "third_value": ("value", 3)},
        **limits,
    ).select("event_id", "user_id", "prev_value", "after_next_type", "first_value", "third_value")


@query("lag_lead", LAG_SQL)
def lag_lead(spark: SparkSession, folder: str) -> DataFrame:
    return _lag_query(spark, folder)


@query("lag_lead_hot", LAG_SQL)
def lag_lead_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _lag_query(spark, folder, **HOT_USERS)


ROWS_SQL = """
    SELECT event_id, round(sum(value) OVER w, 2) AS sum3, CAST(count(*) OVER w AS BIGINT) AS n3,
           max(value) OVER w AS max3
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """


def _rows_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return windowed(
        events,
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        {
            "sum3": frame(F.sum("value"), -2, 0),
            "n3": frame(F.count(F.lit(1)), -2, 0),
            "max3": frame(F.max("value"), -2, 0),
        },
        **limits,
    ).select("event_id", F.round("sum3", 2).alias("sum3"), "n3", "max3")


@query("rows_frame", ROWS_SQL)
def rows_frame(spark: SparkSession, folder: str) -> DataFrame:
    return _rows_query(spark, folder)


@query("rows_frame_hot", ROWS_SQL)
def rows_frame_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _rows_query(spark, folder, **HOT_USERS)


RANGE_SQL = """
    SELECT event_id, user_id, count(*) OVER w AS n_past_hour, round(sum(value) OVER w, 2) AS value_past_hour
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
    """


def _range_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return trailing(
        events,
        ["user_id"],
        "ts",
        "1 HOUR",
        # Differences of totals must be exact; twelve places are finer than any amount.
        {"n_past_hour": F.lit(1).cast("long"), "_sum": F.col("value").cast("decimal(28,12)")},
        **limits,
    ).select("event_id", "user_id", "n_past_hour", F.round(F.col("_sum").cast("double"), 2).alias("value_past_hour"))


@query("range_frame", RANGE_SQL)
def range_frame(spark: SparkSession, folder: str) -> DataFrame:
    return _range_query(spark, folder)


@query("range_frame_hot", RANGE_SQL)
def range_frame_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _range_query(spark, folder, group_rows=132, block_rows=400)


INTERVAL_SQL = """
    SELECT e.event_id, e.user_id, e.event_type, count(*) AS n_errors, max(x.ts) AS last_error_ts
    FROM events e JOIN events x
      ON e.user_id = x.user_id AND x.event_type = 'error'
     AND x.ts < e.ts AND x.ts >= e.ts - INTERVAL 1 HOUR
    GROUP BY e.event_id, e.user_id, e.event_type
    """


def _interval_query(
    spark: SparkSession, folder: str, group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    # One row per event with its errors counted: pairs of events and errors
    # would grow with the square of a busy user's rows.
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type").dropna(subset=["user_id"])
    is_error = F.col("event_type") == "error"
    # Both steps handle at most two rows per event of a user.
    large = find_large(events, ["user_id"], group_rows // 2)
    size = {"large": large, "block_rows": block_rows}
    counted = trailing(
        events, ["user_id"], "ts", "1 HOUR", {"n_errors": is_error.cast("long")}, include_now=False, **size
    ).filter("n_errors > 0")
    if large.some:
        # The parts of the next step would each work this out again.
        counted = written(counted, "counted")
    joined = asof_join(
        counted, events.filter(is_error), ["user_id"], "ts", "event_id", ["ts"], inclusive=False, **size
    )
    return joined.select(
        "event_id", "user_id", "event_type", "n_errors", F.col("right_ts").alias("last_error_ts")
    )


@query("interval_join", INTERVAL_SQL)
def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    return _interval_query(spark, folder)


@query("interval_join_hot", INTERVAL_SQL)
def interval_join_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _interval_query(spark, folder, group_rows=132, block_rows=400)


ASOF_SQL = """
    SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.ts AS click_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON p.user_id = c.user_id AND p.ts >= c.ts
    """


def _asof_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    purchases = events.filter("event_type = 'purchase'").drop("event_type")
    clicks = events.filter("event_type = 'click'").drop("event_type")
    return asof_join(purchases, clicks, ["user_id"], "ts", "event_id", ["event_id", "ts"], **limits).select(
        "event_id", "user_id", "ts", F.col("right_event_id").alias("click_id"), F.col("right_ts").alias("click_ts")
    )


@query("asof", ASOF_SQL)
def asof(spark: SparkSession, folder: str) -> DataFrame:
    return _asof_query(spark, folder)


@query("asof_hot", ASOF_SQL)
def asof_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _asof_query(spark, folder, group_rows=26, block_rows=400)


@query(
    "topk_group",
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(place AS INTEGER) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey,
                 l_linenumber, l_partkey, l_quantity, l_discount, l_tax, l_shipdate) AS place FROM lineitem)
    WHERE place <= 3
    """,
)
def topk_group(spark: SparkSession, folder: str) -> DataFrame:
    # The filter on row_number cuts each key to three rows before the shuffle.
    window = W.partitionBy("l_suppkey").orderBy(
        F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax",
        "l_shipdate",
    )
    return (
        table(spark, folder, "lineitem")
        .withColumn("place", F.row_number().over(window))
        .filter("place <= 3")
        .select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "place")
    )


@query(
    "topk",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5",
)
def topk(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .offset(5)
        .limit(10)
    )
