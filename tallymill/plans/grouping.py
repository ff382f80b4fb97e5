"""Aggregation: filters, grouping sets, pivots and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators.ordered import percentiles
from tallymill.plans.registry import query
from tallymill.sources.tables import sql, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "distinct_filter_agg",
    """
    SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n_events,
           count(*) FILTER (WHERE value > 100) AS n_large,
           round(sum(value) FILTER (WHERE value > 100), 2) AS large_total
    FROM events GROUP BY event_type
    """,
)
def distinct_filter_agg(spark: SparkSession, folder: str) -> DataFrame:
    return sql(
        spark,
        folder,
        """
        SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n_events,
               count(*) FILTER (WHERE value > 100) AS n_large,
               round(sum(value) FILTER (WHERE value > 100), 2) AS large_total
        FROM {events} GROUP BY event_type
        """,
        "events",
    )


@query(
    "having",
    """
    SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id
    HAVING 10 * count(*) * (SELECT count(DISTINCT user_id) FROM events) > 11 * (SELECT count(*) FROM events)
    """,
)
def having(spark: SparkSession, folder: str) -> DataFrame:
    # Users with over 1.1 times the average number of events.
    return sql(
        spark,
        folder,
        """
        SELECT user_id, count(*) AS n_events FROM {events} GROUP BY user_id
        HAVING 10 * count(*) * (SELECT count(DISTINCT user_id) FROM {events}) > 11 * (SELECT count(*) FROM {events})
        """,
        "events",
    )


@query(
    "grouping_sets",
    """
    SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INTEGER) AS no_status,
           CAST(grouping(o_orderpriority) AS INTEGER) AS no_priority,
           count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
    """,
)
def grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    # Every grouping copies its input rows, so the rows are totalled first.
    return sql(
        spark,
        folder,
        """
        WITH finest AS (
          SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(o_totalprice) AS t
          FROM {orders} GROUP BY o_orderstatus, o_orderpriority)
        SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INT) AS no_status,
               CAST(grouping(o_orderpriority) AS INT) AS no_priority,
               sum(n) AS n_orders, round(sum(t), 2) AS total
        FROM finest GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
        """,
        "orders",
    )


@query(
    "cube",
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders
    FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
    """,
)
def cube(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
        .cube("o_orderstatus", "o_orderpriority")
        .agg(F.sum("n").alias("n_orders"))
    )


@query(
    "rollup",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, o_orderstatus, count(*) AS n_orders,
           round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY ROLLUP (1, o_orderstatus)
    """,
)
def rollup(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("o_year"), "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t"))
        .rollup("o_year", "o_orderstatus")
        .agg(F.sum("n").alias("n_orders"), F.round(F.sum("t"), 2).alias("total"))
    )


@query(
    "pivot",
    """
    SELECT user_id, nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS click,
           nullif(count(*) FILTER (WHERE event_type = 'error'), 0) AS error,
           nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS purchase,
           nullif(count(*) FILTER (WHERE event_type = 'signup'), 0) AS signup,
           nullif(count(*) FILTER (WHERE event_type = 'view'), 0) AS view,
           nullif(count(*) FILTER (WHERE coalesce(event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view'), true)), 0) AS other
    FROM events GROUP BY user_id
    """,
)
def pivot(spark: SparkSession, folder: str) -> DataFrame:
    # Naming the values spares the extra job that looks for them; all others share a column.
    kind = F.when(F.col("event_type").isin(EVENT_TYPES), F.col("event_type")).otherwise("other")
    return (
        table(spark, folder, "events")
        .withColumn("kind", kind)
        .groupBy("user_id")
        .pivot("kind", [*EVENT_TYPES, "other"])
        .agg(F.count(F.lit(1)))
    )


@query(
    "unpivot",
    """
    SELECT p_partkey, 'p_retailprice' AS measure, p_retailprice AS amount FROM part
    UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS DOUBLE) FROM part
    """,
)
def unpivot(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .withColumn("p_size", F.col("p_size").cast("double"))
        .unpivot("p_partkey", ["p_retailprice", "p_size"], "measure", "amount")
    )


@query(
    "stats",
    """
    SELECT o_orderpriority, round(stddev_samp(o_totalprice), 4) AS sd, round(var_pop(o_totalprice / 1000), 6) AS var,
           round(corr(o_totalprice, o_custkey), 8) AS price_customer_corr
    FROM orders GROUP BY o_orderpriority
    """,
)
def stats(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.round(F.stddev_samp("o_totalprice"), 4).alias("sd"),
            F.round(F.var_pop(F.col("o_totalprice") / 1000), 6).alias("var"),
            F.round(F.corr("o_totalprice", F.col("o_custkey").cast("double")), 8).alias("price_customer_corr"),
        )
    )


PERCENTILES = {"p25": 0.25, "median": 0.5, "p90": 0.9}
PERCENTILE_SQL = """
    SELECT event_type, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS median,
           round(quantile_cont(value, 0.9), 6) AS p90
    FROM events GROUP BY event_type
    """


def _percentile_query(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    found = percentiles(table(spark, folder, "events"), ["event_type"], "value", PERCENTILES, **limits)
    return found.select("event_type", *[F.round(p, 6).alias(p) for p in PERCENTILES])


@query("percentile", PERCENTILE_SQL)
def percentile(spark: SparkSession, folder: str) -> DataFrame:
    return _percentile_query(spark, folder)


@query("percentile_hot", PERCENTILE_SQL)
def percentile_hot(spark: SparkSession, folder: str) -> DataFrame:
    # The form for keys too large for a task, forced by low limits.
    return _percentile_query(spark, folder, group_rows=100, block_rows=500)


@query(
    "argmax",
    """
    SELECT user_id, max_by(event_type, (ts, event_id)) AS last_type, max(ts) AS last_ts
    FROM events GROUP BY user_id
    """,
)
def argmax(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.max("ts").alias("last_ts"))
    )


@query(
    "approx_distinct",
    """
    SELECT event_type, count(DISTINCT user_id) AS n_users, true AS approximation_is_close
    FROM events GROUP BY event_type
    """,
)
def approx_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """The exact number, and whether the approximate one is within three standard errors of it."""
    error = 0.02
    # Beside an exact distinct count Spark would keep a sketch, some kilobytes, for every type and user.
    users = table(spark, folder, "events").select("event_type", "user_id").distinct()
    counted = users.groupBy("event_type").agg(
        F.count("user_id").alias("n_users"), F.approx_count_distinct("user_id", error).alias("_about")
    )
    off = F.abs(F.col("_about") - F.col("n_users"))
    return counted.select("event_type", "n_users", (off <= 3 * error * F.col("n_users")).alias("approximation_is_close"))
