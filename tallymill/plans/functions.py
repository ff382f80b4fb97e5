"""Python aggregates and table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.functions.udfs import Boxes, circular_means
from tallymill.plans.registry import query
from tallymill.sources.tables import sql, table


@query(
    "udaf",
    """
    SELECT event_type, round((turn - floor(turn)) * 86400, 3) AS mean_seconds, round(sqrt(x * x + y * y) / n, 6) AS concentration,
           n AS n_values
    FROM (SELECT *, atan2(y, x) / (2 * pi()) AS turn
          FROM (SELECT event_type, sum(cos(a)) AS x, sum(sin(a)) AS y, count(a) AS n
                FROM (SELECT event_type, 2 * pi() * (epoch_us(ts) % 86400000000) / 86400000000.0 AS a FROM events)
                WHERE a IS NOT NULL GROUP BY event_type))
    """,
)
def udaf(spark: SparkSession, folder: str) -> DataFrame:
    means = circular_means(table(spark, folder, "events"), ["event_type"], "ts", 86_400)
    return means.withColumns({"mean_seconds": F.round("mean_seconds", 3), "concentration": F.round("concentration", 6)})


@query(
    "udtf",
    """
    WITH RECURSIVE lines AS (
      SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS i FROM lineitem),
    packed AS (
      SELECT l_orderkey, i, 1 AS box, l_quantity AS fill FROM lines WHERE i = 1
      UNION ALL
      SELECT l.l_orderkey, l.i, CASE WHEN fill + l_quantity > 60 THEN box + 1 ELSE box END,
             CASE WHEN fill + l_quantity > 60 THEN l_quantity ELSE fill + l_quantity END
      FROM packed p JOIN lines l ON l.l_orderkey = p.l_orderkey AND l.i = p.i + 1)
    SELECT l_orderkey AS order_key, CAST(box AS INTEGER) AS box, CAST(count(*) AS INTEGER) AS n_lines, max(fill) AS quantity
    FROM packed GROUP BY l_orderkey, box
    """,
)
def udtf(spark: SparkSession, folder: str) -> DataFrame:
    """The boxes of 60 pieces into which the lines of each order go, large lines first."""
    # PARTITION BY would call the function once per order; it tells the orders of a sorted batch apart itself.
    spark.udtf.register("boxes", Boxes)
    return sql(
        spark,
        folder,
        """
        SELECT * FROM boxes(TABLE(
            SELECT l_orderkey, l_quantity, 60.0D AS capacity FROM {lineitem}
            DISTRIBUTE BY l_orderkey SORT BY l_orderkey, l_quantity DESC))
        """,
        "lineitem",
    )
