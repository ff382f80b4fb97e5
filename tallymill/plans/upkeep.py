"""Tables written for later use: kept totals, a layout for joins, and rounds over a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators.hops import hops
from tallymill.operators.layouts import bucketed
from tallymill.operators.upkeep import CHANGE, KeptTotals
from tallymill.plans.registry import query
from tallymill.session import scratch_path
from tallymill.sources.tables import table


@query(
    "kept_totals",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, o_orderstatus, count(*) AS n_rows, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1997-07-01') GROUP BY 1, 2
    """,
)
def kept_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per year and status after three batches: the orders before 1998, the later ones, and early pending ones taken back."""
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderdate", "o_totalprice").withColumn("o_year", F.year("o_orderdate"))
    totals = {"total": F.col("o_totalprice").cast("decimal(18,2)")}
    kept = KeptTotals(spark, scratch_path(spark, "kept-totals"), "o_year", ["o_orderstatus"], totals)
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    kept.apply(orders.filter(early).withColumn(CHANGE, F.lit(1)), 1)
    kept.apply(orders.filter(~early).withColumn(CHANGE, F.lit(1)), 2)
    cancelled = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit("1997-07-01").cast("timestamp_ntz"))
    for _ in range(2):  # the second time changes nothing
        kept.apply(orders.filter(cancelled).withColumn(CHANGE, F.lit(-1)), 3)
    return kept.table().withColumn("total", F.col("total").cast("decimal(38,2)"))


@query(
    "bucketed_joins",
    """
    SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS n_lines, coalesce(sum(CAST(l_quantity AS BIGINT)), 0)::BIGINT AS pieces,
           coalesce(bool_or(l_returnflag = 'R'), false) AS has_return
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus
    """,
)
def bucketed_joins(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with totals of their lines and whether one was returned: two joins and a grouping on one layout, without a shuffle."""
    orders = bucketed(table(spark, folder, "orders"), "o_orderkey", ["o_orderkey", "o_orderstatus"])
    lines = bucketed(table(spark, folder, "lineitem"), "l_orderkey", ["l_orderkey", "l_quantity", "l_returnflag"])
    totals = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("pieces"))
    returned = lines.filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.lit(True).alias("has_return")).withColumnRenamed("l_orderkey", "r_orderkey")
    return (
        orders.join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(returned, F.col("o_orderkey") == F.col("r_orderkey"), "left")
        .select(
            "o_orderkey", "o_orderstatus", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("pieces", F.lit(0)).alias("pieces"),
            F.coalesce("has_return", F.lit(False)).alias("has_return"),
        )
    )


@query(
    "shared_purchases",
    """
    WITH RECURSIVE bought AS (
      SELECT DISTINCT 'c' || o_custkey AS a, 'p' || l_partkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
    edges AS (SELECT a, b FROM bought UNION ALL SELECT b, a FROM bought),
    reached(node, hops) AS (
      SELECT 'c1', CAST(0 AS BIGINT)
      UNION SELECT b, hops + 1 FROM reached JOIN edges ON a = node WHERE hops < 8)
    SELECT node, min(hops) AS hops FROM reached GROUP BY node
    """,
)
def shared_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """How far each customer and part is from customer 1: parts bought, their other buyers, what those bought, and so on."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("customer"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("part"))
    bought = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("customer", "part")
    return hops(bought, "customer", "part", spark.createDataFrame([("c1",)], "node string"))
