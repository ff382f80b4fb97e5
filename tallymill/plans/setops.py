"""Set and bag operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators import sets
from tallymill.plans.registry import query
from tallymill.sources.tables import table


@query(
    "union_distinct",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nationkey"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return customers.union(suppliers).distinct()


def _large_order_customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("custkey"))


@query(
    "intersect",
    """
    SELECT c_custkey AS custkey FROM customer WHERE c_acctbal > 8500
    INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 450000
    """,
)
def intersect(spark: SparkSession, folder: str) -> DataFrame:
    rich = table(spark, folder, "customer").filter("c_acctbal > 8500").select(F.col("c_custkey").alias("custkey"))
    return sets.intersect(rich, _large_order_customers(spark, folder))


@query(
    "except",
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 450000",
)
def except_(spark: SparkSession, folder: str) -> DataFrame:
    everyone = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"))
    return sets.subtract(everyone, _large_order_customers(spark, folder))


@query(
    "except_all",
    """
    SELECT o_custkey AS custkey, o_orderstatus AS status FROM orders
    EXCEPT ALL
    SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 100000
    """,
)
def except_all(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    columns = [F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status")]
    return sets.except_all(orders.select(*columns), orders.filter("o_totalprice > 100000").select(*columns))
