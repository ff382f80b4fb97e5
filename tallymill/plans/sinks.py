"""Writing a partitioned table and reading back part of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.plans.registry import query
from tallymill.session import scratch_path
from tallymill.sources.tables import table, write_partitioned


@query(
    "partitioned_sink",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, o_orderstatus, count(*) AS n_orders,
           round(sum(o_totalprice), 2) AS total
    FROM orders WHERE year(o_orderdate) >= 1999 GROUP BY 1, 2
    """,
)
def partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-by-year")
    write_partitioned(table(spark, folder, "orders").withColumn("o_year", F.year("o_orderdate")), path, "o_year")
    return (
        spark.read.parquet(path)
        .filter("o_year >= 1999")
        .groupBy("o_year", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
