"""Input tables and partitioned output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def sql(spark: SparkSession, folder: str, text: str, *names: str) -> DataFrame:
    """Run SQL in which ``{name}`` stands for the table of that name."""
    return spark.sql(text, **{n: table(spark, folder, n) for n in names})


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Write ``df`` partitioned by columns, a few large files per value.

    The rebalance hint lets adaptive execution split a value that holds much of
    the table over several tasks and merge small ones.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.partitionBy(*by).parquet(path)
