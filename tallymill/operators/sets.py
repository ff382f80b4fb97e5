"""Set and bag operations, and the null-aware exclusion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Copies of one row that a single task writes out when a bag is expanded.
COPIES_PER_TASK = 1_000_000


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows in both. Copies are removed before either side is shuffled."""
    return left.distinct().intersect(right.distinct())


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct left rows absent on the right."""
    return left.distinct().subtract(right.distinct())


def except_all(left: DataFrame, right: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Bag difference: each row as often as it is surplus on the left.

    Both sides are counted into one table of surpluses. A row with very many
    copies is handed out in chunks, so no task has to write all of them.
    """
    counts = (
        left.withColumn("_n", F.lit(1))
        .unionByName(right.withColumn("_n", F.lit(-1)))
        .groupBy(*left.columns)
        .agg(F.sum("_n").alias("_n"))
        .filter(F.col("_n") > 0)
    )
    last_chunk = F.floor((F.col("_n") - 1) / copies_per_task)
    chunks = (
        counts.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .withColumn("_n", F.least(F.lit(copies_per_task), F.col("_n") - F.col("_chunk") * copies_per_task))
        .repartition(*left.columns, "_chunk")
    )
    copies = F.explode(F.array_repeat(F.lit(True), F.col("_n").cast("int")))
    return chunks.withColumn("_copy", copies).select(*left.columns)


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """``column NOT IN (SELECT other FROM right)`` with SQL's NULL rules.

    Spark plans NOT IN over nullable columns by broadcasting the whole list.
    Here the list stays distributed: whether it is empty or has a NULL is a
    single-row subquery, and the rest is an ordinary anti join on distinct keys.
    """
    keys = right.select(F.col(other).alias("_other"))
    listed = keys.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_other").isNull()).alias("nulls")
    )
    n = listed.select("n").scalar()
    nulls = listed.select("nulls").scalar()
    distinct = keys.filter(F.col("_other").isNotNull()).distinct()
    unmatched = left.join(distinct, F.col(column) == F.col("_other"), "left_anti")
    return unmatched.filter((n == 0) | ((nulls == 0) & F.col(column).isNotNull()))


def matching(left: DataFrame, right: DataFrame, pairs: dict[str, str], keep: bool = True) -> DataFrame:
    """Semi join, or anti join with ``keep=False``.

    The right side is reduced to distinct keys before its shuffle, so a key that
    fills much of the right table arrives as one row per task.
    """
    keys = right.select(*[F.col(r).alias(f"_r_{r}") for r in pairs.values()]).distinct()
    condition: Column = reduce(
        lambda a, b: a & b, [F.col(l) == F.col(f"_r_{r}") for l, r in pairs.items()]
    )
    return left.join(keys, condition, "left_semi" if keep else "left_anti")
