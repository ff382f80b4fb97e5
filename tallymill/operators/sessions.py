"""Event-time windows over batch tables, aggregated before they are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallymill.operators.layout import BLOCK_ROWS, GROUP_ROWS, find_large, running, total
from tallymill.operators.ordered import neighbour, windowed
from tallymill.session import written


def micros(time: str):
    """Microseconds since 1970 of a zone-less timestamp, free of the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{time}`)")


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_seconds: int,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Sessions per key: rows less than ``gap_seconds`` apart belong together.

    Rows in one slot of the gap's length are always in one session, so each slot
    is first reduced to its ends and count by an ordinary aggregation. A key has
    at most (time covered / gap) slots, however many events; where even those are
    too many for a task, slots are joined block by block.
    """
    slot = F.floor(micros(time) / (gap_seconds * 1_000_000))
    slots = written(
        df.groupBy(*keys, slot.alias("_slot")).agg(
            F.min(time).alias("_from"), F.max(time).alias("_to"), F.count(F.lit(1)).alias("_n")
        ),
        "slots",
    )
    order = [F.col("_slot")]
    large = find_large(slots, keys, group_rows)
    joined = windowed(slots, keys, order, {"_before": neighbour("_to", -1)}, block_rows=block_rows, large=large)
    goes_on = F.col("_from") < F.col("_before") + F.expr(f"INTERVAL {gap_seconds} SECONDS")
    starts = F.when(goes_on, F.lit(0)).otherwise(F.lit(1)).cast("long")
    return (
        running(joined, keys, order, [total("_session", starts)], large, block_rows)
        .groupBy(*keys, "_session")
        .agg(
            F.min("_from").alias("session_start"),
            F.expr(f"max(_to) + INTERVAL {gap_seconds} SECONDS").alias("session_end"),
            F.sum("_n").alias("n_events"),
        )
        .drop("_session")
    )


def sliding_counts(df: DataFrame, time: str, amount: str, width_seconds: int = 7200, step_seconds: int = 3600) -> DataFrame:
    """Windows of a width that start every step, built from partial totals per step.

    Rows are totalled per step first; only those totals are copied into the
    windows each step belongs to. The width must be a multiple of the step.
    """
    if step_seconds <= 0 or width_seconds % step_seconds:
        raise ValueError("the width must be a multiple of the step")
    slots = df.groupBy(F.window(time, f"{step_seconds} seconds")["start"].alias("_slot")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum")
    )
    back = range(0, width_seconds, step_seconds)
    starts = F.explode(F.array(*[F.col("_slot") - F.expr(f"INTERVAL {s} SECONDS") for s in back]))
    return (
        slots.withColumn("window_start", starts)
        .groupBy("window_start")
        .agg(F.sum("_n").alias("n_events"), F.sum("_sum").alias("total_value"))
    )
