"""Sequences of events: steps in order, not interrupted, within a span of time.

A sequence of k steps is followed by an automaton whose state is, for each number of
steps done, the latest time at which such a beginning started (the latest one leaves
most time for the rest). An event that interrupts clears the state.

What a stretch of events does to the state is a map of the same form for every stretch:
each entry becomes the latest of a constant and of those earlier entries that the
stretch carries on. Such maps compose, so a key too large for a task is cut into blocks:
every block's map is worked out on its own, the maps of a key are applied one after the
other (one row per block), and each block starts from the state it is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.operators.layout import BLOCK, BLOCK_ROWS, GROUP_ROWS, POSITION, Large, block_window, find_large, lay_out


def sequences(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie_break: str,
    steps: Sequence[Column],
    within: str,
    unless: Column | None = None,
    large: Large | None = None,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows of ``df`` that complete a sequence, with ``started``, the time of its first step.

    Rows of a key go by ``time`` and ``tie_break``. A sequence has a row for each of
    ``steps`` in this order, other rows in between, none that satisfies ``unless``, and at
    most ``within`` (an interval, such as "1 DAY") from first to last. Of several
    sequences that end at a row the one that started last counts. A row takes part in a
    sequence once, but may be a step of many; one that interrupts is no step. Conditions
    that are null do not hold. Null keys are a key of their own; rows without a time are
    left out.
    """
    if len(steps) < 2:
        raise ValueError("a sequence has two steps or more")
    rows = df.filter(F.col(time).isNotNull())
    stops = F.lit(False) if unless is None else F.coalesce(unless, F.lit(False))
    flags = {f"_step{i}": F.coalesce(step, F.lit(False)) & ~stops for i, step in enumerate(steps, 1)}
    rows = rows.withColumns({"_stop": stops, **flags})
    if large is None:
        large = find_large(rows, keys, group_rows)
    last = len(steps)

    def complete(rows: DataFrame, window: W) -> DataFrame:
        """Rows whose last step follows a beginning of all the others."""
        followed = _followed(rows, window, last)
        start = F.when(F.col(f"_before{last - 1}.part") == F.col("_part"), F.col(f"_before{last - 1}.start"))
        ends = F.col(f"_step{last}") & (F.col(time) <= F.col("started") + F.expr(f"INTERVAL {within}"))
        return followed.withColumn("started", start).filter(ends).select(*df.columns, "started")

    def native(rows: DataFrame) -> DataFrame:
        given = rows.withColumns({f"_given{i}": F.lit(None).cast(df.schema[time].dataType) for i in range(1, last)})
        return complete(given.withColumn("_time", F.col(time)), W.partitionBy(*keys).orderBy(time, tie_break))

    def blocked(rows: DataFrame) -> DataFrame:
        laid_out = lay_out(rows, keys, [F.col(time), F.col(tie_break)], block_rows, large.rows).withColumn("_time", F.col(time))
        header = _states(laid_out, keys, last)
        return complete(laid_out.unionByName(header, allowMissingColumns=True), block_window(keys))

    return large.apply(rows, native, blocked)


def _followed(rows: DataFrame, window: W, last: int) -> DataFrame:
    """Add ``_part``, the number of interruptions up to each row, and ``_beforeI``: the state ahead of it.

    ``_beforeI`` is the latest start of I steps and the part in which it was reached;
    it holds as long as that is the row's part. A row in front of the others may give
    the state that they start from, in ``_given1`` and so on.
    """
    part = F.count_if(F.coalesce("_stop", F.lit(False))).over(window.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_part", part)
    earlier = window.rowsBetween(W.unboundedPreceding, -1)
    for i in range(1, last):
        if i == 1:
            start = F.when(F.col("_step1"), F.col("_time"))
        else:
            known = F.col(f"_before{i - 1}")
            start = F.when(F.col(f"_step{i}") & (known["part"] == F.col("_part")), known["start"])
        reached = F.coalesce(F.col(f"_given{i}"), start)
        rows = rows.withColumn(f"_reached{i}", F.when(reached.isNotNull(), F.struct(F.col("_part").alias("part"), reached.alias("start"))))
        rows = rows.withColumn(f"_before{i}", F.max(f"_reached{i}").over(earlier))
    return rows


def _states(laid_out: DataFrame, keys: Sequence[str], last: int) -> DataFrame:
    """One row per key and block, in front of its rows: the state that the key's earlier blocks leave."""
    window, time = block_window(keys), laid_out.schema["_time"].dataType
    rows = laid_out.withColumns({f"_given{i}": F.lit(None).cast(time) for i in range(1, last)})
    rows = _followed(rows, window, last)
    earlier = window.rowsBetween(W.unboundedPreceding, -1)
    # Whether the steps j + 1 to i are done before anything interrupts, so that j steps become i.
    carried = {}
    for j in range(1, last):
        for i in range(j + 1, last):
            name = f"_carried{j}_{i}"
            goes_on = F.col(f"_step{i}") & (F.col("_part") == 0)
            if i > j + 1:
                goes_on = goes_on & F.coalesce(F.max(f"_carried{j}_{i - 1}").over(earlier), F.lit(False))
            rows = rows.withColumn(name, goes_on)
            carried[name] = F.max(name).alias(name)
    maps = rows.groupBy(*keys, BLOCK).agg(
        F.count_if("_stop").alias("_stops"), *[F.max(f"_reached{i}").alias(f"_reached{i}") for i in range(1, last)], *carried.values()
    )

    def state_after(state: Column, block: Column) -> Column:
        whole = block["_stops"] == 0
        entries = []
        for i in range(1, last):
            own = F.when(block[f"_reached{i}"]["part"] == block["_stops"], block[f"_reached{i}"]["start"])
            brought = [F.when(whole & block[f"_carried{j}_{i}"], state[f"s{j}"]) for j in range(1, i)]
            entries.append(reduce(_later, [F.when(whole, state[f"s{i}"]), *brought], own).alias(f"s{i}"))
        return F.struct(*entries)

    empty = F.struct(*[F.lit(None).cast(time).alias(f"s{i}") for i in range(1, last)])
    start = F.struct(empty.alias("state"), F.array().cast(f"array<struct<{BLOCK}:bigint,state:{_struct(last, time)}>>").alias("given"))

    def step(so_far: Column, block: Column) -> Column:
        return F.struct(
            state_after(so_far["state"], block).alias("state"),
            F.concat(so_far["given"], F.array(F.struct(block[BLOCK].alias(BLOCK), so_far["state"].alias("state")))).alias("given"),
        )

    # A key has one map per block: as many as its rows divided by the rows of a block.
    of_key = maps.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(BLOCK, *[c for c in maps.columns if c not in (*keys, BLOCK)]))).alias("maps"))
    found = of_key.select(*keys, F.explode(F.aggregate("maps", start, step, lambda s: s["given"])).alias("x"))
    return found.select(
        *keys, F.col(f"x.{BLOCK}").alias(BLOCK), F.lit(-1).cast("long").alias(POSITION), *[F.col(f"x.state.s{i}").alias(f"_given{i}") for i in range(1, last)]
    )


def _later(a: Column, b: Column) -> Column:
    """The later of two times, of which either may be missing."""
    return F.greatest(a, b)


def _struct(last: int, time) -> str:
    return "struct<" + ",".join(f"s{i}:{time.simpleString()}" for i in range(1, last)) + ">"
