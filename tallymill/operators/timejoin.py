"""Joins and frames along a time axis without pairing rows.

All of them reduce to running values over one sorted pass, so the work grows
with the rows and never with the pairs inside a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, IntegralType, NullType

from tallymill.operators.layout import BLOCK_ROWS, GROUP_ROWS, Large, find_large, latest, match_rows, running, total

# Keys up to this many rows have their trailing frames added up one by one.
SPARSE_ROWS = 4096


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    tie_break: str,
    columns: Sequence[str],
    inclusive: bool = True,
    large: Large | None = None,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Each left row with ``columns`` of the latest right row at or before it.

    Both sides need ``keys``, ``time`` and ``tie_break``. Left rows without a
    match keep NULLs. ``inclusive=False`` asks for strictly earlier rows. Pass
    ``large`` if the keys too large for a task are known. A NULL key matches
    nothing, as with ``=``, unless ``null_safe`` is set.
    """
    if not null_safe:
        # Right rows with a NULL key can match nothing; without them left ones do not.
        right = right.dropna(subset=list(keys))
    right_side = right.select(
        *keys, time, tie_break, F.lit(False).alias("_left"), F.struct(*columns).alias("_found")
    )
    both = left.withColumn("_left", F.lit(True)).unionByName(right_side, allowMissingColumns=True)
    if large is None:
        large = find_large(both, keys, group_rows)
    # At equal times right rows go first if they count, last if they do not.
    side = F.col("_left") if inclusive else ~F.col("_left")
    order = [F.col(time), side, F.col(tie_break)]

    def left_rows(rows: DataFrame) -> DataFrame:
        matched = [F.col(f"_match.{c}").alias(f"right_{c}") for c in columns]
        return rows.filter("_left").select(*left.columns, *matched)

    return running(both, keys, order, [latest("_match", F.col("_found"))], large, block_rows, left_rows)


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    span: str,
    totals: Mapping[str, Column],
    include_now: bool = True,
    large: Large | None = None,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
    sparse_rows: int = SPARSE_ROWS,
) -> DataFrame:
    """Totals over the ``span`` of time up to each row, per key.

    The frame is ``[time - span, time]``, or ``[time - span, time)`` without
    ``include_now``. Keys of at most ``sparse_rows`` rows use Spark's own range frame,
    which adds up every frame anew. For the others rows of one instant are added up
    first; the total of a frame is then the difference of two running totals, one at
    each edge. Totals must be integers or decimals so that the difference is exact;
    others raise. A frame in which every value is NULL, or that has no rows, has a NULL
    total, as in SQL.
    """
    rough = [f.name for f in df.select(*[c.alias(n) for n, c in totals.items()]).schema if not isinstance(f.dataType, (IntegralType, DecimalType, NullType))]
    if rough:
        raise TypeError(f"trailing totals must be integers or decimals: {', '.join(rough)}")
    dense = find_large(df, keys, min(sparse_rows, group_rows // 2))

    def native(rows: DataFrame) -> DataFrame:
        valued = rows.withColumns({f"_value_{n}": c for n, c in totals.items()})
        length = "CAST(INTERVAL {} AS INTERVAL DAY TO SECOND) PRECEDING"
        last = "CURRENT ROW" if include_now else length.format("'0.000001' SECOND")
        by = ", ".join(f"`{k}`" for k in keys)
        frame = f"PARTITION BY {by} ORDER BY `{time}` RANGE BETWEEN {length.format(span)} AND {last}"
        return valued.select(*df.columns, *[F.expr(f"sum(`_value_{n}`) OVER ({frame})").alias(n) for n in totals])

    def counted(rows: DataFrame) -> DataFrame:
        found = _trailing_counted(rows, keys, time, span, totals, include_now, large, group_rows, block_rows)
        return found.select(*df.columns, *totals)

    return dense.apply(df, native, counted)


def _trailing_counted(
    df: DataFrame, keys: Sequence[str], time: str, span: str, totals: Mapping[str, Column], include_now: bool, large: Large | None,
    group_rows: int, block_rows: int,
) -> DataFrame:
    if large is None:
        # Each row makes at most two marks.
        large = find_large(df, keys, group_rows // 2)
    known = {f"_known_{n}": F.count(c) for n, c in totals.items()}
    sums = {n: F.coalesce(F.sum(c), F.lit(0)) for n, c in totals.items()}
    instants = df.groupBy(*keys, time).agg(*[c.alias(n) for n, c in {**sums, **known}.items()])
    # An opening edge sits before the rows of its own instant, a closing edge after.
    closes = F.col("_closes")
    marks = instants.withColumn("_closes", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn(
        "_edge", F.when(closes, F.col(time)).otherwise(F.expr(f"`{time}` - INTERVAL {span}"))
    )
    values = [total(f"_run_{n}", F.when(closes, F.col(n)).otherwise(F.lit(0))) for n in [*sums, *known]]
    run = running(marks, keys, [F.col("_edge"), closes, F.col(time)], values, large, block_rows)

    def framed(name: str) -> Column:
        at_close = F.max(F.when(closes, F.col(f"_run_{name}")))
        at_open = F.max(F.when(~closes, F.col(f"_run_{name}")))
        now = F.lit(0) if include_now else F.max(name)
        return at_close - at_open - now

    frames = run.groupBy(*keys, time).agg(
        *[F.when(framed(f"_known_{n}") > 0, framed(n)).alias(n) for n in totals]
    )
    return match_rows(df, frames, [*keys, time])
