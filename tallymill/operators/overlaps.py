"""Overlaps of two tables of intervals that share no key.

Intervals are half open: [start, end). One sweep over all endpoints, cut into blocks of
equal row count, tells every interval how many intervals of the other table have started
or ended before its own start and end; the counts of intervals still open are carried
over block edges. Nothing is compared pair by pair:

* ``overlap_totals`` takes number and length of the overlaps as differences of running
  totals, so an interval that spans everything costs as much as any other;
* ``overlap_join`` lists the pairs. If the starts of one table are numbered in order,
  those that fall into an interval of the other table are a range of numbers. Two
  intervals overlap if the later one starts inside the other, which gives each pair
  once. A range meets the numbered starts block by block, on equal block numbers, and
  every copy of a range made for that is part of at least one pair of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.operators.layout import BLOCK_ROWS, Large, running, total
from tallymill.session import written

#: Starts of one table that are joined with the ranges of the other as one block.
PAIR_ROWS = 4096

# At one instant intervals end before others start; those of the right table start first.
_END, _RIGHT_START, _LEFT_START = 0, 1, 2

# Many long overlaps add up to more than a long integer holds.
_LENGTH = "decimal(38,0)"

Span = tuple[str, str]


def _numbered(df: DataFrame, span: Span, label: str) -> DataFrame:
    """The rows whose interval is not empty, numbered; written, so that the numbers stay."""
    start, end = map(F.col, span)
    return written(df.filter(start < end).withColumn("_row", F.monotonically_increasing_id()), label)


def _marks(df: DataFrame, span: Span, left: bool) -> DataFrame:
    """Two rows per interval: where it starts and where it ends."""
    start, end = map(F.col, span)
    edges = F.array(
        F.struct(start.alias("at"), F.lit(_LEFT_START if left else _RIGHT_START).alias("edge")),
        F.struct(end.alias("at"), F.lit(_END).alias("edge")),
    )
    marks = df.select("_row", F.lit(left).alias("left"), F.explode(edges).alias("m"))
    return marks.select("_row", "left", "m.at", "m.edge")


def _sweep(left: DataFrame, right: DataFrame, left_span: Span, right_span: Span, values, block_rows: int) -> DataFrame:
    marks = _marks(left, left_span, True).unionByName(_marks(right, right_span, False))
    order = [F.col("at"), F.col("edge"), F.col("left"), F.col("_row")]
    # There is no key, so the whole table is one group and always laid out in blocks.
    return running(marks, [], order, values, Large([], every=True), block_rows)


def overlap_totals(
    left: DataFrame, right: DataFrame, left_span: Span, right_span: Span, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``left`` with ``n_overlaps`` and ``overlap``: how many intervals of ``right`` overlap a row's, and for how long in all.

    Ends are integers, such as microseconds. Intervals that are empty, or have a null
    end, overlap nothing; such rows of ``left`` have zeros.
    """
    number = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")
    amount = lambda c: F.when(c, F.col("at")).otherwise(F.lit(0)).cast("decimal(19,0)")
    starts, ends = ~F.col("left") & (F.col("edge") == _RIGHT_START), ~F.col("left") & (F.col("edge") == _END)
    rows = written(left.withColumn("_row", F.monotonically_increasing_id()), "left-intervals")
    swept = _sweep(
        rows.filter(F.col(left_span[0]) < F.col(left_span[1])), _numbered(right, right_span, "right-intervals"), left_span, right_span,
        [total("_opened", number(starts)), total("_closed", number(ends)), total("_starts", amount(starts)), total("_ends", amount(ends))],
        block_rows,
    )
    at_end = F.col("edge") == _END
    opened = (F.col("_opened") - F.col("_closed")).cast("decimal(18,0)")
    # How long intervals have been open in all, up to here.
    so_far = F.col("at").cast("decimal(19,0)") * opened - (F.col("_starts") - F.col("_ends"))
    found = swept.filter("left").groupBy("_row").agg(
        (F.max(F.when(at_end, F.col("_opened"))) - F.max(F.when(~at_end, F.col("_closed")))).alias("n_overlaps"),
        (F.max(F.when(at_end, so_far)) - F.max(F.when(~at_end, so_far))).cast(_LENGTH).alias("overlap"),
    )
    return rows.join(found, "_row", "left").select(
        *left.columns, F.coalesce("n_overlaps", F.lit(0)).alias("n_overlaps"), F.coalesce("overlap", F.lit(0).cast(_LENGTH)).alias("overlap")
    )


def overlap_join(
    left: DataFrame, right: DataFrame, left_span: Span, right_span: Span, block_rows: int = BLOCK_ROWS, pair_rows: int = PAIR_ROWS
) -> DataFrame:
    """Each pair of overlapping intervals: the columns of ``left`` and, after ``right_``, those of ``right``.

    Ends may be of any ordered type, the same for both tables. Empty intervals, and
    those with a null end, overlap nothing.
    """
    sides = [_numbered(left, left_span, "left-intervals"), _numbered(right, right_span, "right-intervals")]
    is_left_start, is_right_start = F.col("edge") == _LEFT_START, F.col("edge") == _RIGHT_START
    number = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")
    swept = _sweep(*sides, left_span, right_span, [total("_lefts", number(is_left_start)), total("_rights", number(is_right_start))], block_rows)
    at_end = F.col("edge") == _END
    own, other = F.when(F.col("left"), F.col("_lefts")).otherwise(F.col("_rights")), F.when(F.col("left"), F.col("_rights")).otherwise(F.col("_lefts"))
    ranges = written(
        swept.groupBy("left", "_row").agg(
            # The number of the interval's start, and the range of the other table's starts that lie inside it.
            (F.max(F.when(~at_end, own)) - 1).alias("_place"), F.max(F.when(~at_end, other)).alias("_low"), F.max(F.when(at_end, other)).alias("_high"),
        ),
        "ranges",
    )
    rows = [side.join(ranges.filter(F.col("left") == (i == 0)).drop("left"), "_row").drop("_row") for i, side in enumerate(sides)]
    renamed = [
        r.select(*[F.col(c).alias(prefix + c) for c in names], "_place", "_low", "_high")
        for r, names, prefix in zip(rows, (left.columns, right.columns), ("", "right_"))
    ]
    columns = [*left.columns, *[f"right_{c}" for c in right.columns]]
    return _met(renamed[0], renamed[1], pair_rows).select(columns).unionByName(_met(renamed[1], renamed[0], pair_rows).select(columns))


def _met(inside: DataFrame, around: DataFrame, pair_rows: int) -> DataFrame:
    """The rows of ``inside`` whose start lies in the interval of a row of ``around``."""
    block = lambda c: F.expr(f"({c}) div {pair_rows}")
    starts = inside.drop("_low", "_high").withColumn("_block", block("_place"))
    copies = around.filter("_low < _high").drop("_place").withColumn("_block", F.explode(F.sequence(block("_low"), block("_high - 1"))))
    return starts.join(copies, "_block").filter("_place >= _low AND _place < _high")
