"""Ordered windows for keys of any size.

A window partitioned by a key puts the whole key in one task. That is fine for
small keys and hopeless for a key holding a third of the table. ``lay_out``
removes the dependence on key sizes: it range-sorts the whole table by
``keys + order``, numbers the rows, and cuts the numbering into blocks of equal
length. Windows then run per (key, block), and what crosses a block edge is
added on top:

* a bounded number of neighbour rows is copied over the edge (``with_halo``);
* what a key's earlier or later blocks amount to is worked out from one summary
  row per block and handed to the rows of each block (``attach``, ``running``).

Sorting costs a written table, so ``find_large`` counts the rows of each key
first. Keys that fit a task keep the native window; only the rows of the others
are laid out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F
from pyspark.sql.types import DecimalType, IntegralType, NullType

from tallymill.session import written

POSITION = "_position"
BLOCK = "_block"
SEAT = "_seat"

# Keys up to this many rows are windowed natively.
GROUP_ROWS = 4_000_000
# Rows per block once a table is laid out.
BLOCK_ROWS = 1_000_000

# monotonically_increasing_id: partition number above bit 33, row number below.
_ROW_BITS = 33


@dataclass(frozen=True)
class Large:
    """Which keys are too large for a task: none, some (``table``) or all of them."""

    keys: Sequence[str]
    table: DataFrame | None = None
    every: bool = False
    rows: int | None = field(default=None, compare=False)

    @property
    def some(self) -> bool:
        return self.every or self.table is not None

    def parts(self, df: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """The rows of keys that fit and the rows of keys that do not."""
        if self.every:
            return None, df
        if self.table is None:
            return df, None
        listed, same = _matched(self.table, self.keys)
        return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")

    def apply(
        self,
        df: DataFrame,
        native: Callable[[DataFrame], DataFrame],
        blocked: Callable[[DataFrame], DataFrame],
    ) -> DataFrame:
        fitting, oversized = self.parts(df)
        if oversized is None:
            return native(fitting)
        if fitting is None:
            return blocked(oversized)
        return native(fitting).unionByName(blocked(oversized))


def find_large(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> Large:
    """Keys of more than ``group_rows`` rows. Reads only the key columns.

    There are at most (rows / group_rows) of them. They are written, so that
    Spark knows the size of the list when it decides how to join it.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    over = F.col("_rows") > group_rows
    # The oversized keys are written as they are counted; two numbers tell the rest.
    seen = Observation()
    listed = written(
        sizes.observe(seen, F.count_if(over).alias("some"), F.count(F.lit(1)).alias("every")).filter(over), "large-keys"
    )
    some, every = seen.get["some"], seen.get["every"]
    if some == 0:
        return Large(keys)
    rows = listed.agg(F.sum("_rows")).first()[0]
    if some == every:
        return Large(keys, every=True, rows=rows)
    return Large(keys, listed.select(*keys), rows=rows)


def lay_out(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block_rows: int = BLOCK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Add the row's place in the sort by ``keys + order`` and its block.

    ``order`` should identify a row within its key; ties are placed arbitrarily
    but only once, because the placement is written before it is used. ``rows``,
    if they have been counted, gives every range about as many rows as a block.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // BLOCK_ROWS))
    by = [F.col(k) for k in keys] + list(order)
    placed = written(
        df.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("_laid_at", F.monotonically_increasing_id()),
        "layout",
    ).withColumn("_laid_part", F.shiftright("_laid_at", _ROW_BITS))
    # One row per range partition, so both the single-task window and the
    # broadcast are bounded by the number of partitions.
    earlier = W.partitionBy(F.lit(0)).orderBy("_laid_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_laid_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_laid_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_laid_start"))
    )
    row = F.col("_laid_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_laid_part")
        .withColumn(POSITION, F.col("_laid_start") + row)
        .withColumn(BLOCK, F.expr(f"{POSITION} div {block_rows}"))
        .drop("_laid_part", "_laid_start", "_laid_at")
    )


def with_halo(laid_out: DataFrame, before: int, after: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Copy edge rows into the neighbouring blocks.

    Each block of the result (column ``_seat``) also has the ``before`` rows
    ahead of it and the ``after`` rows behind it, which may be those of several
    blocks. Rows at home satisfy ``_seat = _block``.
    """
    first = F.expr(f"greatest({POSITION} - {after}, 0) div {block_rows}")
    last = F.expr(f"({POSITION} + {before}) div {block_rows}")
    return laid_out.withColumn(SEAT, F.explode(F.sequence(first, last)))


def block_window(keys: Sequence[str], block: str = BLOCK):
    return W.partitionBy(*keys, block).orderBy(POSITION)


def attach(rows: DataFrame, blocks: DataFrame, keys: Sequence[str], block: str = BLOCK) -> DataFrame:
    """Give every row the columns of its block's row in ``blocks``.

    The block's row travels along with the rows, in front of them, and is read
    by a window. Unlike a join this leaves the rows partitioned and sorted for
    the block windows that follow, so they move once, and NULL keys need no
    special care.
    """
    ids = [*keys, block]
    info = [c for c in blocks.columns if c not in ids]
    header = blocks.select(*ids, F.lit(-1).cast("long").alias(POSITION), F.struct(*info).alias("_info"))
    up_to_here = block_window(keys, block).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.unionByName(header, allowMissingColumns=True)
        .withColumn("_info", F.first("_info", ignorenulls=True).over(up_to_here))
        .filter(F.col(POSITION) >= 0)
        .select(*rows.columns, "_info.*")
    )


@dataclass(frozen=True)
class Running:
    """A running value: the sum, or the last known value, up to each row."""

    name: str
    value: Column
    sums: bool

    def over(self, window, value: Column | None = None) -> Column:
        value = self.value if value is None else value
        return F.sum(value).over(window) if self.sums else F.last(value, ignorenulls=True).over(window)

    def of_block(self) -> Column:
        if self.sums:
            return F.sum(self.value)
        return F.max_by(self.value, F.when(self.value.isNotNull(), F.col(POSITION)))


def total(name: str, value: Column) -> Running:
    """Sum of ``value`` up to and including the row. ``running`` raises unless it is an integer or decimal."""
    return Running(name, value, sums=True)


def latest(name: str, value: Column) -> Running:
    """Last non-null ``value`` up to and including the row."""
    return Running(name, value, sums=False)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Sequence[Running],
    large: Large,
    block_rows: int = BLOCK_ROWS,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Add running values per key, in ``order``.

    ``finish`` is applied to the native and the blocked part before they are
    united. Fields of structs must be taken out there: Spark 4.1 can mix them up
    when it prunes a struct on both sides of a union.
    """

    summed = df.select(*[v.value.alias(v.name) for v in values if v.sums]).schema
    rough = [f.name for f in summed if not isinstance(f.dataType, (IntegralType, DecimalType, NullType))]
    if rough:
        # Floating-point sums depend on the order of adding, so the two forms would differ.
        raise TypeError(f"running totals must be integers or decimals: {', '.join(rough)}")

    def native(rows: DataFrame) -> DataFrame:
        window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return finish(rows.withColumns({v.name: v.over(window) for v in values}))

    def blocked(rows: DataFrame) -> DataFrame:
        return finish(_running_by_block(rows, keys, order, values, block_rows, large.rows))

    return large.apply(df, native, blocked)


def _running_by_block(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[Running], block_rows: int,
    counted: int | None,
) -> DataFrame:
    """The running value of the blocks before goes in front of each block as one more row."""
    # The values become columns before the layout is written, so that the rows
    # that stand for earlier blocks can be added to them.
    valued = df.withColumns({v.name: v.value for v in values})
    laid_out = lay_out(valued, keys, order, block_rows, counted)
    values = [Running(v.name, F.col(v.name), v.sums) for v in values]
    # One row per key and block: a key of n rows has about n / block_rows of them.
    earlier = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    blocks = laid_out.groupBy(*keys, BLOCK).agg(*[v.of_block().alias(v.name) for v in values])
    header = blocks.select(
        *keys, BLOCK, F.lit(-1).cast("long").alias(POSITION), *[v.over(earlier).alias(v.name) for v in values]
    )
    up_to_here = block_window(keys).rowsBetween(W.unboundedPreceding, 0)
    return (
        laid_out.unionByName(header, allowMissingColumns=True)
        .withColumns({v.name: v.over(up_to_here) for v in values})
        .filter(F.col(POSITION) >= 0)
        .drop(POSITION, BLOCK)
    )


def match_rows(df: DataFrame, per_group: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Attach one row per group to the rows of the group; NULL ids match NULL."""
    renamed, same = _matched(per_group, ids)
    return df.join(renamed, same).drop(*[f"_r_{c}" for c in ids])


def _matched(right: DataFrame, ids: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its ids renamed, and the condition that they equal the left ones."""
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in ids])
    return right.withColumnsRenamed({c: f"_r_{c}" for c in ids}), same
