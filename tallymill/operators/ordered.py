"""Ranks, neighbours, moving frames and exact percentiles per key.

Each function has the native window for keys that fit a task and the laid-out
form of ``layout`` for keys that do not. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.operators.layout import (
    BLOCK,
    BLOCK_ROWS,
    GROUP_ROWS,
    POSITION,
    SEAT,
    Large,
    attach,
    block_window,
    find_large,
    lay_out,
    match_rows,
    running,
    total,
    with_halo,
)
from tallymill.session import written


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    tie_break: Sequence[str],
    tiles: int = 4,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rank family of ``by`` within ``keys``.

    ``row_number`` and ``ntile`` follow ``by`` then ``tie_break``; the others
    treat equal values of ``by`` as peers.
    """
    full = [F.col(by)] + [F.col(c) for c in tie_break]

    def native(part: DataFrame) -> DataFrame:
        peers = W.partitionBy(*keys).orderBy(by)
        rows = W.partitionBy(*keys).orderBy(*full)
        return part.withColumns(
            {
                "row_number": F.row_number().over(rows).cast("long"),
                "rank": F.rank().over(peers).cast("long"),
                "dense_rank": F.dense_rank().over(peers).cast("long"),
                "ntile": F.ntile(tiles).over(rows),
                "percent_rank": F.percent_rank().over(peers),
                "cume_dist": F.cume_dist().over(peers),
            }
        )

    def blocked(part: DataFrame) -> DataFrame:
        return _ranks_by_block(lay_out(part, keys, full, block_rows, large.rows), df.columns, keys, by, tiles)

    large = find_large(df, keys, group_rows)
    return large.apply(df, native, blocked)


def _ranks_by_block(
    laid_out: DataFrame, columns: Sequence[str], keys: Sequence[str], by: str, tiles: int
) -> DataFrame:
    rows = block_window(keys)
    peers = W.partitionBy(*keys, BLOCK).orderBy(by)
    local = attach(laid_out, _block_shape(laid_out, keys, by), keys).withColumns(
        {
            "_row": F.row_number().over(rows),
            "_rank": F.rank().over(peers),
            "_dense": F.dense_rank().over(peers),
            # The default frame ends with the last peer, so this counts up to it.
            "_end": F.count(F.lit(1)).over(peers),
        }
    )
    first_run = F.col("_joins_prev") & F.col(by).eqNullSafe(F.col("_first"))
    last_run = F.col("_joins_next") & F.col(by).eqNullSafe(F.col("_last"))
    row = F.col("_before") + F.col("_row")
    rank = F.when(first_run, F.col("_run_start")).otherwise(F.col("_before") + F.col("_rank"))
    end = F.when(last_run, F.col("_run_end")).otherwise(F.col("_before") + F.col("_end"))
    size = F.col("_size")
    # The first size % tiles tiles are one row longer than the rest.
    short = F.expr(f"_size div {tiles}")
    in_long = size % tiles * (short + 1)
    tile = F.when(row <= in_long, F.ceil(row / (short + 1))).otherwise(
        size % tiles + F.ceil((row - in_long) / F.greatest(short, F.lit(1)))
    )
    return local.select(
        *columns,
        row.alias("row_number"),
        rank.alias("rank"),
        (F.col("_dense_before") + F.col("_dense")).alias("dense_rank"),
        tile.cast("int").alias("ntile"),
        F.when(size == 1, F.lit(0.0)).otherwise((rank - 1) / F.greatest(size - 1, F.lit(1))).alias("percent_rank"),
        (end / size).alias("cume_dist"),
    )


def _block_shape(laid_out: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """One row per (key, block): what precedes it and where runs of equal values go."""
    runs = laid_out.groupBy(*keys, BLOCK, F.col(by).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(POSITION).alias("_at")
    )
    # As structs, so that a NULL value can still be the first or last one.
    ends = F.struct("_v", "_n")
    blocks = (
        runs.groupBy(*keys, BLOCK)
        .agg(
            F.sum("_n").alias("_n"),
            F.count(F.lit(1)).alias("_values"),
            F.min_by(ends, "_at").alias("_head"),
            F.max_by(ends, "_at").alias("_tail"),
        )
        .withColumns({"_first": F.col("_head._v"), "_last": F.col("_tail._v")})
    )
    at = W.partitionBy(*keys).orderBy(BLOCK)
    earlier = at.rowsBetween(W.unboundedPreceding, -1)
    upto = at.rowsBetween(W.unboundedPreceding, 0)
    onwards = at.rowsBetween(0, W.unboundedFollowing)
    blocks = blocks.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "_size": F.sum("_n").over(W.partitionBy(*keys)),
            "_joins_prev": F.lag("_n").over(at).isNotNull()
            & F.col("_first").eqNullSafe(F.lag("_last").over(at)),
            "_joins_next": F.lead("_n").over(at).isNotNull()
            & F.col("_last").eqNullSafe(F.lead("_first").over(at)),
        }
    )
    # A run of equal values may cover many blocks: take its start from the block
    # where it begins and its end from the block where it stops.
    one_value = F.col("_values") == 1
    begins = F.when(
        ~(F.col("_joins_prev") & one_value), F.col("_before") + F.col("_n") - F.col("_tail._n") + 1
    )
    stops = F.when(~(F.col("_joins_next") & one_value), F.col("_before") + F.col("_head._n"))
    blocks = blocks.withColumns({"_begins": begins, "_stops": stops}).withColumns(
        {
            "_tail_start": F.last("_begins", ignorenulls=True).over(upto),
            "_head_end": F.first("_stops", ignorenulls=True).over(onwards),
            "_dense_before": F.coalesce(F.sum("_values").over(earlier), F.lit(0))
            - F.sum(F.col("_joins_prev").cast("long")).over(upto),
        }
    )
    return blocks.select(
        *keys, BLOCK, "_before", "_size", "_first", "_last", "_joins_prev", "_joins_next", "_dense_before",
        F.lag("_tail_start").over(at).alias("_run_start"),
        F.lead("_head_end").over(at).alias("_run_end"),
    )


@dataclass(frozen=True)
class Near:
    """A window column and the rows it sees, ``first`` to ``last`` counted from its own row."""

    value: Column
    first: int
    last: int
    aggregate: bool

    def over(self, window) -> Column:
        if self.aggregate:
            return self.value.over(window.rowsBetween(self.first, self.last))
        return (F.lag(self.value, -self.first) if self.first <= 0 else F.lead(self.value, self.first)).over(window)


def neighbour(column: str, offset: int) -> Near:
    """The column's value ``offset`` rows ahead, or back if it is negative; NULL beyond the key's rows."""
    return Near(F.col(column), offset, offset, aggregate=False)


def frame(aggregate: Column, first: int, last: int) -> Near:
    """An aggregate over the rows from ``first`` to ``last``, counted from the current one, as in ROWS BETWEEN."""
    if first > last:
        raise ValueError("a frame must not end before it starts")
    if first <= W.unboundedPreceding or last >= W.unboundedFollowing:
        raise ValueError("a frame needs two bounds; running totals are those of layout.running")
    return Near(aggregate, first, last, aggregate=True)


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    near: Mapping[str, Near],
    nth: Mapping[str, tuple[str, int]] | None = None,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
    large: Large | None = None,
) -> DataFrame:
    """Window columns over the neighbours and the first rows of each key.

    ``near`` maps a name to a ``neighbour`` or a ``frame``; how many rows it looks
    back and ahead is read from there. ``nth`` maps a name to a column and a
    number n: the key's nth value, NULL on the rows before it. ``large`` are the
    keys too large for a task, if they have been found already.
    """
    nth = nth or {}
    before = max([-n.first for n in near.values()], default=0)
    after = max([n.last for n in near.values()], default=0)
    before, after = max(before, 0), max(after, 0)

    def native(part: DataFrame) -> DataFrame:
        window = W.partitionBy(*keys).orderBy(*order)
        return part.withColumns({name: n.over(window) for name, n in near.items()}).withColumns(
            {name: F.nth_value(c, n).over(window) for name, (c, n) in nth.items()}
        )

    def blocked(part: DataFrame) -> DataFrame:
        laid_out = lay_out(part, keys, order, block_rows, large.rows)
        seated = with_halo(laid_out, before, after, block_rows)
        if nth:
            # Copies that have no row of their key at home in the seat get nothing
            # attached; they are dropped below.
            seats = laid_out.groupBy(*keys, F.col(BLOCK).alias(SEAT)).agg(F.lit(True).alias("_one"))
            heads = match_rows(seats, _heads(laid_out, keys, nth), keys).drop("_one")
            seated = attach(seated, heads, keys, SEAT)
        window = block_window(keys, SEAT)
        return (
            seated.withColumns({name: n.over(window) for name, n in near.items()})
            .filter(F.col(SEAT) == F.col(BLOCK))
            .withColumns(
                {
                    name: F.when(F.col(POSITION) >= F.col("_key_start") + n - 1, F.col(f"_nth_{name}"))
                    for name, (_, n) in nth.items()
                }
            )
            .select(*df.columns, *near, *nth)
        )

    large = large or find_large(df, keys, group_rows)
    return large.apply(df, native, blocked)


def _heads(laid_out: DataFrame, keys: Sequence[str], nth: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Where each key starts and its nth values, one row per key.

    Filtering on ``row_number`` lets Spark keep only the first rows of each key
    in each task before the shuffle.
    """
    longest = max(n for _, n in nth.values())
    place = F.row_number().over(W.partitionBy(*keys).orderBy(POSITION))
    top = laid_out.withColumn("_place", place).filter(F.col("_place") <= longest)
    return top.groupBy(*keys).agg(
        F.min(POSITION).alias("_key_start"),
        *[
            F.max(F.when(F.col("_place") == n, F.struct(F.col(c).alias("v"))))["v"].alias(f"_nth_{name}")
            for name, (c, n) in nth.items()
        ],
    )


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Mapping[str, float],
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact interpolated percentiles per key; NULL values are ignored.

    Equal values are counted before the shuffle, and only running counts over
    the distinct values are needed. No task or driver holds all values of a key.
    """
    # The table is read once; limits, sizes and running counts come from the counted values.
    counts = written(
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n")),
        "counted-values",
    )
    large = find_large(counts, keys, group_rows)
    placed = running(counts, keys, [F.col("_v")], [total("_upto", F.col("_n"))], large, block_rows)
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    # Point p sits at place p * (size - 1), between two whole ranks. A value covers
    # the ranks from _upto - _n to _upto - 1; most values cover no wanted rank.
    wanted = F.array(
        *[
            F.struct(F.lit(n).alias("name"), (F.lit(float(p)) * (F.col("_size") - 1)).alias("at"))
            for n, p in points.items()
        ]
    )

    def covered(point: Column) -> Column:
        def holds(rank: Column) -> Column:
            return (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))

        return holds(F.floor(point["at"])) | holds(F.ceil(point["at"]))

    ends = (
        match_rows(placed, sizes, keys)
        .select(*keys, "_v", F.explode(F.filter(wanted, covered)).alias("_point"))
        .select(*keys, "_v", F.col("_point.name").alias("_name"), F.col("_point.at").alias("_at"))
        .groupBy(*keys, "_name", "_at")
        .agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    share = F.col("_at") - F.floor("_at")
    point = F.col("_low") * (1 - share) + F.col("_high") * share
    return ends.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, point)).alias(n) for n in points])
