"""Python functions for the cases the built-in ones do not cover."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udtf

from tallymill.operators.sessions import micros


@arrow_udtf(returnType="order_key long, box int, n_lines int, quantity double")
class Boxes:
    """Table function over rows (order key, quantity, capacity), dealt by order and sorted by order: what goes into which box.

    A line goes into the box that is open if it still fits, else that box is closed and
    the line opens the next one; a line above the capacity has a box of its own. Each box
    depends on all before it. Rows come as Arrow batches that know nothing of orders, and
    the open box is kept from batch to batch, so an order of any length needs no memory.
    Lines without a quantity are not packed.
    """

    def __init__(self) -> None:
        self._order, self._box, self._lines, self._fill = None, 0, 0, 0.0

    def eval(self, lines: pa.RecordBatch) -> Iterator[pa.Table]:
        lines = lines.filter(lines.column(1).is_valid())
        order, box, n_lines, fill = self._order, self._box, self._lines, self._fill
        closed = []
        for this, quantity, capacity in zip(*map(self._values, lines.columns)):
            if n_lines:
                if this == order and not fill + quantity > capacity:
                    n_lines, fill = n_lines + 1, fill + quantity
                    continue
                closed.append((order, box, n_lines, fill))
            box = box + 1 if this == order else 1
            order, n_lines, fill = this, 1, 0.0 + quantity
        self._order, self._box, self._lines, self._fill = order, box, n_lines, fill
        yield self._table(closed)

    def terminate(self) -> Iterator[pa.Table]:
        if self._lines:
            yield self._table([(self._order, self._box, self._lines, self._fill)])

    def _values(self, column: pa.Array) -> list:
        return column.to_pylist() if column.null_count else column.to_numpy().tolist()

    def _table(self, closed: list[tuple]) -> pa.Table:
        columns = zip(*closed) if closed else [()] * 4
        types = {"order_key": pa.int64(), "box": pa.int32(), "n_lines": pa.int32(), "quantity": pa.float64()}
        return pa.table([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def circular_means(df: DataFrame, keys: Sequence[str], time: str, period_seconds: int) -> DataFrame:
    """Mean direction of times on a circle, such as the time of day, per key, with partial states in Python.

    A grouped Pandas UDF would move every row of a key to one worker. Instead each
    Arrow batch is reduced to one state row per key where it is read: the sum of
    the unit vectors, as a complex number, and their count. Spark adds the states
    up. NULL times are ignored.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch[batch["_t"].notna()]
            turn = np.exp(2j * np.pi * (known["_t"].to_numpy() % period_seconds) / period_seconds)
            state = pd.DataFrame({**{k: known[k] for k in keys}, "x": turn.real, "y": turn.imag, "n": 1})
            yield state.groupby(list(keys), dropna=False, as_index=False).sum()

    partial = df.select(*keys, (micros(time) / 1e6).alias("_t")).mapInPandas(states, f"{fields}, x double, y double, n long")
    return partial.groupBy(*keys).agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum("n").alias("n_values")).select(
        *keys,
        (F.pmod(F.atan2("y", "x") / (2 * math.pi), F.lit(1.0)) * period_seconds).alias("mean_seconds"),
        (F.hypot("x", "y") / F.col("n_values")).alias("concentration"),
        "n_values",
    )
