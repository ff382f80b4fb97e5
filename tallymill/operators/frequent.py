"""Values that make up a given share of a table, without shuffling the rare ones.

Each task keeps a bounded summary of what it reads, after Misra and Gries: the counts of
a number of values, which fall short of the true ones by at most a known error. A value
that makes up the share must be in some summary, and its summed counts and errors reach
the share; at most a bounded number of values does. Those are candidates, and a second
pass counts them exactly. All rare values stay in the tasks that read them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallymill.session import written

#: Counters of a summary for each value that can make up the share.
SPARE = 10


def _pruned(counts: Counter, most: int) -> tuple[Counter, int]:
    """The largest counts less that of the first one that is left out, which is the error made."""
    if len(counts) <= most:
        return counts, 0
    cut = sorted(counts.values(), reverse=True)[most]
    return Counter({value: n - cut for value, n in counts.items() if n > cut}), cut


def frequent(df: DataFrame, values: Column, share: float) -> DataFrame:
    """(``value``, ``n``): the elements of the string arrays ``values`` that make up at least ``share`` of all of them.

    Null arrays and elements do not count. At most 1 / ``share`` values can do so, and the
    candidates that are broadcast are no more than twice as many.
    """
    if not 0 < share <= 1:
        raise ValueError("a share lies between 0 and 1")
    most = int(SPARE / share) + 1
    rows = df.select(F.filter(values, lambda v: v.isNotNull()).alias("v"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        total = error = 0
        for batch in batches:
            seen = pc.value_counts(batch.column("v").flatten())
            total += sum(seen.field("counts").to_pylist())
            counts.update(dict(zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist())))
            counts, cut = _pruned(counts, most)
            error += cut
        # The row without a value has the task's total and error.
        columns = [pa.array([None, *counts], pa.string()), pa.array([total, *counts.values()], pa.int64()), pa.array([error, *[0] * len(counts)], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["value", "n", "error"])

    summaries = rows.mapInArrow(summed, "value string, n long, error long").groupBy("value").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))
    summaries = written(summaries, "summaries")
    whole = summaries.filter("value IS NULL").select(F.col("n").alias("total"), F.col("error").alias("missed")).first()
    total, missed = (whole["total"], whole["missed"]) if whole else (0, 0)
    candidates = written(summaries.filter(F.col("value").isNotNull() & (F.col("n") + missed >= share * total)).select("value"), "candidates")
    counted = rows.select(F.explode("v").alias("value")).join(F.broadcast(candidates), "value").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= share * total)
