"""The table function that packs lines, against packing them one by one."""

from __future__ import annotations

import math
import random

import pytest

from tallymill.functions.udfs import Boxes
from tallymill.plans import QUERIES
from tallymill.session import settings
from tests.conftest import SMALL
from tests.test_plans import plan


def packed(rows, capacity=60.0):
    result = []
    for order in {o for o, _ in rows}:
        box, n_lines, fill = 0, 0, 0.0
        for quantity in sorted((q for o, q in rows if o == order and q is not None), key=lambda q: math.inf if math.isnan(q) else q, reverse=True):
            if n_lines and fill + quantity > capacity:
                result.append((order, box, n_lines, fill))
                n_lines, fill = 0, 0.0
            box, n_lines, fill = box + (not n_lines), n_lines + 1, fill + quantity
        if n_lines:
            result.append((order, box, n_lines, fill))
    return sorted(map(repr, result))


@pytest.mark.parametrize("size", ["1", "3", "10000"])
def test_orders_longer_than_a_batch(spark, tmp_path, size):
    draw = random.Random(2)
    rows = [(draw.choice([None, 1, 1, 1, 0, *range(2, 30)]), draw.choice([None, float(draw.randrange(1, 51)), 75.5])) for _ in range(300)]
    rows += [(50, None), (51, math.nan), (51, 1.0), (52, 60.0), (52, 60.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_quantity double").repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": size}):
        found = [tuple(r) for r in QUERIES["udtf"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, found)) == packed(rows)


def test_lines_of_many_orders_pass_in_one_call(spark):
    spark.udtf.register("boxes", Boxes)
    text = plan(QUERIES["udtf"](spark, SMALL))
    assert "ArrowEvalPythonUDTF" in text
    # Rows dealt and sorted by order, without a column for the function to be called anew at each order.
    assert "partition_by_" not in text and "Exchange hashpartitioning(l_orderkey" in text
