"""Kept totals against recomputation, bucketed joins without a shuffle, and hops against a plain search."""

from __future__ import annotations

import random
from collections import Counter, defaultdict, deque

import pytest
from pyspark.sql import functions as F

from tallymill.operators.hops import hops
from tallymill.operators.layouts import bucketed
from tallymill.operators.upkeep import CHANGE, KeptTotals
from tallymill.plans import QUERIES
from tallymill.session import scratch_path
from tests.conftest import SMALL
from tests.test_plans import plan

ROW = f"part int, k string, amount long, {CHANGE} int"


def kept(spark):
    return KeptTotals(spark, scratch_path(spark, "kept"), "part", ["k"], {"total": F.col("amount")})


def state(table):
    return {(r.part, r.k): (r.n_rows, r.total) for r in table.table().collect()}


def files(spark, table):
    return {f.split("part=")[1].split("/")[0]: f for f in spark.read.parquet(table.path).inputFiles()}


def test_kept_totals_equal_recomputation_after_every_batch(spark):
    draw, table = random.Random(4), kept(spark)
    rows, expected = [], {}
    for batch in range(1, 5):
        added = [(draw.choice([1, 2, 3, batch]), draw.choice(["a", "b", None]), draw.randrange(-5, 50)) for _ in range(30)]
        gone = draw.sample(rows, len(rows) // 2)
        changes = spark.createDataFrame([(*r, 1) for r in added] + [(*r, -1) for r in gone], ROW)
        table.apply(changes, batch)
        rows = list((Counter(rows) + Counter(added) - Counter(gone)).elements())
        counted = defaultdict(lambda: [0, 0])
        for part, k, amount in rows:
            counted[part, k][0] += 1
            counted[part, k][1] += amount
        expected = {key: tuple(v) for key, v in counted.items()}
        assert state(table) == expected
        table.apply(changes, batch)  # again
        assert state(table) == expected


def test_only_touched_partitions_are_rewritten(spark):
    table = kept(spark)
    table.apply(spark.createDataFrame([(p, "a", 1, 1) for p in (1, 2, 3)], ROW), 1)
    before = files(spark, table)
    table.apply(spark.createDataFrame([(2, "a", 5, 1), (4, "z", 7, 1)], ROW), 2)
    after = files(spark, table)
    assert {p for p in after if after[p] != before.get(p)} == {"2", "4"}
    assert state(table) == {(1, "a"): (1, 1), (2, "a"): (2, 6), (3, "a"): (1, 1), (4, "z"): (1, 7)}


def test_a_batch_that_stopped_half_way_can_be_applied_again(spark):
    table = kept(spark)
    table.apply(spark.createDataFrame([(1, "a", 1, 1), (2, "a", 1, 1)], ROW), 1)
    changes = [(1, "a", 10, 1), (2, "a", 20, 1)]
    table.apply(spark.createDataFrame(changes[:1], ROW), 2)  # as if partition 2 had not been reached
    table.apply(spark.createDataFrame(changes, ROW), 2)
    assert state(table) == {(1, "a"): (2, 11), (2, "a"): (2, 21)}
    table.apply(spark.createDataFrame([], ROW), 3)
    table.apply(spark.createDataFrame([(2, "a", 20, -1), (2, "a", 1, -1)], ROW), 4)
    assert state(table) == {(1, "a"): (2, 11)}
    with pytest.raises(Exception, match="part is null"):
        table.apply(spark.createDataFrame([(None, "a", 1, 1)], ROW), 5)


def test_bucketed_joins_move_no_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["bucketed_joins"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_a_bucket_is_one_file(spark):
    table = bucketed(spark.range(0, 5000, 1, 6).withColumn("v", F.col("id") * 2), "id", ["id", "v"], 8)
    assert len(table.inputFiles()) == 8 and table.agg(F.sum("v")).first()[0] == 4999 * 5000


def plain_hops(edges, starts):
    around = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            around[a].add(b)
            around[b].add(a)
    found, waiting = {s: 0 for s in starts}, deque(starts)
    while waiting:
        node = waiting.popleft()
        for other in around[node] - found.keys():
            found[other] = found[node] + 1
            waiting.append(other)
    return found


@pytest.mark.parametrize("starts", [[0], [0, 41, 999], []])
def test_hops(spark, starts):
    draw = random.Random(9)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 112)] + [(0, 100), (5, 5), (None, 3), (7, None)]
    edges += [(300, i) for i in range(301, 330)] + edges[:5]
    df = spark.createDataFrame(edges, "x long, y long").repartition(4)
    nodes = spark.createDataFrame([(s,) for s in starts] + [(None,)], "node long")
    expected = plain_hops(edges, starts)
    assert {r.node: r.hops for r in hops(df, "x", "y", nodes).collect()} == expected
    near = {r.node: r.hops for r in hops(df, "x", "y", nodes, most=2).collect()}
    assert near == {n: h for n, h in expected.items() if h <= 2}
