"""Overlaps without a key, and sequences of events, against every pair and every row tried out."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallymill.operators.overlaps import overlap_join, overlap_totals
from tallymill.operators.patterns import sequences
from tests.test_plans import plan

SPAN = ("s", "e")


def intervals(draw, n, first):
    rows = []
    for i in range(n):
        start = draw.randrange(100)
        rows.append((first + i, draw.choice([start] * 9 + [None]), draw.choice([start + draw.choice([-1, 0, 1, 1, 2, 5, 20])] * 9 + [None])))
    # One that spans everything, and many at one instant.
    return rows + [(first + 500, -10, 1000)] + [(first + 600 + i, 50, 50 + 1 + i % 3) for i in range(25)]


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(2)
    both = [intervals(draw, 90, 0), intervals(draw, 70, 5000)]
    return both, [spark.createDataFrame(rows, "id long, s long, e long").repartition(3) for rows in both]


def pairs(left, right):
    full = lambda rows: [r for r in rows if None not in r and r[1] < r[2]]
    return [(a, b) for a in full(left) for b in full(right) if a[1] < b[2] and b[1] < a[2]]


@pytest.mark.parametrize("block_rows, pair_rows", [(1_000_000, 4096), (10, 4), (1, 1)])
def test_overlapping_pairs(tables, block_rows, pair_rows):
    (a, b), (left, right) = tables
    found = overlap_join(left, right, SPAN, SPAN, block_rows, pair_rows)
    assert found.columns == ["id", "s", "e", "right_id", "right_s", "right_e"]
    assert sorted(map(tuple, found.collect())) == sorted(x + y for x, y in pairs(a, b))


@pytest.mark.parametrize("block_rows", [1_000_000, 7])
def test_overlap_totals(tables, block_rows):
    (a, b), (left, right) = tables
    met = pairs(a, b)
    expected = []
    for row in a:
        mine = [y for x, y in met if x == row]
        expected.append((*row, len(mine), sum(min(row[2], y[2]) - max(row[1], y[1]) for y in mine)))
    found = overlap_totals(left, right, SPAN, SPAN, block_rows).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_overlaps_of_nothing(tables):
    left, right = tables[1]
    none = right.limit(0)
    assert overlap_join(left, none, SPAN, SPAN).collect() == [] and overlap_join(none, left, SPAN, SPAN).collect() == []
    assert overlap_totals(none, left, SPAN, SPAN).collect() == []
    rows = overlap_totals(left, none, SPAN, SPAN)
    assert rows.count() == left.count() and rows.filter("n_overlaps <> 0 OR overlap <> 0").count() == 0


def test_overlaps_meet_on_equal_blocks(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(overlap_join(*tables[1], SPAN, SPAN))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_very_long_sums_of_overlaps(spark):
    day = 86_400_000_000
    right = spark.range(20_000).select((F.col("id") * 7).alias("s"), (F.col("id") + 36_500 * day).alias("e"))
    left = spark.createDataFrame([(0, 40_000 * day)], "s long, e long")
    row = overlap_totals(left, right, SPAN, SPAN, 3000).first()
    assert (row.n_overlaps, row.overlap) == (20_000, sum(i + 36_500 * day - i * 7 for i in range(20_000)))


# --- sequences ------------------------------------------------------------------------------------


def tried(rows, steps, within, unless):
    """For each row the latest start of a sequence that ends there, by trying the last step before it and so on."""
    result = []
    users = {r[1] for r in rows}
    for user in users:
        mine = sorted((r for r in rows if r[1] == user and r[2] is not None), key=lambda r: (r[2], r[0]))
        for end, row in enumerate(mine):
            if row[3] != steps[-1]:
                continue
            places, step = {end}, len(steps) - 2
            first = max((i for i in range(end) if mine[i][3] in unless), default=-1) + 1
            while step >= 0 and places:
                upto = max(places)
                places = {i for i in range(first, upto) if mine[i][3] == steps[step]}
                step -= 1
            if places and row[2] - mine[max(places)][2] <= within:
                result.append((row[0], user, mine[max(places)][2]))
    return sorted(result, key=repr)


FORMS = [{}, {"group_rows": 1, "block_rows": 1}, {"group_rows": 1, "block_rows": 7}, {"group_rows": 40, "block_rows": 11}]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("steps, unless", [("abc", "x"), ("ab", "x"), ("aab", ""), ("abab", "x"), ("abca", "xy")])
def test_sequences(spark, steps, unless, form):
    import datetime as dt

    draw = random.Random(len(steps))
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, draw.choice([1, 1, 1, 2, 3, None]), draw.choice([start + dt.timedelta(minutes=draw.randrange(400))] * 20 + [None]), draw.choice("aaabbbcccxyzz\0"))
        for i in range(260)
    ]
    df = spark.createDataFrame([(i, u, t, None if k == "\0" else k) for i, u, t, k in rows], "id long, u long, t timestamp_ntz, kind string")
    stop = F.col("kind").isin(*unless) if unless else None
    found = sequences(df, ["u"], "t", "id", [F.col("kind") == s for s in steps], "75 MINUTES", stop, **form)
    assert found.columns == [*df.columns, "started"]
    got = sorted(((r.id, r.u, r.started) for r in found.collect()), key=repr)
    expected = tried(rows, steps, dt.timedelta(minutes=75), unless)
    assert expected and got == expected


def test_a_sequence_needs_two_steps(spark):
    with pytest.raises(ValueError):
        sequences(spark.range(1), ["id"], "id", "id", [F.lit(True)], "1 DAY")
