"""Sketches within their error, and frequent values against counting all of them."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymill.operators import frequent as module
from tallymill.operators.frequent import frequent
from tallymill.operators.sketches import keep_days, over_days
from tallymill.session import scratch_path
from tests.test_plans import plan


@pytest.mark.parametrize("spare, share", [(10, 0.01), (1, 0.05), (1, 0.3), (10, 1.0)])
def test_frequent_values(spark, monkeypatch, spare, share):
    monkeypatch.setattr(module, "SPARE", spare)
    draw = random.Random(4)
    rows = [[draw.choice(["a", "b", f"c{draw.randrange(9)}", None, f"r{draw.randrange(5000)}", f"r{draw.randrange(5000)}"]) for _ in range(draw.randrange(0, 30))] for _ in range(800)]
    rows += [None, [], ["b"] * 400]
    df = spark.createDataFrame([(r,) for r in rows], "v array<string>").repartition(7)
    counts = Counter(v for r in rows if r for v in r if v is not None)
    total = sum(counts.values())
    found = {r.value: r.n for r in frequent(df, F.col("v"), share).collect()}
    assert found == {v: n for v, n in counts.items() if n >= share * total}
    assert frequent(df.limit(0), F.col("v"), share).collect() == []


def test_the_only_value_makes_up_all(spark):
    df = spark.createDataFrame([(["x", "x"],), (["x"],)], "v array<string>")
    assert [tuple(r) for r in frequent(df, F.col("v"), 1.0).collect()] == [("x", 3)]
    with pytest.raises(ValueError):
        frequent(df, F.col("v"), 0.0)


def test_rare_values_are_not_shuffled(spark):
    words = spark.range(0, 100_000, 1, 4).select(F.array(F.concat(F.lit("w"), F.col("id").cast("string")), F.lit("often")).alias("v"))
    found = frequent(words, F.col("v"), 0.1)
    text = plan(found)
    assert "BroadcastHashJoin" in text and text.index("partial_count") > text.index("Exchange")
    assert [tuple(r) for r in found.collect()] == [("often", 100_000)]


@pytest.fixture(scope="module")
def events(spark):
    start = dt.datetime(2024, 3, 1)
    rows = spark.range(0, 300_000, 1, 8).select(
        (F.hash("id") % 20_000).alias("user"), F.timestamp_add("MINUTE", (F.col("id") % 20_000).cast("int"), F.lit(start).cast("timestamp_ntz")).alias("at"),
        F.when(F.col("id") % 50 > 0, F.abs(F.hash("id", F.lit(1))) % 1000 + F.col("id") % 97).cast("double").alias("value"),
    )
    return rows.unionByName(spark.createDataFrame([(None, None, 1.0), (5, start, None)], "user int, at timestamp_ntz, value double"))


def test_spans_of_days_are_within_the_error(spark, events):
    path = scratch_path(spark, "days")
    keep_days(events, path, "user", "at", "value")
    found = {r.last_day: r for r in over_days(spark, path, 5, (0.1, 0.5, 0.9)).collect()}
    known = events.filter("at IS NOT NULL").toPandas()
    days = known["at"].dt.date
    assert set(found) == set(days)
    for day, row in found.items():
        part = known[(days <= day) & (days > day - dt.timedelta(days=5))]
        assert row.n_rows == len(part) and row.n_values == part["value"].count()
        users = part["user"].nunique()
        assert abs(row.n_users - users) <= 0.04 * users
        for name, rank in (("q10", 0.1), ("q50", 0.5), ("q90", 0.9)):
            values = part["value"].dropna()
            low, high = (values < row[name]).mean(), (values <= row[name]).mean()
            assert low - 0.02 <= rank <= high + 0.02


def test_days_are_replaced_and_others_stay(spark, events):
    path = scratch_path(spark, "days")
    keep_days(events, path, "user", "at", "value")
    before = over_days(spark, path, 3).collect()
    keep_days(events.filter("at >= TIMESTAMP_NTZ '2024-03-05 00:00:00'"), path, "user", "at", "value")
    assert sorted(r[:4] for r in map(tuple, over_days(spark, path, 3).collect())) == sorted(r[:4] for r in map(tuple, before))
    keep_days(events.filter("day(at) = 2 AND value > 100"), path, "user", "at", "value")
    changed = {r.last_day.day for r in over_days(spark, path, 3).collect() if (r.last_day, r.n_rows) not in {(b.last_day, b.n_rows) for b in before}}
    assert changed == {2, 3, 4}


def test_one_row_per_day_is_stored(spark, events):
    path = scratch_path(spark, "days")
    keep_days(events, path, "user", "at", "value")
    stored = spark.read.parquet(path)
    assert stored.count() == events.select(F.col("at").cast("date")).dropna().distinct().count()
    assert stored.agg(F.max(F.octet_length("users") + F.octet_length("values"))).first()[0] < 40_000
