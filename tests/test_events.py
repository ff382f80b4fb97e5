from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallymill.operators.sessions import sessions
from tests.compare import differences

START = dt.datetime(2024, 3, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_a_gap_of_exactly_the_limit_splits(spark):
    rows = [(1, at(0)), (1, at(3599)), (1, at(3599 + 3600)), (1, at(3599 + 3600 + 3599)), (2, at(10))]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz")
    found = sorted((r.user_id, r.session_start, r.session_end, r.n_events) for r in sessions(df, ["user_id"], "ts", 3600).collect())
    assert found == [
        (1, at(0), at(3599 + 3600), 2),
        (1, at(3599 + 3600), at(3599 + 3600 + 3599 + 3600), 2),
        (2, at(10), at(3610), 1),
    ]


def test_sessions_agree_with_the_native_window(spark, skewed_df):
    known = skewed_df.filter("user_id IS NOT NULL")
    for gap in (60, 600, 5000):
        native = (
            known.groupBy("user_id", F.session_window("ts", f"{gap} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")
        )
        for form in ({}, {"group_rows": 1, "block_rows": 7}, {"group_rows": 40, "block_rows": 30}):
            assert differences(sessions(known, ["user_id"], "ts", gap, **form).toArrow(), native.toArrow()) == []


def test_times_before_1970(spark):
    early = dt.datetime(1969, 12, 31, 23, 30)
    rows = [(1, early), (1, early + dt.timedelta(minutes=45))]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz")
    assert [r.n_events for r in sessions(df, ["user_id"], "ts", 3600).collect()] == [2]
