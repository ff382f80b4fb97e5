"""Streams fed file by file, stopped, restarted and compared with batch."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymill.streaming import jobs
from tallymill.streaming.alarms import silences

START = dt.datetime(2024, 5, 1)
SCHEMA = "event_id long, user_id long, event_type string, ts timestamp_ntz, value double"


def event(event_id, minute, user=1, kind="view"):
    return (event_id, user, kind, START + dt.timedelta(minutes=minute), 1.5)


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "arrived"), str(tmp_path / "run")


def deliver(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, job, path, folder):
    stream = job(jobs.arrivals(spark, path, spark.createDataFrame([], SCHEMA).schema))
    jobs.run_once(stream, folder)
    return jobs.output(spark, folder, stream.schema)


def test_late_rows_are_dropped_and_open_windows_wait(spark, place):
    path, folder = place
    job = jobs.tumbling("30 minutes", "1 hour")
    deliver(spark, [event(i, i * 20) for i in range(10)], path)  # up to 03:00, so 02:30 is passed
    first = {(r.window_start.hour, r.n_events) for r in run(spark, job, path, folder).collect()}
    assert first == {(0, 3), (1, 3)}
    late, in_time = event(100, 5), event(101, 130)
    deliver(spark, [late, in_time, event(102, 300)], path)
    second = {(r.window_start.hour, r.n_events) for r in run(spark, job, path, folder).collect()}
    assert second == {(0, 3), (1, 3), (2, 4), (3, 1)}


def test_a_restart_without_new_files_adds_nothing(spark, place):
    path, folder = place
    job = jobs.tumbling("0 minutes", "1 hour")
    deliver(spark, [event(i, i * 30) for i in range(8)], path)
    before = run(spark, job, path, folder).count()
    assert before == 3
    assert run(spark, job, path, folder).count() == before


def test_sessions_continue_over_a_restart(spark, place):
    path, folder = place
    job = jobs.sessions("0 minutes", "30 minutes")
    deliver(spark, [event(0, 0), event(1, 20), event(2, 25, user=2)], path)
    assert run(spark, job, path, folder).count() == 0
    deliver(spark, [event(3, 40), event(4, 200)], path)
    found = sorted((r.user_id, r.n_events) for r in run(spark, job, path, folder).collect())
    assert found == [(1, 3), (2, 1)]


def test_repeats_are_dropped_over_restarts(spark, place):
    path, folder = place
    job = jobs.first_seen("1 hour", ["user_id", "event_type"])
    deliver(spark, [event(i, i % 7, user=i % 2) for i in range(50)], path)
    assert run(spark, job, path, folder).count() == 2
    deliver(spark, [event(60, 8), event(61, 9, kind="click"), event(62, 9, kind="click")], path)
    assert sorted(tuple(r) for r in run(spark, job, path, folder).collect()) == [
        (0, "view"),
        (1, "click"),
        (1, "view"),
    ]


def test_a_key_comes_back_once_its_state_has_expired(spark, place):
    path, folder = place
    job = jobs.first_seen("1 hour", ["user_id"])
    for number, (minute, user) in enumerate([(0, 1), (30, 1), (132, 8), (133, 9), (140, 1)]):
        deliver(spark, [event(number, minute, user=user)], path)
        found = sorted(r.user_id for r in run(spark, job, path, folder).collect())
    assert found == [1, 1, 8, 9]


def test_settings_are_put_back(spark, place):
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    path, folder = place
    deliver(spark, [event(0, 0)], path)
    run(spark, jobs.sliding("0 minutes", "2 hours", "1 hour"), path, folder)
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_windows_do_not_depend_on_the_session_zone(spark, place, zone):
    path, folder = place
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        deliver(spark, [event(i, i * 60) for i in range(60)], path)
        found = run(spark, jobs.tumbling("0 minutes", "1 day"), path, folder).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted((r.window_start, r.n_events) for r in found) == [(START, 24), (START + dt.timedelta(days=1), 24)]


def test_questions_wait_for_answers_over_a_restart(spark, place):
    path, folder = place
    job = jobs.answers("10 minutes", F.expr("event_type = 'error'"), F.expr("event_type = 'purchase'"))
    at = lambda minute: START + dt.timedelta(minutes=minute)
    # The hour of 0:00 is still open: the answer to the second error comes with the next delivery, over the hour's edge.
    deliver(spark, [event(0, 0, kind="error"), event(1, 55, kind="error"), event(2, 10, kind="purchase"), event(3, 60, kind="purchase"), event(4, 61, user=2, kind="error")], path)
    assert run(spark, job, path, folder).count() == 0
    late = event(9, 1, user=3, kind="error")
    deliver(spark, [event(5, 100, kind="purchase"), event(6, 56, user=7, kind="purchase"), event(7, 300, kind="error"), event(8, 300, kind="purchase")], path)
    found = sorted(map(tuple, run(spark, job, path, folder).collect()))
    first = [(0, 1, at(0), 2, at(10)), (1, 1, at(55), 2, at(60)), (4, 2, at(61), 0, None)]
    assert found == first
    # What is late by more than the delay is dropped; without new rows nothing is added.
    deliver(spark, [late], path)
    assert sorted(map(tuple, run(spark, job, path, folder).collect())) == first
    deliver(spark, [event(10, 900, kind="error"), event(11, 900, kind="purchase")], path)
    assert sorted(map(tuple, run(spark, job, path, folder).collect())) == [*first, (7, 1, at(300), 0, None)]


def test_silence_is_told_once_the_watermark_has_passed_it(spark, place):
    path, folder = place
    job = silences("10 minutes", 3600)
    at = lambda minute: START + dt.timedelta(minutes=minute)
    found = lambda: sorted(map(tuple, run(spark, job, path, folder).collect()))
    deliver(spark, [event(0, 0), event(1, 30), event(2, 40, user=2)], path)
    assert found() == []
    # User 1 goes on after 55 minutes, user 2 does not; a third one moves the watermark to 1:55.
    deliver(spark, [event(3, 85), event(4, 125, user=3)], path)
    assert found() == [(2, at(40), 1, 1)]
    # An event in between, late but not too late, belongs to the visit; user 2 is back and silent again.
    deliver(spark, [event(5, 116, user=1), event(6, 118, user=2), event(7, 300, user=3)], path)
    expected = [(1, at(116), 4, 1), (2, at(40), 1, 1), (2, at(118), 1, 2), (3, at(125), 1, 1)]
    assert found() == expected
    deliver(spark, [event(8, 100, user=1)], path)  # too late
    assert found() == expected
    deliver(spark, [event(9, 900, user=1), event(10, 2000, user=3)], path)
    assert found() == sorted([*expected, (1, at(900), 1, 2), (3, at(300), 1, 2)])
