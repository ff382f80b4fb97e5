from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest

from tallymill.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def skewed():
    """Events in which one user has half the rows, many at one instant, and some users are NULL."""
    draw = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    instants = [start + dt.timedelta(seconds=draw.randrange(40_000), microseconds=draw.randrange(3)) for _ in range(120)]
    crowd = start + dt.timedelta(hours=5)
    rows = []
    for event_id in range(900):
        user = draw.choice([1, 1, 1, 2, 3, 4, None])
        ts = crowd if user == 1 and draw.random() < 0.5 else draw.choice(instants)
        value = draw.choice([None, 1.25, 2.5, 2.5, 2.5, round(draw.uniform(0, 9), 2)])
        kind = draw.choice(["click", "purchase", "error", "view"])
        rows.append((event_id, user, ts, value, kind))
    frame = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "value", "event_type"])
    frame["user_id"] = frame["user_id"].astype("Int64")
    frame["ts"] = frame["ts"].astype("datetime64[us]")
    return frame


@pytest.fixture(scope="session")
def skewed_df(spark, skewed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skewed") / "events.parquet")
    skewed.to_parquet(path, index=False)
    return spark.read.parquet(path)
