"""All event queries on a table with NULL users and values, ties in time and four decimals."""

from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest

from tallymill.plans import ORACLES, QUERIES
from tests.compare import duck

QUERIES_ON_EVENTS = sorted(
    name
    for name, text in ORACLES.items()
    if "events" in text and not name.startswith("json") and not any(t in text for t in ("lineitem", "orders", "customer"))
)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    draw, start = random.Random(11), dt.datetime(2024, 1, 1)
    # In time order, as in the driver's table, with many events at one instant. No two
    # are an hour apart to the second: stream sessions go on over such a gap.
    sevens = sorted(draw.choice([draw.randrange(240_000), draw.randrange(200) * 1100]) for _ in range(2000))
    rows = [
        (
            i, start + dt.timedelta(seconds=7 * m), draw.choice([None, 1, 1, 1, *range(2, 30)]),
            draw.choice(["click", "error", "purchase", "signup", "view"]),
            draw.choice([None, round(draw.uniform(0.5, 490), 4), 12.3456]), '{"k": 1}',
        )
        for i, m in enumerate(sevens)
    ]
    frame = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    frame["user_id"] = frame["user_id"].astype("Int64")
    frame["ts"] = frame["ts"].astype("datetime64[us]")
    place = tmp_path_factory.mktemp("nulls")
    frame.to_parquet(place / "events.parquet", index=False)
    return str(place)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        # Sums are rounded to cents at the end; on the edge they may differ by one.
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=0.0100001)
    return a == b


@pytest.mark.parametrize("name", QUERIES_ON_EVENTS)
def test_query(spark, folder, name):
    ours = QUERIES[name](spark, folder).toArrow()
    theirs = duck(folder).sql(ORACLES[name]).to_arrow_table()
    names = sorted(ours.column_names)
    assert names == sorted(theirs.column_names)
    exact = [n for n in names if not str(ours.schema.field(n).type).startswith("double")]
    key = lambda row: repr([row[n] for n in exact])
    ours, theirs = sorted(ours.to_pylist(), key=key), sorted(theirs.to_pylist(), key=key)
    assert len(ours) == len(theirs)
    wrong = [(a, b) for a, b in zip(ours, theirs) if not all(close(a[n], b[n]) for n in names)]
    assert wrong == []
