"""Ordered operators on skewed data with ties and NULLs, in both forms.

``block_rows`` values around the sizes of keys and tie groups put block edges
everywhere: inside a key, inside a run of equal values, on both at once.
"""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import Window, functions as F

from tallymill.operators.layout import BLOCK_ROWS, POSITION, Large, find_large, lay_out, latest, running, total
from tallymill.operators.ordered import frame, neighbour, percentiles, ranks, windowed
from tallymill.operators.timejoin import asof_join, trailing
from tests.compare import differences

NATIVE = {"group_rows": 10**9}
BLOCKED = [{"group_rows": 1, "block_rows": n} for n in (3, 250)]
# Some keys native, some in blocks.
MIXED = [{"group_rows": n, "block_rows": 50} for n in (150, 300)]
FORMS = [NATIVE, *BLOCKED, *MIXED]


def expected(skewed, text):
    connection = duckdb.connect()
    connection.register("frame", skewed)
    connection.execute("CREATE VIEW ev AS SELECT event_id, user_id, ts::TIMESTAMP AS ts, value, event_type FROM frame")
    return connection.sql(text).to_arrow_table()


@pytest.mark.parametrize("form", FORMS)
def test_ranks(skewed, skewed_df, form):
    got = ranks(skewed_df.select("event_id", "user_id", "value"), ["user_id"], "value", ["event_id"], 7, **form)
    want = expected(
        skewed,
        """
        SELECT event_id, user_id, value, row_number() OVER r AS row_number, rank() OVER p AS rank,
               dense_rank() OVER p AS dense_rank, (ntile(7) OVER r)::INTEGER AS ntile,
               percent_rank() OVER p AS percent_rank, cume_dist() OVER p AS cume_dist
        FROM ev WINDOW p AS (PARTITION BY user_id ORDER BY value NULLS FIRST),
                       r AS (PARTITION BY user_id ORDER BY value NULLS FIRST, event_id)
        """,
    )
    assert differences(got.toArrow(), want) == []


def test_ranks_with_more_tiles_than_rows(skewed, skewed_df):
    few = skewed_df.filter("event_id < 5").select("event_id", "user_id", "value")
    forms = [
        ranks(few, ["user_id"], "value", ["event_id"], 9, **f).toArrow() for f in (NATIVE, {"group_rows": 0, "block_rows": 2})
    ]
    assert differences(*forms) == []


@pytest.mark.parametrize("form", FORMS)
def test_neighbours_and_first_rows(skewed, skewed_df, form):
    form = {**form, "block_rows": max(form.get("block_rows", 100), 4)}
    got = windowed(
        skewed_df.select("event_id", "user_id", "ts", "value"),
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        {
            "back": neighbour("value", -3),
            "ahead": neighbour("event_id", 2),
            "n": frame(F.count(F.lit(1)), -3, 2),
        },
        nth={"first_id": ("event_id", 1), "fifth_value": ("value", 5)},
        **form,
    ).drop("ts", "value")
    want = expected(
        skewed,
        """
        SELECT event_id, user_id, lag(value, 3) OVER w AS back, lead(event_id, 2) OVER w AS ahead,
               count(*) OVER (w ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS n,
               first_value(event_id) OVER w AS first_id, nth_value(value, 5) OVER w AS fifth_value
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
        """,
    )
    assert differences(got.toArrow(), want) == []


def test_rough_totals_are_refused(skewed_df):
    for form in (Large(["user_id"]), Large(["user_id"], every=True)):
        with pytest.raises(TypeError):
            running(skewed_df, ["user_id"], [F.col("ts")], [total("t", F.col("value"))], form)


def test_ranges_follow_the_counted_rows(spark, skewed_df):
    by, blocks = [F.col("ts"), F.col("event_id")], BLOCK_ROWS * 19
    laid_out = lay_out(skewed_df, ["user_id"], by, rows=blocks)
    assert len(laid_out.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert laid_out.agg(F.max(POSITION)).first()[0] == 899
    assert find_large(skewed_df, ["user_id"], 300).rows == skewed_df.filter("user_id = 1").count()
    assert find_large(skewed_df, ["user_id"], 1).rows == 900


def test_frames_are_longer_than_blocks(skewed, skewed_df):
    near = {"n": frame(F.count(F.lit(1)), -40, 25), "t": frame(F.sum("value"), -30, -7), "far": neighbour("event_id", 33)}
    source = skewed_df.select("event_id", "user_id", "ts", "value")
    by = [F.col("ts"), F.col("event_id")]
    forms = [
        windowed(source, ["user_id"], by, near, **f).toArrow()
        for f in ({}, {"group_rows": 1, "block_rows": 5}, {"group_rows": 100, "block_rows": 23})
    ]
    # Sums of doubles too are equal to the last bit, as a frame is added up in order.
    assert all(sorted(map(repr, f.to_pylist())) == sorted(map(repr, forms[0].to_pylist())) for f in forms)
    want = expected(
        skewed,
        """
        SELECT event_id, count(*) OVER (w ROWS BETWEEN 40 PRECEDING AND 25 FOLLOWING) AS n, lead(event_id, 33) OVER w AS far
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
        """,
    )
    assert differences(forms[1].select(["event_id", "n", "far"]), want) == []


def test_frames_without_bounds_are_refused():
    for first, last in ((Window.unboundedPreceding, 0), (0, Window.unboundedFollowing), (1, 0)):
        with pytest.raises(ValueError):
            frame(F.count(F.lit(1)), first, last)


@pytest.mark.parametrize("every,block_rows", [(False, 1), (True, 3), (True, 40), (True, 5000)])
def test_running_values(skewed, skewed_df, every, block_rows):
    source = skewed_df.select("event_id", "user_id", "ts", "value", "event_type")
    got = running(
        source,
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        [
            total("cents", (F.col("value") * 100).cast("long")),
            latest("click", F.when(F.col("event_type") == "click", F.col("event_id"))),
        ],
        Large(["user_id"], every=every),
        block_rows,
    ).select("event_id", "cents", "click")
    want = expected(
        skewed,
        """
        SELECT event_id, (sum((value * 100)::BIGINT) OVER w)::BIGINT AS cents,
               last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER w AS click
        FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
        """,
    )
    assert {(r["event_id"], r["click"]) for r in got.toArrow().to_pylist()} == {
        (r["event_id"], r["click"]) for r in want.to_pylist()
    }
    # value * 100 truncates in Spark and rounds in DuckDB; allow one per row.
    ours = {r["event_id"]: r["cents"] for r in got.toArrow().to_pylist()}
    native = running(
        source, ["user_id"], [F.col("ts"), F.col("event_id")], [total("cents", (F.col("value") * 100).cast("long"))],
        Large(["user_id"]),
    )
    assert ours == {r.event_id: r.cents for r in native.collect()}


@pytest.mark.parametrize("inclusive,null_safe", [(True, False), (False, True), (False, False)])
@pytest.mark.parametrize("form", FORMS)
def test_asof(skewed, skewed_df, form, inclusive, null_safe):
    clicks = skewed_df.filter("event_type = 'click'")
    buys = skewed_df.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    got = asof_join(buys, clicks, ["user_id"], "ts", "event_id", ["event_id", "value"], inclusive, null_safe=null_safe, **form)
    compare = "<=" if inclusive else "<"
    equal = "IS NOT DISTINCT FROM" if null_safe else "="
    want = expected(
        skewed,
        f"""
        SELECT p.event_id, p.user_id, p.ts, c.event_id AS right_event_id, c.value AS right_value
        FROM ev p LEFT JOIN LATERAL (
          SELECT event_id, value FROM ev c
          WHERE c.event_type = 'click' AND c.user_id {equal} p.user_id AND c.ts {compare} p.ts
          ORDER BY c.ts DESC, c.event_id DESC LIMIT 1) c ON true
        WHERE p.event_type = 'purchase'
        """,
    )
    assert differences(got.toArrow(), want) == []


@pytest.mark.parametrize("include_now", [True, False])
@pytest.mark.parametrize("form", [*FORMS, {"sparse_rows": 0}, {"sparse_rows": 150}, {"sparse_rows": 60, "group_rows": 300, "block_rows": 50}])
def test_trailing(skewed, skewed_df, form, include_now):
    got = trailing(
        skewed_df.select("event_id", "user_id", "ts", "value"),
        ["user_id"],
        "ts",
        "90 MINUTES",
        {"n": F.lit(1).cast("long"), "amount": F.col("value").cast("decimal(18,2)")},
        include_now,
        **form,
    ).select("event_id", "n", F.round(F.col("amount").cast("double"), 2).alias("amount"))
    upper = "<=" if include_now else "<"
    want = expected(
        skewed,
        f"""
        SELECT a.event_id, nullif(count(b.event_id), 0) AS n, round(sum(b.value), 2) AS amount
        FROM ev a LEFT JOIN ev b ON a.user_id IS NOT DISTINCT FROM b.user_id
          AND b.ts >= a.ts - INTERVAL 90 MINUTES AND b.ts {upper} a.ts
        GROUP BY a.event_id
        """,
    )
    assert differences(got.toArrow(), want) == []


@pytest.mark.parametrize("form", FORMS)
def test_percentiles(skewed, skewed_df, form):
    points = {"p0": 0.0, "p33": 0.33, "p50": 0.5, "p100": 1.0}
    found = percentiles(skewed_df, ["user_id"], "value", points, **form)
    got = found.select("user_id", *[F.round(p, 6).alias(p) for p in points])
    want = expected(
        skewed,
        "SELECT user_id, "
        + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in points.items())
        + " FROM ev WHERE value IS NOT NULL GROUP BY user_id",
    )
    assert differences(got.toArrow(), want) == []


def test_blocks_do_not_depend_on_key_sizes(skewed_df):
    placed = lay_out(skewed_df, ["user_id"], [F.col("ts"), F.col("event_id")], 100)
    sizes = [r["count"] for r in placed.groupBy("_block").count().orderBy("_block").collect()]
    assert sizes == [100] * 9
    assert placed.agg(F.count_distinct(POSITION)).first()[0] == 900


def test_large_groups_are_found(skewed_df):
    assert find_large(skewed_df, ["user_id"], 900) == Large(["user_id"])
    assert find_large(skewed_df, ["user_id"], 1) == Large(["user_id"], every=True)
    some = find_large(skewed_df, ["user_id"], 300)
    assert [r.user_id for r in some.table.collect()] == [1]
    fitting, oversized = some.parts(skewed_df)
    assert fitting.count() + oversized.count() == 900
    assert {r.user_id for r in oversized.select("user_id").distinct().collect()} == {1}


def test_a_null_key_can_be_the_large_one(spark):
    df = spark.range(100).selectExpr("IF(id < 90, NULL, id) AS k", "id")
    fitting, oversized = find_large(df, ["k"], 50).parts(df)
    assert (fitting.count(), oversized.count()) == (10, 90)


@pytest.mark.parametrize("form", [BLOCKED[1], MIXED[1]])
def test_part_of_the_result_can_be_selected(skewed_df, form):
    """Dropping columns lets Spark prune structs inside the operators; values must not move."""
    events = skewed_df.select("event_id", "user_id", "ts", "value")
    clicks = skewed_df.filter("event_type = 'click'")
    ranked = ranks(events, ["user_id"], "value", ["event_id"], **form)
    matched = asof_join(events, clicks, ["user_id"], "ts", "event_id", ["event_id", "value", "ts"], **form)
    framed = trailing(
        events, ["user_id"], "ts", "1 HOUR", {"a": F.lit(1).cast("long"), "b": F.col("event_id")}, **form
    )
    placed = windowed(
        events, ["user_id"], [F.col("ts"), F.col("event_id")], {"back": neighbour("event_id", -1)},
        nth={"first": ("event_id", 1), "second": ("ts", 2)}, **form,
    )
    for whole in (ranked, matched, framed, placed):
        rows = {r.event_id: r for r in whole.collect()}
        assert len(rows) == 900
        for name in set(whole.columns) - {"event_id"}:
            part = {r.event_id: r[name] for r in whole.select("event_id", name).collect()}
            assert part == {i: r[name] for i, r in rows.items()}
