from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallymill.operators import sets


def ids(df):
    return sorted((r[0] is None, r[0]) for r in df.collect())


def known(*values):
    return sorted((v is None, v) for v in values)


@pytest.mark.parametrize(
    "listed,kept",
    [
        ([2], [1]),  # a NULL on the left is never known to be absent
        ([2, None], []),  # a NULL in the list leaves every answer open
        ([], [1, 2, None]),  # nothing is in an empty list, not even NULL
        ([7], [1, 2]),
    ],
)
def test_not_in_with_nulls(spark, listed, kept):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a long")
    right = spark.createDataFrame([(v,) for v in listed], "b long")
    assert ids(sets.not_in(left, "a", right, "b")) == known(*kept)
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    assert ids(spark.sql("SELECT a FROM l WHERE a NOT IN (SELECT b FROM r)")) == known(*kept)


@pytest.mark.parametrize("chunk", [1, 2, 3, 1000])
def test_except_all_counts_copies(spark, chunk):
    left = spark.createDataFrame([(1,)] * 7 + [(2,)] * 2 + [(None,)] * 3 + [(4,)], "a long")
    right = spark.createDataFrame([(1,)] * 2 + [(2,)] * 5 + [(None,)], "a long")
    assert ids(sets.except_all(left, right, chunk)) == known(*[1] * 5, None, None, 4)
    assert ids(left.exceptAll(right)) == known(*[1] * 5, None, None, 4)


def test_set_operations_treat_nulls_as_equal(spark):
    left = spark.createDataFrame([(1,), (1,), (None,), (None,), (3,)], "a long")
    right = spark.createDataFrame([(1,), (None,)], "a long")
    assert ids(sets.intersect(left, right)) == known(1, None)
    assert ids(sets.subtract(left, right)) == known(3)


def test_matching_keeps_left_copies_and_ignores_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    kept = sets.matching(left, right, {"k": "k"})
    dropped = sets.matching(left, right, {"k": "k"}, keep=False)
    assert sorted(r.v for r in kept.collect()) == ["a", "b"]
    assert sorted(r.v for r in dropped.collect()) == ["c", "d"]


def test_two_key_match(spark):
    left = spark.range(10).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"), "id")
    right = spark.createDataFrame([(0, 1), (2, 0)], "x long, y long")
    assert ids(sets.matching(left, right, {"a": "x", "b": "y"}).select("id")) == known(2, 3, 8, 9)
