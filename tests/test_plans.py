"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from tallymill.plans import QUERIES
from tallymill.operators.layout import match_rows
from tallymill.session import new_path, settings
from tallymill.sources.tables import table, write_partitioned
from pyspark.sql import functions as F
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["pricing_summary"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(l_shipdate", text)
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert set(re.findall(r"(\w+)#", columns)) == {
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    }


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_join_compares_all_pairs(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "NestedLoop" not in text
    assert "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["topk_group", "lateral"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan(QUERIES[name](spark, SMALL)))


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk"](spark, SMALL))


@pytest.mark.parametrize("name", ["semi", "anti", "intersect", "except"])
def test_copies_are_dropped_before_the_shuffle(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SMALL))
    exchange = text.rindex("Exchange hashpartitioning")
    assert "HashAggregate" in text[exchange:]


def test_laid_out_rows_move_once_for_several_windows(spark, no_broadcast):
    text = plan(QUERIES["rank_family_hot"](spark, SMALL))
    rows = [line for line in text.splitlines() if "FileScan" in line and "event_id" in line]
    assert len(rows) == 1
    assert "SortMergeJoin" not in text


def test_partitioned_output_is_pruned(spark):
    path = new_path(spark, "orders")
    write_partitioned(table(spark, SMALL, "orders").withColumn("o_year", F.year("o_orderdate")), path, "o_year")
    text = plan(spark.read.parquet(path).filter("o_year = 1999"))
    assert re.search(r"PartitionFilters: \[[^\]]*o_year[^\]]*1999", text)


def test_a_hot_join_key_is_split(spark, no_broadcast):
    wanted = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    with settings(spark, wanted):
        rows = spark.range(0, 200_000, 1, 8).selectExpr("IF(id % 2 = 0, 7, id) AS k", "id", "hash(id) AS v")
        totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = match_rows(rows, totals, ["k"])
        assert joined.agg(F.count_if(F.col("n") == 100_001)).first()[0] == 100_001
        joined.collect()
        assert "skew=true" in plan(joined)


def test_no_sketch_is_kept_per_user(spark):
    lines = [line for line in plan(QUERIES["approx_distinct"](spark, SMALL)).splitlines() if "approx_count_distinct(" in line]
    keys = [re.search(r"keys?=\[([^\]]*)\]", line).group(1) for line in lines]
    assert keys and all(re.fullmatch(r"event_type#\d+", k) for k in keys)
