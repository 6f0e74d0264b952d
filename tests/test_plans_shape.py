"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from caselens.checks import serving_cases
from caselens.plans import serving
from caselens.spec import LifecycleSpec

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def long_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["feature_table", "backlog_group", "replay_queue_many", "label_censored", "top_fraction", "ticket_detail"])
def test_no_cross_joins(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_targets_reach_the_rows_without_a_shuffle(spark):
    text = plan(contract.queries()["label_closed"](spark, SF))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def test_top_k_per_node_and_instant_is_cut_before_the_shuffle(spark):
    spans = spark.createDataFrame([("a", 0.5, 0, 3)], "unique_key string, risk double, lo long, hi long")
    numbers = spark.range(4).withColumnRenamed("id", "number")
    text = plan(serving.first_of_spans(spans, numbers, LifecycleSpec(), 2, 5, "risk"))
    # Once before and once after each of the two exchanges.
    assert text.count("WindowGroupLimit") == 4


def test_slice_is_pushed_to_the_scan(spark):
    text = plan(contract.queries()["extract_slice"](spark, SF))
    assert "PushedFilters" in text and "In(o_orderpriority" in text and "ReadSchema: struct<o_orderkey" in text
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_queue_is_a_bounded_top_k(spark):
    rows = serving_cases.ranked(spark, SF)
    assert "TakeOrderedAndProject" in plan(serving.riskiest(rows, LifecycleSpec(), 100))
