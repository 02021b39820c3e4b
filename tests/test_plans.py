"""The shape of the plans: shuffles, pushed filters, pruned columns, no row-at-a-time Python."""

import os

import pytest
from pyspark.sql import functions as F

from tablewright.operators import parties, quality
from tablewright.operators.joins import Limits, attach
from workload import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def plan_of(df):
    """The physical plan as first planned."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_lookups_of_small_dimensions_add_no_shuffle(spark):
    df = QUERIES["lookup_multi"](spark, FOLDER)
    plan = plan_of(df)
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    # the only hash exchanges reduce the three dimensions
    assert exchanges(df) == 3
    assert "l_extendedprice" not in plan and "l_comment" not in plan


def test_golden_records_take_one_shuffle(spark):
    from workload.parties import source_tables
    from workload.registry import Tables

    golden = parties.golden_records(parties.stage_parties(source_tables(Tables(spark, FOLDER))))
    assert exchanges(golden) == 1 and "Window" not in plan_of(golden)


def test_foreign_keys_reduce_before_the_join(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    customer = spark.read.parquet(f"{FOLDER}/customer.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = quality.foreign_key(orders, "orders", "o_custkey", customer, "customer", "c_custkey")
        # counted ids and parent ids: the join adds no third shuffle
        assert exchanges(df) == 2
        assert "ReadSchema: struct<o_custkey:bigint>" in plan_of(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["sql_read"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in plan


def test_large_right_sides_are_shuffled_not_broadcast(spark):
    left = spark.range(1000).withColumn("k", F.col("id") % 10)
    right = spark.range(1000).withColumnRenamed("id", "rk").withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(attach(left, right, {"k": "rk"}, take=["v"], limits=Limits(broadcast_bytes=10)))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products_and_no_python_rows(spark, name):
    if name in ("reset_and_append", "string_source", "domain_run", "load_whole", "ids_after_load", "must_load", "delete_cycle"):
        pytest.skip("writes tables; covered by the storage and domain tests")
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    if name not in ("unicode_fold", "workbooks"):
        assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan
    # join without a key: only the dense ids' offsets may have one, and they do not
    assert "BroadcastNestedLoopJoin" not in plan


def test_every_query_is_checked_by_sql():
    assert set(QUERIES) == set(ORACLES)
