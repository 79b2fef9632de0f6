"""The stated table schemas, and the plans the queries get."""

import os

import pytest
from pyspark.sql import functions as F

from clickloom.plans import catalogue, tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(tables.SCHEMAS))
def test_stated_schema_is_that_of_the_files(spark, name):
    in_file = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    assert tables.table(spark, SF_DIR, name).dtypes == in_file.dtypes


def plan_of(spark, name):
    df = catalogue.all_queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalogue.all_queries()))
def test_no_pairing_of_everything_with_everything(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


PYTHON = {
    "fold_in_batches",
    "longest_gap",
    "scalar_udfs",
    "top_k_per_group_large",
    "top_k_per_group_steps",
    "udaf_mean",
    "udf_over_array",
    "udf_over_list",
    "udf_over_list_sql",
    "udf_sql",
}


@pytest.mark.parametrize("name", sorted(catalogue.all_queries()))
def test_python_only_where_it_is_the_point(spark, name):
    plan = plan_of(spark, name)
    uses_python = any(op in plan for op in ("EvalPython", "MapInPandas", "MapInArrow", "ArrowAggregate", "FlatMapGroups"))
    assert uses_python == (name in PYTHON)


@pytest.mark.parametrize("name", ["category_sessions", "area_top3", "area_top3_remark", "top_k_per_group"])
def test_groups_are_trimmed_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["word_count", "hot_categories"])
def test_top_k_without_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


def test_only_needed_columns_are_read(spark):
    plan = plan_of(spark, "keyed_sum")
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan


def test_filter_reaches_the_scan(spark):
    for name in ("dsl_filter", "sql_view_filter"):
        assert "GreaterThanOrEqual(c_acctbal,1000.0)" in plan_of(spark, name)


def test_counts_read_the_log_once(spark):
    assert plan_of(spark, "action_counts").count("FileScan") == 1
    assert plan_of(spark, "page_flow_strict").count("FileScan") > 1  # + list of hot sessions


@pytest.mark.parametrize("name", ["area_top3", "area_top3_remark"])
def test_star_aggregate_is_lazy_with_three_exchanges(spark, name):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = catalogue.all_queries()[name](spark, SF_DIR)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 3


def test_no_hot_group_leaves_one_window(spark):
    df = catalogue.all_queries()["adjacent_pairs"](spark, SF_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Window [") == 1
    assert "rangepartitioning" not in final


def test_visits_have_a_unique_order(spark):
    v = tables.visits(spark, SF_DIR)
    dup = v.groupBy("session_id", "ts", "event_id").count().where(F.col("count") > 1)
    assert dup.count() == 0
