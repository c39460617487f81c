"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import registry
from chartframes.operators.rows import lookup
from chartframes.plans import iqr_flags, top_n_per_group


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(built):
    return {name: plan_of(df) for name, df in built.items()}


def test_no_query_runs_python_per_row(plans):
    for name, plan in plans.items():
        assert not re.search(r"(Batch|Arrow)EvalPython|PythonUDF|InPandas|InArrow|FlatMapGroups", plan), name


def test_no_query_pairs_rows_without_a_key(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_filters_and_columns_reach_the_scan(plans):
    plan = plans["f02_all_of"]
    assert "PushedFilters: [" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "o_custkey" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_group_sum_is_combined_before_the_shuffle(plans):
    assert "partial_sum" in plans["a01_group_sum"]


def test_top_n_is_pruned_before_the_shuffle(tables):
    plan = plan_of(top_n_per_group(tables.part, "p_brand", "p_retailprice", 10, ["p_partkey"]))
    assert "WindowGroupLimit" in plan


def test_small_lookup_is_broadcast_by_its_size(tables):
    nation = tables.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    assert "BroadcastHashJoin" in plan_of(lookup(tables.customer, nation, "c_nationkey"))


def test_flagging_rows_does_not_shuffle_them(tables):
    flags = iqr_flags(tables.orders, "o_totalprice", "o_orderpriority")
    assert "Exchange hashpartitioning" not in plan_of(flags)


def test_windows_without_a_partition_run_on_counted_tables_only(plans):
    lone = re.compile(r"Window \[.*\n.*Sort \[.*\n.*Exchange SinglePartition")
    counted = {"k06_pareto", "k06_pareto_kept", "n06_running_share", "p09_row_number", "f09_row_position"}
    counted |= {"n12_dense_rank", "a11_value_counts", "a12_crosstab", "k27_ranked_crosstab", "k28_timeline"}
    found = {name for name, plan in plans.items() if lone.search(plan)}
    assert found and found <= counted


def test_entry_and_contract(spark):
    assert entry.entry(spark).columns == ["n_name", "total", "cum_pct"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(registry.queries()) - set(registry.oracles()) == set()
