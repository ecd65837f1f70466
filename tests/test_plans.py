"""Physical-plan properties the design relies on."""
from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SMALL_DIR


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_customers_is_top_k(spark):
    plan = _plan(E.queries()["top_customers"](spark, SMALL_DIR))
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters" in plan or "Scan parquet" in plan


def test_scans_are_pruned(spark):
    text = _plan(E.queries()["top_customers"](spark, SMALL_DIR))
    # only the columns the report needs are read from each table
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in text


def test_category_aggregates_before_the_product_join(spark):
    df = E.queries()["sales_by_category"](spark, SMALL_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the join's left input is an Aggregate over product_id
    join_at = plan.index("Join LeftOuter")
    assert "Aggregate [product_id" in plan[join_at:]


def test_monthly_trend_sorts_once(spark):
    plan = _plan(E.queries()["monthly_trends"](spark, SMALL_DIR))
    # the window already runs in one partition, so the final sort needs no range exchange
    assert plan.count("rangepartitioning") == 0


def test_report_job_uses_one_grouping_sets_pass(spark):
    from shopstat.plans.analytics_job import shared_aggregate
    from shopstat.sources import model
    agg = shared_aggregate(model.orders(spark, SMALL_DIR), model.products(spark, SMALL_DIR))
    plan = _plan(agg)
    assert "Expand" in plan and plan.count("Scan parquet") == 3


OWN = sorted(n for n in E.queries() if E.llm is None or n not in E.llm.QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_no_python_evaluation_in_any_query(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas", "InArrow"):
        assert node not in plan


def test_order_positions_need_no_sort(spark):
    # positions come from the dense weight rank in fixed-size blocks: hash exchanges only
    plan = _plan(E.queries()["gen_orders"](spark, SMALL_DIR))
    assert "rangepartitioning" not in plan
    assert "hashpartitioning(_blk" in plan
    # the customer table is read twice: its key for the allocation, its date once for the join
    assert plan.count("customer.parquet") <= 2


def test_running_total_has_no_exchange_on_whole_partitions(spark):
    plan = _plan(E.queries()["running_total"](spark, SMALL_DIR))
    assert "Window [sum(total_price" in plan and "hashpartitioning(_blk" in plan
    assert all("total_price" not in line for line in plan.splitlines() if "hashpartitioning(_part_id" in line)


def test_results_read_twice_are_computed_once(spark):
    """The baseline comparison and the long report read a stored table, not their inputs again."""
    for name, table in (("compare_to_baseline", "events.parquet"), ("revenue_long", "lineitem.parquet")):
        assert table not in _plan(E.queries()[name](spark, SMALL_DIR))
