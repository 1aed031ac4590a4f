"""The physical plans and the session helpers are the ones we mean to have."""

import os
from types import SimpleNamespace

import pytest

from lendmill import session
from lendmill.plans.registered import QUERIES

SF = "/root/testdata/sf0.001"
LAZY = [
    "npl_by_segment",
    "dpd_distribution",
    "province_segment_heavy",
    "portfolio_kpis",
    "mart_loan_performance",
    "mart_customer_360",
    "dq_gate",
    "column_tests",
    "dq_metrics",
    "scd2_apply",
    "scd2_history",
    "upsert_latest",
    "masked_engineer",
    "masked_by_sql",
    "semantic_mixed_grain",
    "bm25_topk",
    "ml_features",
    "ml_split",
]


def plan_of(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in plan


def test_unused_repayments_are_not_read(spark):
    assert "lineitem" not in plan_of(spark, "npl_by_segment")


def test_columns_are_pruned_and_keys_filtered_at_the_scan(spark):
    plan = plan_of(spark, "mart_loan_performance")
    assert "l_tax" not in plan and "l_quantity" not in plan
    assert "IsNotNull(o_orderkey)" in plan


@pytest.mark.parametrize("name", ["upsert_latest", "latest_per_key"])
def test_latest_rows_combine_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "SortAggregate" not in plan
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_metrics_do_not_expand_rows(spark):
    assert "Expand" not in plan_of(spark, "dq_metrics")


def _fake(master, named=None):
    seen = []
    context = SimpleNamespace(
        master=master,
        applicationId=f"app-{master}",
        getCheckpointDir=lambda: seen[-1] if seen else None,
        setCheckpointDir=seen.append,
    )
    return SimpleNamespace(conf={"spark.checkpoint.dir": named}, sparkContext=context), seen


def test_shared_folder_is_the_named_one():
    spark, seen = _fake("spark://host", "hdfs://x/ck/")
    assert session.shared_dir(spark) == "hdfs://x/ck" and seen == ["hdfs://x/ck/"]
    assert session.fresh_path(spark, "t").startswith("hdfs://x/ck/t-")


def test_only_a_local_master_may_go_without():
    spark, seen = _fake("local[2]")
    first = session.shared_dir(spark)
    assert os.path.isdir(first) and session.shared_dir(spark) == first and seen == [first]
    with pytest.raises(RuntimeError):
        session.shared_dir(_fake("spark://host")[0])
