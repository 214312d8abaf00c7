"""Physical plans: what is shuffled, pushed down and kept out of Python."""

import os

import pytest

from formline.operators import rosters as R
from formline.plans import proxies as P
from formline.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries whose rows come from a fitted model or a driver-side table of scores.
MODELS = {"train_rf", "train_gbt", "train_linear_svr", "trial_table", "score_table", "pipeline_roundtrip"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return sum("Exchange hashpartitioning" in line for line in plan.splitlines())


@pytest.mark.parametrize("key", sorted(set(QUERIES) - MODELS))
def test_no_cross_joins_and_no_python(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert word not in plan, (key, word)


def test_feature_table_needs_one_exchange_beyond_its_aggregate(spark):
    plan = plan_of(QUERIES["feature_table"](spark, SF_DIR))
    assert exchanges(plan) == 2
    assert plan.count("Sort [") == 1
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in plan
    assert "l_extendedprice" not in plan


def test_windows_share_an_exchange_and_a_sort(spark):
    plan = plan_of(QUERIES["rolling_mean"](spark, SF_DIR))
    assert exchanges(plan) == 2 and plan.count("Sort [") == 1


def test_labels_of_a_random_split_move_no_rows(spark):
    assert "Exchange" not in plan_of(QUERIES["random_split"](spark, SF_DIR))


def test_scan_reads_the_selected_columns_only(spark):
    plan = plan_of(QUERIES["select_prefix"](spark, SF_DIR))
    assert "ReadSchema: struct<l_linenumber:int,l_returnflag:string,l_linestatus:string>" in plan


def test_rosters_take_a_top_n_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(P.rosters(spark, SF_DIR))


def test_swaps_are_found_without_joining_members_and_pool(spark):
    """Members are answered where they are; only each team's best answers move."""
    args = (P.rosters(spark, SF_DIR), P.supplier_pool(spark, SF_DIR), P.ROSTER_RULES)
    plan = plan_of(R.best_swap(*args))
    above = plan.split("MapInArrow")[0]
    assert "MapInArrow" in plan and "Join" not in above and exchanges(above) == 1, plan
