"""What the physical plans must and must not contain."""

import pytest

from clientele.catalog import QUERIES
from clientele.operators import features, marts, scoring, serve
from clientele.operators.reports import client, engagement

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def simple(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_moves_no_rows_to_one_task(bank):
    """The only single-partition exchange is the one-row partial aggregate of the bounds subquery."""
    text = simple(marts.score_features(bank.customer_features))
    main = text.split("Subqueries")[0]
    assert "Window" not in main and "BroadcastNestedLoopJoin" not in main and "CartesianProduct" not in main


def test_no_python_and_no_pair_products(spark, bank):
    for name, build in QUERIES.items():
        if name.startswith(("int", "mrt", "scr", "srv", "rpt", "stg")):
            text = simple(build(spark, DATA))
            assert "Python" not in text and "ArrowEval" not in text, name
            assert "CartesianProduct" not in text, name


def test_top_k_does_not_sort_everything(bank):
    assert "TakeOrderedAndProject" in simple(serve.at_risk(bank.customer_360))


def test_filters_and_columns_reach_the_scan(bank):
    text = plan(serve.profile(bank.customer_360, bank.nba, "C00000007"))
    assert "EqualTo(customer_id,C00000007)" in text
    narrow = plan(features.max_dpd(bank.table("customers"), bank.table("loans")))
    assert "principal_xof" not in narrow.split("ReadSchema")[1]


def test_month_filter_prunes_folders(bank):
    text = plan(engagement.latest_month_txn(bank.monthly_transactions))
    assert "PartitionFilters: [isnotnull(txn_month" in text


def test_group_limit_runs_before_the_shuffle(bank):
    assert "WindowGroupLimit" in simple(client.recent_interactions(bank.table("interactions")))


def test_bounds_are_computed_in_one_subquery(bank):
    text = plan(scoring.composite_risk(bank.customer_features))
    assert text.count("Subquery:") == 1


@pytest.mark.parametrize("name", ["int2_txn_trend", "int1_recency"])
def test_transactions_shuffle_once_and_after_partial_aggregation(spark, bank, name):
    text = simple(QUERIES[name](spark, DATA))
    assert "partial_" in text
