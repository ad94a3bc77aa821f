"""One client's questions read a few row groups of tables laid out by client."""

import pytest
from pyspark.sql import functions as F

from clientele.operators.reports import client
from clientele.plans.clients import ClientPages, clustered


def scanned_rows(df):
    """Rows that the file scans of ``df`` handed on: whole row groups, or the pages that the column index left."""
    df.collect()
    jvm_plan = df._jdf.queryExecution().executedPlan()
    if jvm_plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        jvm_plan = jvm_plan.executedPlan()
    return _scanned(jvm_plan)


def _scanned(node):
    if node.getClass().getSimpleName() == "FileSourceScanExec":
        return node.metrics().apply("numOutputRows").value()
    if node.getClass().getSimpleName().endswith("QueryStageExec"):
        return _scanned(node.plan())
    children = node.children()
    return sum(_scanned(children.apply(i)) for i in range(children.size()))


@pytest.fixture(scope="module")
def many(spark):
    """100 000 rows of 5 000 clients, of whom one holds a third."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "C00000042").otherwise(F.concat(F.lit("C"), F.lpad((F.col("id") % 5000).cast("string"), 8, "0"))).alias("customer_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.hash("id") % 10_000_000).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    return rows, clustered(rows, "many", "at", row_group_bytes=64 << 10)


@pytest.mark.parametrize("customer_id", ["C00000001", "C00002500", "C00004999"])
def test_a_client_reads_under_five_percent_of_the_rows(many, customer_id):
    rows, table = many
    mine = table.of(customer_id)
    assert scanned_rows(mine) < 0.05 * rows.count()
    assert sorted(mine.collect()) == sorted(rows.filter(F.col("customer_id") == customer_id).collect())


def test_unknown_clients_open_no_row_group(many):
    _, table = many
    assert scanned_rows(table.of("A")) == 0 and scanned_rows(table.of("C00002500x")) == 0


def test_a_client_with_a_third_of_all_rows_is_spread_over_files(many):
    rows, table = many
    per_file = table.rows.filter("customer_id = 'C00000042'").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1
    assert table.of("C00000042").count() == rows.filter("customer_id = 'C00000042'").count()


def test_pages_equal_the_questions_over_all_clients(bank):
    pages, one = ClientPages(bank), "C00000007"

    def same(a, b):
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))

    same(pages.monthly_activity(one), client.monthly_activity(bank.table("transactions"), one))
    same(pages.recent_txns(one), client.recent_txns(bank.table("transactions"), bank.table("channels"), one))
    same(pages.detail(one), client.client_detail(bank.customer_360, bank.nba, bank.table("customers"), one))
    assert pages.monthly_activity("nobody").collect() == []
