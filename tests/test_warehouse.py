"""What a warehouse notices, keeps and removes."""

import os
import shutil

import pytest

from clientele.operators.reports import engagement
from clientele.operators import features
from clientele.plans.refresh import current_version
from clientele.plans.warehouse import Warehouse

TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


@pytest.fixture()
def source(tmp_path):
    """The smallest given tables as folders of files, so that a file can be added."""
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables not present")
    for t in TABLES:
        (tmp_path / f"{t}.parquet").mkdir()
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet" / "part-0.parquet")
    return tmp_path


def files_below(path):
    return [os.path.join(d, f) for d, _, files in os.walk(path) for f in files]


def test_a_new_file_renews_what_depends_on_it_and_nothing_else(spark, source):
    w = Warehouse.from_star_schema(spark, str(source))
    w.fill_bronze()
    before, complaints, customers = w.counts(), w.bronze("complaints"), w.bronze("customers")
    gold = w.customer_360
    assert w.renew() == [] and w.customer_360 is gold
    shutil.copy(source / "events.parquet" / "part-0.parquet", source / "events.parquet" / "part-1.parquet")
    assert sorted(w.renew()) == ["complaints", "interactions"]
    assert w.bronze("customers") is customers and w.bronze("complaints") is not complaints
    after = w.counts()
    assert after["complaints"]["rows"] == 2 * before["complaints"]["rows"] == w.bronze("complaints").count()
    assert after["customers"] == before["customers"]
    assert w.customer_360 is not gold
    w.close()


def test_closing_removes_every_written_table(spark, source, tmp_path):
    w = Warehouse.from_star_schema(spark, str(source))
    paths = [f for t in ("customers", "channels") for f in w.bronze(t).inputFiles()]
    local = [p.removeprefix("file://") for p in paths]
    assert all(os.path.exists(p) for p in local)
    w.close()
    assert not any(os.path.exists(p) for p in local)
    assert w.bronze("channels").count() > 0  # built anew
    w.close()


def test_counts_are_those_of_the_tables(bank):
    for table, counts in bank.counts().items():
        df = bank.bronze(table)
        assert counts["rows"] == df.count()
        assert all(n == df.filter(f"{c} is null").count() for c, n in counts.items() if c != "rows" and n)


def test_the_reference_date_needs_no_scan(bank):
    txn, known = bank.table("transactions"), bank.as_of()
    assert bank.customer_360.select(known.alias("d")).first()[0] == txn.agg({"txn_datetime": "max"}).first()[0]
    for df in (
        features.recency(bank.table("customers"), txn, reference=known), features.txn_trend(bank.table("customers"), txn, known),
        engagement.latest_month_txn(bank.monthly_transactions, known), engagement.monthly_volume(bank.monthly_transactions, known),
    ):
        assert "Subquery" not in df._jdf.queryExecution().executedPlan().toString()


def test_asking_for_the_version_writes_nothing(spark, tmp_path):
    assert current_version(spark, str(tmp_path / "nowhere")) is None
    assert files_below(tmp_path) == []
