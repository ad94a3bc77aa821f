"""Only narrow rows of transactions move before they are written, and a query builds only the tables it reads."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientele.catalog import QUERIES
from clientele.operators import features
from clientele.operators.staging import tag_real
from clientele.plans.warehouse import MONTH, Warehouse, warehouse
from clientele.sources.bank_tables import bank_table, transactions_by_month

ORDERS = "o_orderkey long, o_custkey long"
LINES = (
    "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_tax double"
)


@pytest.fixture
def star(spark, tmp_path):
    """Orders and lines with repeated and missing keys, flags and dates."""
    orders = [(1, 3), (1, 3), (2, None), (3, 49), (None, 7), (4, 99)]
    when = [None, "1995-01-31 00:00:00", "1995-02-01 00:00:00"]
    lines = [
        (k, i, None if i == 5 else 160 * i, i * 9, when[i % 3], None if i == 4 else 10.5 * i, "NR"[i % 2], None if i == 3 else "F", 0.1)
        for k in (1, 2, 3, 4, 5, None) for i in range(7)
    ]
    spark.createDataFrame(orders, ORDERS).write.parquet(str(tmp_path / "orders.parquet"))
    texts = LINES.replace("timestamp_ntz", "string")
    rows = spark.createDataFrame(lines, texts).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_clustered_transactions_are_the_whole_rows_with_their_month(spark, star):
    plain = tag_real(bank_table(spark, star, "transactions")).withColumn(MONTH, F.date_format("txn_datetime", "yyyy-MM"))
    clustered = transactions_by_month(spark, star, MONTH)
    assert clustered.schema.names == plain.schema.names and [f.dataType for f in clustered.schema] == [f.dataType for f in plain.schema]
    found = Counter(map(tuple, clustered.collect()))
    assert found == Counter(map(tuple, plain.collect())) and found.total() == 35


def test_texts_are_derived_behind_the_last_exchange(spark, star):
    bronze = Warehouse.from_star_schema(spark, star)
    written = []
    bronze._write = lambda df, *rest: written.append(df) or df
    bronze.bronze("transactions")
    node = written[0]._jdf.queryExecution().optimizedPlan()
    while not node.nodeName().startswith("RebalancePartitions"):
        node = node.children().head()
    moved = [node.output().apply(i).name() for i in range(node.output().size())]
    assert "l_partkey" in moved and not {"txn_id", "counterparty_type", "city"} & set(moved)


def test_queries_build_only_the_tables_they_read(spark, tmp_path):
    (tmp_path / "given").symlink_to("/root/testdata/sf0.001")
    folder = str(tmp_path / "given")
    assert QUERIES["syn1_draw_customers"](spark, folder).count() == 400
    w = warehouse(spark, folder)
    assert set(w._bronze) == {"customers"}
    w.customer_360
    assert set(w._bronze) == set(features.TABLES)
    w.close()
