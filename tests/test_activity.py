"""Customer features need no whole transactions: a narrow table holds what they read, with the same results."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientele.plans.warehouse import Warehouse
from clientele.sources.bank_tables import ACTIVITY

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, "
        "l_returnflag string, l_linestatus string"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _lines(orders, days=("1995-01-31", None, "1995-02-01", "1994-11-20")):
    return [
        (k, i, None if i == 5 else 160 * i + i % 2, None if i == 6 else i * 3, days[(k or 0) + i & 3], 10.5 * i, "NR"[i % 2], "F")
        for k in orders for i in range(8)
    ]


@pytest.fixture
def star(spark, tmp_path):
    """Orders and lines with repeated and missing keys; lines of no order carry the last date."""
    rows = {
        "region": [(i, f"R{i}") for i in range(5)],
        "nation": [(i, f"N{i}", i) for i in range(5)],
        "customer": [(i, f"Name{i}", i % 5, 10.0 * i, "MACHINERY" if i % 2 else "BUILDING") for i in range(1, 40)],
        "orders": [(k, c, "F", 99.0, "1995-01-01", "5-LOW") for k, c in ((1, 3), (1, 3), (2, None), (3, 49), (None, 7), (4, 16), (5, 33))],
        "lineitem": _lines((1, 2, 3, 3, 4, 5, None)) + _lines((9,), ("1999-09-09",) * 4),
        "events": [(i, "1995-01-05", i % 9, "error" if i % 3 else "purchase", 1.0, None) for i in range(30)],
    }
    for name, values in rows.items():
        _write(spark, tmp_path, name, values)
    return tmp_path


def _write(spark, folder, name, values, mode="error"):
    given = spark.createDataFrame(values, SCHEMAS[name].replace("timestamp_ntz", "string"))
    typed = given.withColumns({c.split()[0]: F.col(c.split()[0]).cast("timestamp_ntz") for c in SCHEMAS[name].split(", ") if "timestamp" in c})
    typed.write.mode(mode).parquet(str(folder / f"{name}.parquet"))


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_activity_has_the_columns_of_all_staged_transactions(spark, star):
    w = Warehouse.from_star_schema(spark, str(star))
    narrow = w.activity
    assert "transactions" not in w._bronze
    whole = w.table("transactions").select(*ACTIVITY)
    assert narrow.dtypes == whole.dtypes and rows_of(narrow) == rows_of(whole) and narrow.count() > 50
    w.close()


def test_gold_is_the_same_from_narrow_and_from_whole_transactions(spark, star):
    from_narrow, from_whole = (Warehouse.from_star_schema(spark, str(star)) for _ in range(2))
    from_whole.bronze("transactions")
    assert rows_of(from_narrow.customer_360) == rows_of(from_whole.customer_360)
    assert rows_of(from_narrow.accounts) == rows_of(from_whole.accounts)
    assert from_narrow.accounts.filter("salary_domiciled_corrige and not salary_domiciled_flag").count() > 0
    assert "transactions" not in from_narrow._bronze
    dates = [from_narrow.customer_360.select(w.as_of().alias("d")).first()[0] for w in (from_narrow, from_whole)]
    assert dates[0] == dates[1] and dates[0].year == 1995
    from_narrow.close()
    from_whole.close()


def test_new_lines_renew_what_was_built_from_activity_alone(spark, star):
    w = Warehouse.from_star_schema(spark, str(star))
    before, n = w.customer_360, w.activity.count()
    assert w.renew() == [] and w.customer_360 is before
    _write(spark, star, "lineitem", _lines((4,)), "append")
    assert w.renew() == ["transactions"]
    assert w.customer_360 is not before and w.activity.count() == n + 8
    w.bronze("transactions")  # read later than the activity: the older state counts
    _write(spark, star, "lineitem", _lines((5,)), "append")
    assert w.renew() == ["transactions"] and w.activity.count() == n + 16
    w.close()
