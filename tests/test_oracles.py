"""Every query with an oracle gives what DuckDB gives on the smallest tables."""

import duckdb
import pytest
from compare import TABLES, rows

from clientele.catalog import QUERIES
from clientele.oracle.catalog import ORACLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck(bank):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLES[name])
    columns, expected = [c[0] for c in result.description], result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, expected)
