"""Profiles from one count of a column's values."""

import statistics

import pytest

from clientele.operators import eda

VALUES = [3.0, 3.0, 1.5, 8.0, -2.0, 4.0]


@pytest.fixture()
def column(spark):
    rows = [("a" if i % 2 else "b", v) for i, v in enumerate(VALUES)] + [("a", float("nan")), ("b", None), (None, 7.0)]
    return spark.createDataFrame(rows, "g string, v double")


def test_describe_leaves_unknown_values_out(column):
    row = eda.describe(column.filter("g is not null"), "v").first()
    assert (row["n"], row["minimum"], row["maximum"]) == (6, -2.0, 8.0)
    assert row["moyenne"] == pytest.approx(statistics.mean(VALUES)) and row["ecart_type"] == pytest.approx(statistics.stdev(VALUES))
    assert row["mediane"] == pytest.approx(statistics.median(VALUES))


def test_describe_of_one_value_and_of_none(column):
    one = eda.describe(column.filter("v = 8"), "v").first()
    assert (one["n"], one["moyenne"], one["ecart_type"]) == (1, 8.0, None)
    none = eda.describe(column.limit(0), "v").first()
    assert (none["n"], none["moyenne"], none["minimum"], none["mediane"]) == (0, None, None, None)


def test_histogram_and_five_numbers_leave_unknown_values_out(column):
    assert {r["classe"]: r["n"] for r in eda.histogram(column, "v", 2).collect()} == {0: 2, 1: 5}
    found = {r["g"]: (r["minimum"], r["maximum"]) for r in eda.five_numbers(column, "g", "v").collect()}
    assert found == {"a": (3.0, 8.0), "b": (-2.0, 3.0)}
