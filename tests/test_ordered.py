"""Two-level running totals, ranks and quantiles against brute force, also on skewed values."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clientele.functions.columns import portable_hash, round_half_up
from clientele.functions.ordered import exact_quantiles, hash_rank, prefix_sums


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, the others are spread unevenly."""
    random.seed(1)
    values = [0.0] * 400 + [random.expovariate(0.01) for _ in range(600)] + [round(random.gauss(0, 3)) * 1.0 for _ in range(200)]
    rows = [(f"g{i % 3 if i % 5 else 0}", v) for i, v in enumerate(values)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(7)


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums(skewed, descending):
    rows, df = skewed
    counts = df.groupBy("v").agg(F.count("*").alias("n"))
    found = {r["v"]: r["cum_n"] for r in prefix_sums(counts, "v", ["n"], descending=descending, ranges=16).collect()}
    values = [v for _, v in rows]
    expected = {v: sum(1 for x in values if (x >= v if descending else x <= v)) for v in set(values)}
    assert found == expected


def test_quantiles_by_group(skewed):
    rows, df = skewed
    wanted = {"lo": 0.0, "q1": 0.25, "m": 0.5, "p99": 0.99, "hi": 1.0}
    found = {r["g"]: r for r in exact_quantiles(df, "v", wanted, ["g"]).collect()}
    for g in found:
        own = [v for x, v in rows if x == g]
        for name, p in wanted.items():
            assert found[g][name] == pytest.approx(np.quantile(own, p), abs=1e-9)


def test_quantiles_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, "v", {"m": 0.5}).first()["m"] is None
    one = spark.createDataFrame([(None,), (4.0,), (4.0,)], "v double")
    assert exact_quantiles(one, "v", {"m": 0.5}).first()["m"] == 4.0


def test_hash_rank_is_a_dense_order_inside_each_group(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("y")).withColumn(
        "h", portable_hash(7, F.col("k"))
    )
    ranked = hash_rank(df, "h", "k", ["y"]).collect()
    for y in (0, 1):
        own = sorted((r for r in ranked if r["y"] == y), key=lambda r: (r["h"], r["k"]))
        assert [r["rank"] for r in own] == list(range(1, 2501))


def test_groups_without_a_name_are_groups(spark):
    rows = [(None if i % 3 == 0 else f"g{i % 2}", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r["g"]: r["m"] for r in exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert found == {g: np.quantile([v for x, v in rows if x == g], 0.5) for g in (None, "g0", "g1")}
    ranked = hash_rank(df.withColumn("h", portable_hash(1, F.col("v"))), "h", "v", ["g"]).collect()
    assert sorted(r["rank"] for r in ranked if r["g"] is None) == list(range(1, 101))


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")


def test_ranges_share_the_window_s_exchange(spark):
    """Offsets are joined where the rows already are: by (group, range), as the windows deal them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"))
        assert exchanges(hash_rank(df.withColumn("h", portable_hash(7, F.col("k"))), "h", "k", ["y"])) <= 4
        counts = df.groupBy("k").agg(F.count("*").alias("n"))
        assert exchanges(prefix_sums(counts, "k", ["n"])) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).first()["m"] == pytest.approx(np.quantile(values, 0.5), rel=1e-9, abs=1e-6)


def test_half_up_rounding_is_symmetric(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.05,), (-0.04,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"))).collect()] == [3.0, -3.0, 0.0, 0.0, None]
