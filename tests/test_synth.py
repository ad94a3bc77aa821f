import pytest
from pyspark.sql import functions as F

from clientele.operators import synth
from clientele.sources.schemas import COLUMNS


@pytest.fixture(scope="module")
def cohort(bank):
    return synth.synthesize(bank.observed(), n=50, churn_rate=0.10, seed=42)


def test_volume_and_flags(cohort):
    assert cohort["customers"].count() == 50
    for table in ("customers", "accounts", "transactions", "loans"):
        assert cohort[table].filter("not is_synthetic").isEmpty()


def test_transactions_stay_on_copied_accounts(cohort):
    for table in ("transactions", "cards"):
        assert cohort[table].join(cohort["accounts"], ["account_id", "customer_id"], "left_anti").isEmpty()


def test_ids_are_unique_and_rows_complete(bank, cohort):
    draws = synth.draw_customers(bank.observed()["customers"], 50, 42)
    for table, key in (("accounts", "account_id"), ("transactions", "txn_id"), ("offers", "offer_id")):
        assert cohort[table].count() == cohort[table].select(key).distinct().count()
    sources = bank.observed()["offers"].join(draws, F.col("customer_id") == F.col("source_customer_id"))
    assert cohort["offers"].count() == sources.count()


def test_same_seed_same_cohort(bank):
    observed = bank.observed()["customers"]
    first, second = (sorted(map(tuple, synth.draw_customers(observed, 30, 42).collect())) for _ in range(2))
    assert first == second
    assert first != sorted(map(tuple, synth.draw_customers(observed, 30, 43).collect()))


def test_customer_drawn_twice_gets_two_copies(spark, bank):
    observed = bank.observed()
    single = observed["customers"].orderBy("customer_id").limit(1)
    draws = synth.draw_customers(single, 3, 1)
    assert draws.select("source_customer_id").distinct().count() == 1
    copies = synth.remap_accounts(draws, observed["accounts"])
    own = observed["accounts"].join(single, "customer_id", "left_semi").count()
    assert copies.count() == 3 * own and copies.select("account_id").distinct().count() == 3 * own


def test_empty_table_keeps_its_schema(bank):
    observed = bank.observed()
    observed["loans"] = observed["loans"].filter("false")
    cohort = synth.synthesize(observed, n=5)
    assert cohort["loans"].columns == [*COLUMNS["loans"], "is_synthetic"] and cohort["loans"].isEmpty()


def test_churn_moves_the_chosen_customers_only(bank):
    txn, cust = bank.source("transactions"), bank.source("customers")
    moved = synth.inject_churn(txn, cust, rate=0.1, seed=42)
    both = txn.select("txn_id", F.col("txn_datetime").alias("before"), "customer_id").join(
        moved.select("txn_id", F.col("txn_datetime").alias("after")), "txn_id"
    )
    chosen = {r[0] for r in synth.churned_customers(cust, 0.1, 42).collect()}
    assert len(chosen) == int(cust.count() * 0.1)
    gaps = both.select("customer_id", F.datediff("before", "after").alias("days")).distinct().collect()
    assert all(g["days"] == (180 if g["customer_id"] in chosen else 0) for g in gaps)
    assert synth.churned_customers(cust, 0.0, 42).count() == 1


def test_ks_distance(spark):
    a = spark.createDataFrame([(float(x),) for x in range(10)] + [(None,)], "v double")
    b = spark.createDataFrame([(float(x),) for x in range(5, 15)], "v double")
    row = synth.ks_2samp(a, b, "v").first()
    assert (row["n_a"], row["n_b"], row["statistique"]) == (10, 10, 0.5)
    same = synth.ks_2samp(a, a, "v").first()
    assert same["statistique"] == 0.0 and same["p_value"] == 1.0


def test_a_customer_with_a_third_of_the_rows_is_spread(spark):
    from clientele.functions.spread import heavy_keys, spread_join

    n = 30_000
    rows = spark.range(n).select(
        "id", F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("k")
    ).unionAll(spark.createDataFrame([(n, None)], "id bigint, k string"))
    other = spark.range(5000).select(F.concat(F.lit("c"), F.col("id")).alias("o"), F.lit(1).alias("v")).unionAll(
        spark.createDataFrame([("hot", 1), ("hot", 2), ("absent", 1)], "o string, v int")
    )
    assert [r["k"] for r in heavy_keys(rows, "k").collect()] == ["hot"]
    saved = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            joined = spread_join(rows, other, "k", "o", F.col("id"), how)
            plain = rows.join(other, F.col("k") == F.col("o"), how)
            assert joined.columns == plain.columns
            assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
            sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
            assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    finally:
        for c, value in saved.items():
            spark.conf.set(c, value)
    assert spread_join(rows.limit(0), other, "k", "o", F.col("id")).isEmpty()


def test_cohort_churn_equals_moving_its_transactions(bank):
    observed = bank.observed()
    cohort = synth.synthesize(observed, n=40, churn_rate=0.25, seed=7)
    draws = synth.draw_customers(observed["customers"], 40, 7)
    plain = synth.remap_by_account(observed["transactions"], synth.account_map(draws, observed["accounts"]), "transactions")
    moved = synth.inject_churn(plain, cohort["customers"], 0.25, 7)
    assert cohort["transactions"].exceptAll(moved).isEmpty() and moved.exceptAll(cohort["transactions"]).isEmpty()
    assert not moved.exceptAll(plain).isEmpty()
