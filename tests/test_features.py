from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from clientele.operators import features, marts, staging
from clientele.sources.schemas import struct_type

REF = datetime(2025, 12, 31, 12, 0)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("C1",), ("C2",), ("C3",)], "customer_id string")


@pytest.fixture(scope="module")
def txn(spark):
    rows = [
        ("T1", "A1", "C1", REF, "card_purchase", "CH1"),
        ("T2", "A1", "C1", REF - timedelta(days=30), "card_purchase", "CH0"),  # on the edge: previous window
        ("T3", "A1", "C1", REF - timedelta(days=29, hours=23), "salary_credit", "CH0"),
        ("T4", "A1", "C1", REF - timedelta(days=90), "card_purchase", "CH1"),
        ("T5", "A2", "C2", REF - timedelta(days=200), "bill_payment", None),
        ("T6", "A2", "C2", REF - timedelta(days=201), "bill_payment", "CH9"),
    ]
    return spark.createDataFrame(
        rows, "txn_id string, account_id string, customer_id string, txn_datetime timestamp_ntz, txn_type string, channel_id string"
    )


@pytest.fixture(scope="module")
def channels(spark):
    return spark.createDataFrame([("CH0", "Mobile App"), ("CH1", "ATM")], "channel_id string, channel_name string")


def rows(df, *columns):
    return {r["customer_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_recency_and_sentinel(customers, txn):
    assert rows(features.recency(customers, txn), "recency_jours") == {"C1": (0,), "C2": (200,), "C3": (999,)}


def test_recency_counts_calendar_days(spark, customers):
    txn = spark.createDataFrame(
        [("C1", datetime(2025, 1, 1, 23, 59)), ("C2", datetime(2025, 1, 2, 0, 1))], "customer_id string, txn_datetime timestamp_ntz"
    )
    assert rows(features.recency(customers, txn), "recency_jours")["C1"] == (1,)


def test_trend_windows(customers, txn):
    found = rows(
        features.txn_trend(customers, txn), "nb_txn_recent_30j", "nb_txn_precedent_30j", "tendance_transactions", "nb_txn_90j", "tendance_3m"
    )
    assert found == {"C1": (2, 1, 1, 3, 2), "C2": (0, 0, 0, 0, 0), "C3": (0, 0, 0, 0, 0)}


def test_majority_channel_breaks_ties_by_name_with_missing_last(spark, customers, txn, channels):
    assert rows(features.majority_channel(customers, txn, channels), "canal_majoritaire") == {
        "C1": ("ATM",), "C2": (None,), "C3": (None,)
    }
    tied = txn.filter("txn_id in ('T1', 'T5')").withColumn("customer_id", txn["customer_id"].substr(1, 1))
    only = spark.createDataFrame([("C",)], "customer_id string")
    assert rows(features.majority_channel(only, tied, channels), "canal_majoritaire") == {"C": ("ATM",)}


def test_profile_agrees_with_single_operators(bank):
    """The fused pass gives what the separate operators give."""
    txn, cust = bank.table("transactions"), bank.table("customers")
    fused = rows(bank.customer_features, "recency_jours", "tendance_transactions", "nb_txn_90j", "tendance_3m", "canal_majoritaire")
    recency = rows(features.recency(cust, txn), "recency_jours")
    trend = rows(features.txn_trend(cust, txn), "tendance_transactions", "nb_txn_90j", "tendance_3m")
    channel = rows(features.majority_channel(cust, txn, bank.table("channels")), "canal_majoritaire")
    assert fused == {c: recency[c] + trend[c] + channel[c] for c in fused}
    assert len(fused) == cust.count()


def test_salary_correction_keeps_unknown_flags(spark, txn):
    schema = struct_type("accounts", with_flag=True)

    def account(name, flag):
        return (name, "C", "Current", "XOF", date(2020, 1, 1), "Open", "B1", Decimal(1), Decimal(1), flag, Decimal(0), False)

    real = spark.createDataFrame([account("A1", False), account("A2", False), account("A3", None), account("A4", True)], schema)
    fixed = staging.stg_accounts(real, None, txn)
    assert {r["account_id"]: r["salary_domiciled_corrige"] for r in fixed.collect()} == {
        "A1": True, "A2": False, "A3": None, "A4": True
    }


def test_unknown_income_is_no_upsell_unless_salary_rules_it_out(spark):
    df = spark.createDataFrame(
        [("a", "Mass", 1, False, 2, 0, 1, None), ("b", "Mass", 1, True, 2, 0, 1, None), ("c", "Mass", 1, False, 2, 0, 1, Decimal(500000))],
        "customer_id string, segment string, recency_jours bigint, salaire_domicilie boolean, score_digital bigint, "
        "nb_reclamations_ouvertes bigint, nb_cartes bigint, monthly_income_xof decimal(15,2)",
    )
    assert rows(marts.opportunity_flags(df), "is_salary_upsell_opportunity") == {"a": (None,), "b": (False,), "c": (True,)}


def test_action_priority(spark):
    flags = ", ".join(f"{f} boolean" for f in marts.FLAGS)
    df = spark.createDataFrame(
        [("a", "Mass", True, True, True, True, True, 1.0), ("b", "Mass", False, False, False, False, False, 1.0),
         ("c", "Mass", False, True, False, True, None, 1.0)],
        f"customer_id string, segment string, {flags}, risque_composite double",
    )
    found = rows(marts.next_best_action(df), "next_best_action")
    assert found["a"][0] == marts.ACTIONS[0][1] and found["b"][0] == marts.NO_ACTION and found["c"][0] == marts.ACTIONS[3][1]


def test_mart_has_its_contract_columns(bank):
    assert bank.customer_360.columns == list(marts.CUSTOMER_360_COLUMNS)
    assert bank.customer_360.select("customer_id").distinct().count() == bank.customer_360.count()


def test_tagging_leaves_existing_flags(spark):
    df = spark.createDataFrame([(True,)], "is_synthetic boolean")
    assert staging.tag_real(df).first()[0] is True
    assert staging.tag_real(df.withColumnRenamed("is_synthetic", "x")).first()["is_synthetic"] is False


def test_hot_customer_counts_exactly(spark, channels):
    """One customer holding a third of all rows, spread over many partitions."""
    from pyspark.sql import functions as F

    n = 30000
    txn = (
        spark.range(n, numPartitions=16)
        .select(
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 500)).alias("customer_id"),
            (F.lit(REF).cast("timestamp_ntz") - F.make_dt_interval((F.col("id") % 200).cast("int"))).alias("txn_datetime"),
            F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("CH"), F.col("id") % 2)).alias("channel_id"),
        )
    )
    row = features.transaction_profile(txn, channels).filter("customer_id = 'HOT'").first()
    ids = [i for i in range(n) if i % 3 == 0]
    ages = [i % 200 for i in ids]
    assert row["_n_txn"] == len(ids)
    assert row["_r30"] == sum(a < 30 for a in ages) and row["_p30"] == sum(30 <= a < 60 for a in ages)
    assert row["_r90"] == sum(a < 90 for a in ages) and row["_p90"] == sum(90 <= a < 180 for a in ages)
    per_channel = {c: sum(1 for i in ids if i % 7 and i % 2 == k) for k, c in enumerate(["Mobile App", "ATM"])}
    assert row["canal_majoritaire"] == min(per_channel, key=lambda c: (-per_channel[c], c))
