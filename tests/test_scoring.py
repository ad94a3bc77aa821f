import pytest
from pyspark.sql import functions as F

from clientele.operators import scoring

COLUMNS = "customer_id string, recency_jours bigint, nb_reclamations_ouvertes bigint, tendance_transactions bigint, score_digital bigint"


@pytest.fixture(scope="module")
def two(spark):
    return spark.createDataFrame([("C1", 400, 3, -10, 0), ("C2", 1, 0, 10, 3)], COLUMNS)


def by_id(df, column):
    return {r["customer_id"]: r[column] for r in df.collect()}


def test_dormant_customer_is_riskier(two):
    assert by_id(scoring.composite_risk(two), "risque_composite") == {"C1": 100.0, "C2": 0.0}


def test_missing_columns_raise(spark):
    bare = spark.createDataFrame([("C1",)], "customer_id string")
    for scorer in (scoring.composite_risk, scoring.rule_score, scoring.decompose_risk):
        with pytest.raises(ValueError):
            scorer(bare)


def test_constant_columns_give_the_neutral_score(spark):
    same = spark.createDataFrame([("C1", 5, 0, 0, 2), ("C2", 5, 0, 0, 2)], COLUMNS)
    assert set(by_id(scoring.composite_risk(same), "risque_composite").values()) == {50.0}


def test_null_signal_is_neutral(spark):
    df = spark.createDataFrame([("C1", None, 0, 0, 0), ("C2", 0, 1, 1, 3), ("C3", 10, 0, 0, 0)], COLUMNS)
    scaled = scoring.minmax_0_100(df, {"s": scoring.Signal("recency_jours")})
    assert by_id(scaled, "s") == {"C1": 50.0, "C2": 0.0, "C3": 100.0}


def test_scope_widens_the_bounds(spark, two):
    one = two.filter("customer_id = 'C1'")
    scored = scoring.with_risk(one, "r", scope=two)
    assert by_id(scored, "r") == {"C1": 100.0}


def test_contributions_add_up(bank):
    parts = scoring.decompose_risk(bank.customer_360)
    total = parts.join(bank.customer_360, "customer_id").select(
        F.max(F.abs(F.col("recency") + F.col("reclamations") + F.col("digital") + F.col("tendance") - F.col("risque_composite")))
    )
    assert total.first()[0] <= 0.2 + 1e-9


def test_contributions_of_one_customer(two):
    row = scoring.decompose_risk(two, "C1").first()
    assert (row["recency"], row["reclamations"], row["digital"], row["tendance"]) == (40.0, 30.0, 20.0, 10.0)
    with pytest.raises(ValueError):
        scoring.decompose_risk(two, "nobody")


def test_engagement_covers_every_customer_in_bounds(bank):
    scores = scoring.engagement_score(
        bank.table("customers"), bank.table("transactions"), bank.table("accounts"), bank.table("interactions")
    )
    row = scores.agg(F.count("*").alias("n"), F.min("score_engagement").alias("lo"), F.max("score_engagement").alias("hi")).first()
    assert row["n"] == bank.table("customers").count() and 0 <= row["lo"] <= row["hi"] <= 100


def test_income_estimates_are_flagged(bank):
    found = scoring.nbi_enrichment(bank.table("customers"), bank.table("accounts"), bank.table("transactions"))
    assert found.filter("not estimated_nbi_flag or nbi_estime_xof < 0").isEmpty()


def test_risk_levels_include_their_cuts(spark):
    df = spark.createDataFrame([(69.9,), (70.0,), (40.0,), (39.9,)], "x double")
    levels = [r[0] for r in df.select(scoring.risk_level(F.col("x"))).collect()]
    assert levels == ["moderate", "high", "moderate", "low"]
