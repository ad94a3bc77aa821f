from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientele.operators import semantic, serve
from clientele.operators.reports import client, engagement, home, opportunities, portfolio, retention


def test_at_risk_limit_and_order(bank):
    scores = [r["risque_composite"] for r in serve.at_risk(bank.customer_360, k=5).collect()]
    assert len(scores) == 5 and scores == sorted(scores, reverse=True)


def test_profile_of_known_and_unknown(bank):
    top = serve.at_risk(bank.customer_360, k=1).first()["customer_id"]
    assert serve.profile(bank.customer_360, bank.nba, top).first()["next_best_action"]
    assert serve.profile(bank.customer_360, bank.nba, "no such client").isEmpty()


def test_cross_sell_limit(bank):
    assert serve.cross_sell(bank.customer_360, bank.table("offers"), k=5).count() <= 5
    reached = serve.cross_sell(bank.customer_360, bank.table("offers"), "Card upgrade", k=1000)
    assert reached.count() == reached.distinct().count()


def test_kpis(bank):
    row = serve.portfolio_kpis(bank.customer_360).first()
    assert row["nb_clients"] == bank.customer_360.count()
    assert serve.portfolio_kpis(bank.customer_360, "Premier").first()["segment"] == "Premier"


def test_complaint_total_is_the_sum_of_its_detail(bank):
    rows = serve.complaint_analysis(bank.table("complaints")).collect()
    total = [r["nb_reclamations"] for r in rows if r["is_total"]]
    assert total == [sum(r["nb_reclamations"] for r in rows if not r["is_total"])]
    none = serve.complaint_analysis(bank.table("complaints"), "no such category").collect()
    assert [r["nb_reclamations"] for r in none] in ([0], [])


def test_free_sql_is_read_only(bank, spark):
    tables = {"customer_360": bank.customer_360}
    found = serve.query(spark, tables, "SELECT count(*) AS n FROM customer_360 WHERE segment = :s", s="Mass")
    assert found.first()["n"] == bank.customer_360.filter("segment = 'Mass'").count()
    with pytest.raises(ValueError):
        serve.query(spark, tables, "DROP VIEW customer_360")


def test_metrics(bank, spark):
    total = semantic.metric(bank.metric_cube, ["nombre_clients"], ["segment"]).agg(F.sum("nombre_clients")).first()[0]
    assert total == bank.customer_360.count()
    with pytest.raises(ValueError):
        semantic.metric(bank.metric_cube, ["unknown"])
    with pytest.raises(ValueError):
        semantic.metric(bank.metric_cube, ["nombre_clients"], ["city"])
    assert semantic.time_spine(spark).count() == 1826
    stamped = bank.customer_360.withColumn("updated_at", F.lit("2024-02-29 10:00:00").cast("timestamp"))
    days = semantic.metric(semantic.metric_cube(stamped), ["nombre_clients"], grain="day", spine=semantic.time_spine(spark))
    assert days.count() == 1826 and days.filter("nombre_clients is not null").count() == 1


@pytest.fixture(scope="module")
def portfolio_rows(spark):
    rows = [
        ("a", "Premier", "High", 71.0, 10, Decimal(6_000_000), 6), ("b", "Premier", "Low", 70.0, 61, Decimal(6_000_000), 0),
        ("c", "Mass", "Low", 40.0, 31, Decimal(1_000_000), 0), ("d", "Mass", "Low", 39.9, 30, Decimal(500_000), 0),
    ]
    return spark.createDataFrame(
        rows, "customer_id string, segment string, risk_band string, risque_composite double, recency_jours bigint, "
              "solde_total_xof decimal(25,2), nb_reclamations_ouvertes bigint"
    )


def test_red_zone_boundary_differs_by_page(portfolio_rows):
    strict = {r["zone"]: r["nb_clients"] for r in retention.risk_zones(portfolio_rows).collect()}
    assert strict == {"rouge": 1, "ambre": 2, "vert": 1}
    inclusive = portfolio_rows.groupBy(retention.zone(inclusive=True).alias("z")).count()
    assert {r["z"]: r["count"] for r in inclusive.collect()} == {"rouge": 2, "ambre": 1, "vert": 1}


def test_vip_alert(portfolio_rows):
    row = home.vip_alert(portfolio_rows).first()
    assert (row["nb_vip"], int(row["solde_vip"])) == (1, 6_000_000)


def test_statuses_of_an_empty_portfolio_are_unknown(portfolio_rows):
    row = home.home_kpis(portfolio_rows.filter("false")).first()
    assert row["nb_clients"] == 0 and row["taux_actifs"] is None and row["statut_actifs"] is None


def test_value_zones(portfolio_rows):
    df = portfolio_rows.withColumn("score_digital", F.lit(1)).withColumn("nbi_estime_xof", F.lit(1))
    zones = {r["customer_id"]: (r["zone_valeur"], r["zone_recence"]) for r in portfolio.value_engagement(df).collect()}
    assert zones == {"a": ("vert", "vert"), "b": ("rouge", "rouge"), "c": ("ambre", "ambre"), "d": ("vert", "vert")}


def test_single_x_draws_no_line(spark):
    points = spark.createDataFrame([("a", 1.0, 0), ("b", 3.0, 0)], "customer_id string, risque_composite double, n_reclamations_ouvertes int")
    assert retention.complaints_vs_risk(points).first()["pente"] is None
    two = spark.createDataFrame([("a", 1.0, 0), ("b", 3.0, 2)], points.schema)
    row = retention.complaints_vs_risk(two).first()
    assert (row["pente"], row["y_debut"], row["y_fin"]) == (1.0, 1.0, 3.0)


def test_unknown_list_raises(bank):
    with pytest.raises(ValueError):
        retention.retention_list(bank.customer_360, bank.nba, "bleue")


def test_search_ignores_accents_and_case(spark):
    df = spark.createDataFrame(
        [("C1", "Awa Koné", "Abidjan", "Mass", 1.0), ("C2", "Luc", "Bouaké", "Premier", 2.0), ("C3", "a.b", "X", "Mass", 3.0)],
        "customer_id string, full_name string, city string, segment string, risque_composite double",
    )
    assert {r[0] for r in client.search(df, "KONE").collect()} == {"C1"}
    assert {r[0] for r in client.search(df, "bouake").collect()} == {"C2"}
    assert {r[0] for r in client.search(df, "a.b").collect()} == {"C3"}  # literal, not a pattern
    assert [r[0] for r in client.search(df, suggestions=2).collect()] == ["C3", "C2"]


def test_potential_without_card_offers_uses_the_means(spark, bank):
    stats = spark.createDataFrame([("Travel card", 10, 0.5, 100.0), ("Savings product", 5, 0.1, 300.0)],
                                  "offer_type string, n bigint, taux_acceptation double, valeur_moyenne double")
    row = opportunities.cross_sell_potential(bank.customer_360, stats).first()
    assert row["potentiel_total"] == pytest.approx(row["nb_upsell"] * 200.0 * 0.3)
    assert opportunities.best_to_second(stats).first()["ratio"] == pytest.approx(5.0)
    assert opportunities.best_to_second(stats.limit(1)).isEmpty()


def test_one_client_equals_its_rows_among_all(bank):
    txn, channels = bank.table("transactions"), bank.table("channels")
    someone = txn.first()["customer_id"]
    everyone = client.recent_txns(txn, channels).filter(F.col("customer_id") == someone)
    assert sorted(map(tuple, client.recent_txns(txn, channels, someone).collect())) == sorted(map(tuple, everyone.collect()))
    months = client.monthly_activity(txn, someone).count()
    assert 1 <= months <= 6


def test_latest_month_uses_the_month_folders(bank):
    pruned = engagement.latest_month_txn(bank.monthly_transactions).first()
    plain = engagement.latest_month_txn(bank.table("transactions")).first()
    assert tuple(pruned) == tuple(plain)
