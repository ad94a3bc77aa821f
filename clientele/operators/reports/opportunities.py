"""Opportunities page: offer history, potential, matrix, funnel, call list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows, whole_table_value
from clientele.operators.reports.common import mean_money
from clientele.operators.serve import is_target

CARD_OFFER = "Card upgrade"
SALARY_OFFER = "Domiciliation de salaire"
UPSELL_VALUE_RATE = 0.02


def offer_stats(offers: DataFrame) -> DataFrame:
    """Number of offers, acceptance rate and mean value per type."""
    accepted = F.count_if("accepted_flag").cast("double") / F.count("accepted_flag").cast("double")
    return offers.groupBy("offer_type").agg(
        count_rows().alias("n"), accepted.alias("taux_acceptation"), mean_money("expected_value_xof").alias("valeur_moyenne")
    )


def _card(name: str) -> Column:
    return F.max(F.when(F.col("offer_type") == CARD_OFFER, F.col(name)))


def _offer_benchmarks(stats: DataFrame) -> Column:
    """Mean of rates, mean of values, and the card offer's own rate (else the mean) and value (else 0)."""
    return whole_table_value(
        stats,
        rate=F.avg("taux_acceptation"), value=F.avg("valeur_moyenne"),
        card_rate=F.coalesce(_card("taux_acceptation"), F.avg("taux_acceptation")),
        card_value=F.coalesce(_card("valeur_moyenne"), F.lit(0.0)),
    )


def offer_summary(stats: DataFrame) -> DataFrame:
    """Mean of the types' rates and the best converting type."""
    best = F.max_by("offer_type", F.struct("taux_acceptation", "offer_type"))
    return stats.agg(
        F.avg("taux_acceptation").alias("taux_moyen"), best.alias("meilleure_offre"),
        F.max("taux_acceptation").alias("meilleur_taux"),
    )


def cross_sell_potential(c360: DataFrame, stats: DataFrame) -> DataFrame:
    counts = c360.agg(
        F.count_if("is_cross_sell_target").alias("nb_cross_sell"),
        F.count_if("is_salary_upsell_opportunity").alias("nb_upsell"),
    ).withColumn("_b", _offer_benchmarks(stats))
    cards = F.col("nb_cross_sell") * F.col("_b.card_value") * F.col("_b.card_rate")
    salaries = F.col("nb_upsell") * F.col("_b.value") * F.col("_b.rate")
    return counts.select("nb_cross_sell", "nb_upsell", (cards + salaries).alias("potentiel_total"))


def offer_matrix(stats: DataFrame) -> DataFrame:
    """Quadrant of each offer type around the mean rate and the mean value."""
    points = stats.select(
        "offer_type", "n", (F.lit(100.0) * F.col("taux_acceptation")).alias("taux_pct"),
        (F.col("valeur_moyenne") / 1_000_000).alias("valeur_m"),
    )
    centre = whole_table_value(points, x=F.avg("taux_pct"), y=F.avg("valeur_m"))
    right, top = F.col("taux_pct") >= centre["x"], F.col("valeur_m") >= centre["y"]
    quadrant = (
        F.when(right & top, "priorite_absolue").when(~right & top, "valeur_elevee").when(right, "volume_facile")
        .otherwise("non_prioritaire")
    )
    return points.withColumn("quadrant", quadrant)


def _top_types(stats: DataFrame, k: int) -> DataFrame:
    return stats.orderBy(F.col("n").desc(), "offer_type").limit(k)


def offer_funnel(stats: DataFrame, k: int = 3) -> DataFrame:
    """Targets and acceptances of the k most frequent offer types."""
    accepted = F.round(F.col("n") * F.col("taux_acceptation")).cast("bigint")
    return _top_types(stats, k).select("offer_type", F.col("n").alias("nb_cibles"), accepted.alias("nb_acceptes"), "taux_acceptation")


def best_to_second(stats: DataFrame, k: int = 3) -> DataFrame:
    """How much better the best of the k types converts than the second best (no row with fewer than two)."""
    ranked = F.sort_array(F.collect_list(F.struct("taux_acceptation", "offer_type")), asc=False)
    pair = _top_types(stats, k).agg(ranked.alias("r")).filter(F.size("r") >= 2)
    best, second = F.col("r")[0], F.col("r")[1]
    ratio = F.coalesce(best["taux_acceptation"] / F.nullif(second["taux_acceptation"], F.lit(0.0)), F.lit(1.0))
    return pair.select(best["offer_type"].alias("meilleure"), second["offer_type"].alias("seconde"), ratio.alias("ratio"))


def call_list(c360: DataFrame, stats: DataFrame, segments: Sequence[str] = (), kind: str | None = None) -> DataFrame:
    """Customers to call with offer, probability and value; a customer with both flags gets the card offer."""
    kinds = {"cross_sell": F.col("is_cross_sell_target"), "salary_upsell": F.col("is_salary_upsell_opportunity")}
    rows = c360.filter(is_target())
    if segments:
        rows = rows.filter(F.col("segment").isin(*segments))
    if kind is not None:
        rows = rows.filter(kinds[kind])
    rows = rows.withColumn("_b", _offer_benchmarks(stats))
    card = F.col("is_cross_sell_target")
    probability = F.lit(100.0) * F.when(card, F.col("_b.card_rate")).otherwise(F.col("_b.rate"))
    value = F.when(card, F.col("_b.card_value")).otherwise(F.col("monthly_income_xof").cast("double") * UPSELL_VALUE_RATE)
    band = F.when(F.col("probabilite") > 80, "haute").when(F.col("probabilite") >= 60, "moyenne").otherwise("basse")
    return rows.select(
        "customer_id", "full_name", "segment",
        F.when(card, CARD_OFFER).otherwise(SALARY_OFFER).alias("offre_recommandee"),
        probability.alias("probabilite"), value.alias("valeur_potentielle"), "salaire_domicilie", "preferred_channel",
    ).withColumn("bande_probabilite", band)


def call_list_totals(calls: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum(F.col("valeur_potentielle").cast("decimal(25,6)")).cast("double"), F.lit(0.0))
    return calls.agg(count_rows().alias("nb_clients"), total.alias("montant_total"))


def export_call_list(calls: DataFrame, path: str) -> None:
    """Write the call list as CSV part files with a header."""
    calls.write.mode("overwrite").option("header", True).csv(path)
