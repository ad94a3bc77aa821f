"""Portfolio page: indicators by segment, value against engagement, segment recap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows, exact_mean, share_pct, whole_table_value
from clientele.operators.reports.common import (
    ACTIVE,
    ACTIVE_DAYS,
    active_rate,
    active_status,
    mean_money,
    money,
    money_if,
    rag,
)

HIGH_BAND_ALERT_PCT = 5.0
HIGH_BAND_COLUMNS = ("customer_id", "full_name", "segment", "city", "solde_total_xof", "recency_jours")


def portfolio_kpis_page(c360: DataFrame, segment: str | None = None) -> DataFrame:
    rows = c360 if segment is None else c360.filter(F.col("segment") == segment)
    totals = rows.agg(
        count_rows().alias("nb_clients"),
        F.count_if(F.col(ACTIVE) <= ACTIVE_DAYS).alias("nb_actifs"),
        active_rate().alias("taux_actifs"),
        money("nbi_estime_xof").alias("nbi_total"),
        money("solde_total_xof").alias("solde_total"),
        share_pct(F.col("risk_band") == "High").alias("taux_risque_eleve"),
    )
    high = F.col("taux_risque_eleve")
    return totals.withColumns(
        {
            "statut_actifs": active_status(F.col("taux_actifs")),
            "statut_risque_eleve": rag(high, (high > 5, "danger"), (high >= 3, "warning"), default="success"),
        }
    )


def balance_at_risk(c360: DataFrame) -> DataFrame:
    """Large balances of inactive customers, and what the high credit band holds."""
    at_risk = (F.col("recency_jours") > 60) & (F.col("solde_total_xof") > 5_000_000)
    high = F.col("risk_band") == "High"
    return c360.agg(
        money_if(at_risk, "solde_total_xof").alias("solde_a_risque"),
        F.count_if(high).alias("nb_risque_eleve"),
        money_if(high, "solde_total_xof").alias("solde_risque_eleve"),
    )


def value_engagement(c360: DataFrame) -> DataFrame:
    """Points of the value/engagement charts with their zones (a later, sharper zone wins)."""
    days, balance = F.col("recency_jours"), F.col("solde_total_xof").cast("double") / 1_000_000
    value_zone = (
        F.when((days > 60) & (balance >= 5), "rouge").when((days > 30) & (balance >= 1), "ambre").when(days <= 30, "vert")
    )
    recency_zone = F.when(days <= 30, "vert").when(days <= 60, "ambre").otherwise("rouge")
    return c360.select(
        "customer_id", "segment", "recency_jours", "score_digital", balance.alias("solde_m"), "nbi_estime_xof",
        value_zone.alias("zone_valeur"), recency_zone.alias("zone_recence"),
    )


def segment_recap(c360: DataFrame) -> DataFrame:
    """Nine aggregates per segment, shares of the portfolio and the action rule, best income first."""
    recap = c360.groupBy("segment").agg(
        F.count("customer_id").alias("nb_clients"),
        money("solde_total_xof").alias("solde_total"),
        mean_money("solde_total_xof").alias("solde_moyen"),
        mean_money("monthly_income_xof").alias("revenu_moyen"),
        active_rate().alias("taux_actifs"),
        exact_mean(F.col("score_digital"), "decimal(5,0)").alias("score_digital_moyen"),
        mean_money("nbi_estime_xof").alias("nbi_estime"),
        money("nbi_estime_xof").alias("nbi_total"),
        exact_mean(F.col("risque_composite"), "decimal(5,1)").alias("risque_composite_moyen"),
    )
    whole = whole_table_value(c360, clients=F.count("customer_id"), balance=F.sum("solde_total_xof"))
    action = (
        F.when(F.col("risque_composite_moyen") > 40, "renforcer_suivi")
        .when(F.col("taux_actifs") < 70, "campagne_reactivation")
        .otherwise("maintenir_relation")
    )

    def share(part: str, total: str):
        return F.lit(100.0) * F.col(part).cast("double") / F.nullif(whole[total].cast("double"), F.lit(0.0))

    return recap.withColumns(
        {
            "action_prioritaire": action,
            "pct_clients": share("nb_clients", "clients"),
            "pct_solde": share("solde_total", "balance"),
        }
    ).orderBy(F.col("nbi_total").desc(), "segment")


def contribution_long(recap: DataFrame) -> DataFrame:
    """Shares of customers and balance as (segment, metric, value)."""
    return recap.unpivot(["segment"], ["pct_clients", "pct_solde"], "metrique", "valeur")


def high_band_list(c360: DataFrame, alert_pct: float = HIGH_BAND_ALERT_PCT) -> DataFrame:
    """Customers of the high credit band, listed only when the band exceeds its share of the portfolio."""
    high = F.col("risk_band") == "High"
    share = whole_table_value(c360, pct=share_pct(high))
    return c360.filter(high & (share["pct"] > alert_pct)).select(*HIGH_BAND_COLUMNS)


def real_high_band(c360: DataFrame, segment: str = "Premier") -> DataFrame:
    """Observed customers of a segment in the high credit band, with their number and total balance."""
    rows = c360.filter(~F.col("is_synthetic") & (F.col("segment") == segment) & (F.col("risk_band") == "High"))
    totals = whole_table_value(rows, n=count_rows(), balance=money("solde_total_xof"))
    return rows.select(
        "customer_id", "full_name", "segment", "solde_total_xof", "risque_composite",
        totals["n"].alias("nb_clients"), totals["balance"].alias("solde_cumule"),
    )
