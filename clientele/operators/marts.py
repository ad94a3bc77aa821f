"""Gold marts: customer_360, customer_segments and the next best action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import RULES, BusinessRules
from clientele.functions.columns import count_rows, exact_mean, round_half_up
from clientele.operators.features import customer_features
from clientele.operators.scoring import with_risk

FLAGS = (
    "is_high_value_at_risk", "is_digitally_dormant_salary", "is_complaints_churn_risk", "is_cross_sell_target",
    "is_salary_upsell_opportunity",
)

# Column order of the mart.
CUSTOMER_360_COLUMNS = (
    "customer_id", "full_name", "segment", "risk_band", "city", "district", "monthly_income_xof",
    "preferred_channel", "mobile_app_active", "internet_banking_active", "mobile_money_linked",
    "salaire_domicilie", "recency_jours", "tendance_transactions", "nb_txn_30j", "nb_txn_90j", "tendance_3m",
    "nb_reclamations_ouvertes", "nb_reclamations_total", "nb_reclamations_severite_haute", "score_digital",
    "nb_comptes", "nb_cartes", "nb_produits_total", "solde_total_xof", "avg_balance_90d_xof", "nbi_estime_xof",
    "canal_majoritaire", "dpd_max", "anciennete_jours", "risque_composite", *FLAGS, "is_synthetic",
)

# Recommended actions, in order of priority.
ACTIONS = (
    ("is_complaints_churn_risk", "Contacter en priorité - réclamation ouverte et activité en baisse"),
    ("is_high_value_at_risk", "Visite conseiller - client à forte valeur en risque de désengagement"),
    ("is_salary_upsell_opportunity", "Proposer la domiciliation de salaire"),
    ("is_cross_sell_target", "Proposer une carte bancaire"),
    ("is_digitally_dormant_salary", "Relancer sur les canaux digitaux"),
)
NO_ACTION = "Aucune action prioritaire"


def opportunity_flags(df: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    """Add the five portfolio flags; an unknown income keeps its three-valued outcome."""
    inactive = F.col("recency_jours") > rules.flag_recency_days
    salary = F.col("salaire_domicilie")
    return df.withColumns(
        {
            "is_high_value_at_risk": F.col("segment").isin(*rules.high_value_segments) & inactive,
            "is_digitally_dormant_salary": salary & (F.col("score_digital") <= rules.dormant_digital_score),
            "is_complaints_churn_risk": (F.col("nb_reclamations_ouvertes") > 0) & inactive,
            "is_cross_sell_target": F.col("nb_cartes") == 0,
            "is_salary_upsell_opportunity": ~salary & (F.col("monthly_income_xof") >= rules.salary_upsell_income),
        }
    )


def score_features(features: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    """Score and flag customer features; normalisation spans every row given."""
    return opportunity_flags(with_risk(features, "risque_composite", rules), rules).select(*CUSTOMER_360_COLUMNS)


def customer_360(silver: dict[str, DataFrame], rules: BusinessRules = RULES) -> DataFrame:
    """One row per customer. Callers that can write should store the features first (see ``plans.warehouse``):
    the score reads them twice, once for the portfolio's bounds."""
    return score_features(customer_features(silver, rules), rules)


def _flag_sum(name: str) -> Column:
    return F.count_if(F.col(name)).alias(f"nb_{name.removeprefix('is_')}")


def mean_risk() -> Column:
    return round_half_up(exact_mean(F.col("risque_composite"), "decimal(5,1)"), 1)


def salary_rate_pct() -> Column:
    return round_half_up(F.lit(100.0) * F.count_if("salaire_domicilie") / F.nullif(count_rows(), F.lit(0)), 1)


def customer_segments(c360: DataFrame) -> DataFrame:
    return c360.groupBy("segment").agg(
        count_rows().alias("nb_clients"),
        mean_risk().alias("risque_composite_moyen"),
        _flag_sum("is_high_value_at_risk"),
        _flag_sum("is_digitally_dormant_salary"),
        _flag_sum("is_complaints_churn_risk"),
        _flag_sum("is_cross_sell_target"),
        _flag_sum("is_salary_upsell_opportunity"),
        salary_rate_pct().alias("taux_salaire_domicilie_pct"),
        round_half_up(exact_mean(F.col("score_digital"), "decimal(5,0)"), 1).alias("score_digital_moyen"),
    )


def next_best_action(c360: DataFrame) -> DataFrame:
    """First flag that holds, in order of priority."""
    action: Column | None = None
    for flag, text in ACTIONS:
        action = F.when(F.col(flag), F.lit(text)) if action is None else action.when(F.col(flag), F.lit(text))
    return c360.select(
        "customer_id", "segment", action.otherwise(F.lit(NO_ACTION)).alias("next_best_action"), "risque_composite"
    )
