"""Min-max scoring over the whole portfolio: composite risk, rule score, engagement, risk levels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import RULES, BusinessRules
from clientele.functions.columns import MONEY_SUM, count_rows, round_half_up, whole_table_value
from clientele.operators.features import ID, as_of, digital_score_column, nbi
from clientele.sources.storage import store

RISK_COLUMNS = ("customer_id", "recency_jours", "nb_reclamations_ouvertes", "score_digital", "tendance_transactions")


@dataclass(frozen=True)
class Signal:
    """One column to bring onto 0-100; ``inverse`` when a high value is good news."""

    column: str
    inverse: bool = False


RISK_SIGNALS = {
    "recency": Signal("recency_jours"),
    "reclamations": Signal("nb_reclamations_ouvertes"),
    "digital": Signal("score_digital", inverse=True),
    "tendance": Signal("tendance_transactions", inverse=True),
}


def _require(df: DataFrame, columns: tuple[str, ...], who: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{who}: missing columns {missing}")


def minmax_0_100(df: DataFrame, signals: dict[str, Signal], scope: DataFrame | None = None) -> DataFrame:
    """Add one 0-100 column per signal; a constant column gives 50, a NULL stays neutral at 50.

    Bounds are taken over ``scope`` (default: ``df`` itself) and enter the plan as one constant struct.
    """
    extremes = {}
    for name, signal in signals.items():
        extremes[f"{name}_lo"] = F.min(signal.column)
        extremes[f"{name}_hi"] = F.max(signal.column)
    bounded = df.withColumn("_bounds", whole_table_value(df if scope is None else scope, **extremes))

    def scaled(name: str, signal: Signal) -> Column:
        low, high = F.col(f"_bounds.{name}_lo"), F.col(f"_bounds.{name}_hi")
        span = F.nullif((high - low).cast("double"), F.lit(0.0))
        direct = F.lit(100.0) * (F.col(signal.column) - low).cast("double") / span
        return F.coalesce(F.lit(100.0) - direct if signal.inverse else direct, F.lit(50.0))

    return bounded.withColumns({n: scaled(n, s) for n, s in signals.items()}).drop("_bounds")


def _weights(rules: BusinessRules) -> dict[str, float]:
    return {
        "recency": rules.risk_recency, "reclamations": rules.risk_complaints,
        "digital": rules.risk_digital, "tendance": rules.risk_trend,
    }


def _weighted_sum(parts: dict[str, float], prefix: str = "_s_") -> Column:
    total: Column | None = None
    for name, weight in parts.items():
        term = F.col(f"{prefix}{name}") * F.lit(weight)
        total = term if total is None else total + term
    return total


def with_risk(
    df: DataFrame, output: str, rules: BusinessRules = RULES, scope: DataFrame | None = None
) -> DataFrame:
    """Add the weighted risk score 0-100, one decimal."""
    signals = {f"_s_{n}": s for n, s in RISK_SIGNALS.items()}
    scored = minmax_0_100(df, signals, scope)
    return scored.withColumn(output, round_half_up(_weighted_sum(_weights(rules)), 1)).drop(*signals)


def composite_risk(df: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    _require(df, RISK_COLUMNS, "composite_risk")
    return with_risk(df.select(*RISK_COLUMNS), "risque_composite", rules).select(ID, "risque_composite")


def rule_score(df: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    """The same formula as a stand-alone scorer."""
    _require(df, RISK_COLUMNS, "rule_score")
    return with_risk(df.select(*RISK_COLUMNS), "score_regles", rules).select(ID, "score_regles")


def decompose_risk(df: DataFrame, customer_id: str | None = None, rules: BusinessRules = RULES) -> DataFrame:
    """Points each signal contributes, for all customers or one (an unknown one raises)."""
    _require(df, RISK_COLUMNS, "decompose_risk")
    signals = {f"_s_{n}": s for n, s in RISK_SIGNALS.items()}
    scored = minmax_0_100(df.select(*RISK_COLUMNS), signals)
    if customer_id is not None:
        scored = scored.filter(F.col(ID) == customer_id)
        if scored.isEmpty():
            raise ValueError(f"decompose_risk: unknown customer {customer_id}")
    points = [round_half_up(F.col(f"_s_{n}") * F.lit(w), 1).alias(n) for n, w in _weights(rules).items()]
    return scored.select(ID, *points)


def risk_level(score: Column) -> Column:
    """Levels with both cuts inclusive: 70 and 40."""
    return F.when(score >= 70, F.lit("high")).when(score >= 40, F.lit("moderate")).otherwise(F.lit("low"))


def engagement_score(
    cust: DataFrame, txn: DataFrame, accounts: DataFrame, interactions: DataFrame, rules: BusinessRules = RULES
) -> DataFrame:
    """Engagement 0-100 from elapsed whole days, activity, digital channels and accounts.

    Unlike the mart's recency this counts elapsed days, and a customer without transactions takes the
    longest inactivity seen. The raw signals are written once: the longest inactivity, the bounds and the
    scores all read them.
    """
    seen = txn.groupBy(ID).agg(F.max("txn_datetime").alias("_last"), count_rows().alias("_txn"))
    elapsed = F.timestamp_diff("DAY", F.col("_last"), as_of(txn))
    parts = (
        cust.select(ID, digital_score_column().alias("_digital_raw"))
        .join(seen, ID, "left")
        .join(interactions.groupBy(ID).agg(count_rows().alias("_contacts")), ID, "left")
        .join(accounts.groupBy(ID).agg(count_rows().alias("_accounts")), ID, "left")
        .select(
            ID, "_digital_raw", elapsed.alias("_elapsed"),
            (F.coalesce(F.col("_txn"), F.lit(0)) + F.coalesce(F.col("_contacts"), F.lit(0))).alias("_activity_raw"),
            F.coalesce(F.col("_accounts"), F.lit(0)).alias("_accounts"),
        )
    )
    parts = store(parts, "engagement_signals")
    longest = whole_table_value(parts, longest=F.max("_elapsed"))
    filled = parts.withColumn("_recency_raw", F.coalesce(F.col("_elapsed"), longest["longest"]))
    signals = {
        "_s_recency": Signal("_recency_raw", inverse=True), "_s_activity": Signal("_activity_raw"),
        "_s_digital": Signal("_digital_raw"), "_s_products": Signal("_accounts"),
    }
    weights = {
        "recency": rules.engagement_recency, "activity": rules.engagement_activity,
        "digital": rules.engagement_digital, "products": rules.engagement_products,
    }
    return minmax_0_100(filled, signals).select(ID, round_half_up(_weighted_sum(weights), 1).alias("score_engagement"))


def nbi_enrichment(cust: DataFrame, accounts: DataFrame, txn: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    """Estimated income marked as an estimate, for the enriched export."""
    return nbi(cust, accounts, txn, rules).select(
        ID, F.col("nbi_estime_xof").cast(MONEY_SUM).alias("nbi_estime_xof"), F.lit(True).alias("estimated_nbi_flag")
    )
