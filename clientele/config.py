"""Business constants, kept in one place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class BusinessRules:
    """Thresholds and weights of the portfolio rules (fixed values unless a caller overrides them)."""

    seed: int = 42
    dpd_threshold_days: int = 15
    churn_recency_days: int = 90
    no_activity_recency: int = 999

    # composite risk weights: recency, open complaints, digital, trend
    risk_recency: float = 0.40
    risk_complaints: float = 0.30
    risk_digital: float = 0.20
    risk_trend: float = 0.10

    # engagement weights: recency, activity, digital, products
    engagement_recency: float = 0.30
    engagement_activity: float = 0.25
    engagement_digital: float = 0.25
    engagement_products: float = 0.20

    # estimated net banking income
    nbi_balance_rate: str = "0.035"
    nbi_per_transaction: int = 500
    nbi_per_account: int = 15000

    salary_upsell_income: int = 500_000
    flag_recency_days: int = 60
    dormant_digital_score: int = 1

    synthetic_customers: int = 400
    synthetic_churn_rate: float = 0.10
    synthetic_shift_days: int = 180

    high_value_segments: tuple[str, ...] = field(default=("Premier", "Affluent"))


RULES = BusinessRules()
SCHEMA_VERSION = 1
