"""Read-only portfolio questions: customers at risk, profile, candidates, indicators, complaints, free SQL."""

from __future__ import annotations

import uuid

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows
from clientele.operators.marts import customer_segments, mean_risk, salary_rate_pct

AT_RISK_COLUMNS = (
    "customer_id", "full_name", "segment", "city", "risque_composite", "recency_jours", "nb_reclamations_ouvertes"
)
CANDIDATE_COLUMNS = ("customer_id", "full_name", "segment", "city", "monthly_income_xof")


def at_risk(c360: DataFrame, segment: str | None = None, k: int = 10) -> DataFrame:
    """The k riskiest customers; ties go to the lower id."""
    rows = c360 if segment is None else c360.filter(F.col("segment") == segment)
    return rows.select(*AT_RISK_COLUMNS).orderBy(F.col("risque_composite").desc(), "customer_id").limit(k)


def profile(c360: DataFrame, nba: DataFrame, customer_id: str) -> DataFrame:
    """One customer with the recommended action; empty when unknown."""
    action = nba.select("customer_id", "next_best_action")
    return c360.filter(F.col("customer_id") == customer_id).join(action, "customer_id", "left")


def is_target() -> Column:
    return F.col("is_cross_sell_target") | F.col("is_salary_upsell_opportunity")


def cross_sell(c360: DataFrame, offers: DataFrame, offer_type: str | None = None, k: int = 10) -> DataFrame:
    """Cross-sell or salary candidates, optionally among customers who received an offer of one type."""
    rows = c360.filter(is_target())
    if offer_type is not None:
        reached = offers.filter(F.col("offer_type") == offer_type).select("customer_id").distinct()
        rows = rows.join(reached, "customer_id", "left_semi")
    return rows.select(*CANDIDATE_COLUMNS).orderBy("customer_id").limit(k)


def portfolio_kpis(c360: DataFrame, segment: str | None = None) -> DataFrame:
    """Segment row of the segment mart, or five indicators of the whole portfolio."""
    if segment is not None:
        return customer_segments(c360.filter(F.col("segment") == segment))
    return c360.agg(
        count_rows().alias("nb_clients"),
        mean_risk().alias("risque_composite_moyen"),
        F.count_if("is_high_value_at_risk").alias("nb_high_value_at_risk"),
        F.count_if("is_cross_sell_target").alias("nb_cross_sell_target"),
        salary_rate_pct().alias("taux_salaire_domicilie_pct"),
    )


def complaint_analysis(complaints: DataFrame, category: str | None = None) -> DataFrame:
    """Complaints by severity and status, and a total row with both NULL (``is_total``).

    The grand total comes from the few grouped rows, not from a second pass.
    """
    rows = complaints if category is None else complaints.filter(F.col("category") == category)
    detail = rows.groupBy("severity", "status").agg(count_rows().alias("n"))
    severity, status = F.col("severity"), F.col("status")
    return (
        detail.groupingSets([[severity, status], []], severity, status)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("nb_reclamations"),
            (F.grouping("severity") == 1).alias("is_total"),
        )
        .orderBy("is_total", "severity", "status")
    )


def query(spark: SparkSession, tables: dict[str, DataFrame], sql: str, **args: object) -> DataFrame:
    """Free read-only SQL over silver and gold tables with bound parameters (``:name``).

    The text stands as a subquery, where no statement that writes can be parsed. The given tables are put in front
    as views that live for the duration of the call only.
    """
    renamed = {name: f"_{uuid.uuid4().hex}_{name}" for name in tables}
    for name, df in tables.items():
        df.createOrReplaceTempView(renamed[name])
    named = ", ".join(f"`{name}` AS (SELECT * FROM `{view}`)" for name, view in renamed.items())
    try:
        return spark.sql(f"WITH {named} SELECT * FROM (\n{sql}\n) AS q" if named else f"SELECT * FROM (\n{sql}\n) AS q", args=args or None)
    except ParseException as error:
        raise ValueError("query: only SELECT statements are allowed") from error
    finally:
        for view in renamed.values():
            spark.catalog.dropTempView(view)
