"""Retention page: risk zones, contact lists, open complaints, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows
from clientele.operators.features import ID
from clientele.operators.reports.common import money

# Columns of the exported lists.
EXPORT_COLUMNS = (
    "customer_id", "full_name", "segment", "risque_composite", "recency_jours", "nb_reclamations_ouvertes",
    "solde_total_xof", "next_best_action",
)
ZONES = ("rouge", "ambre", "reclamations")


def zone(red: float = 70, amber: float = 40, inclusive: bool = False) -> Column:
    """Zone of a risk score; ``inclusive`` decides whether the red cut itself is red."""
    score = F.col("risque_composite")
    is_red = score >= red if inclusive else score > red
    return F.when(is_red, "rouge").when(score >= amber, "ambre").when(score < amber, "vert")


def risk_zones(c360: DataFrame, red: float = 70, amber: float = 40) -> DataFrame:
    """Customers and balances per zone, red only strictly above its cut."""
    return (
        c360.groupBy(zone(red, amber).alias("zone"))
        .agg(
            count_rows().alias("nb_clients"), money("solde_total_xof").alias("solde"),
            F.count_if(F.col("nb_reclamations_ouvertes") > 0).alias("nb_avec_reclamation"),
        )
    )


def retention_list(c360: DataFrame, nba: DataFrame, which: str, red: float = 70, amber: float = 40) -> DataFrame:
    """Customers of the red or amber zone, or with open complaints, riskiest first."""
    if which not in ZONES:
        raise ValueError(f"retention_list: zone must be one of {ZONES}")
    keep = F.col("nb_reclamations_ouvertes") > 0 if which == "reclamations" else zone(red, amber) == which
    return (
        c360.filter(keep)
        .join(nba.select(ID, "next_best_action"), ID, "left")
        .select(*EXPORT_COLUMNS)
        .orderBy(F.col("risque_composite").desc(), ID)
    )


def export_retention_list(
    c360: DataFrame, nba: DataFrame, which: str, path: str, red: float = 70, amber: float = 40
) -> None:
    """Write a contact list as CSV part files with a header."""
    retention_list(c360, nba, which, red, amber).write.mode("overwrite").option("header", True).csv(path)


def risk_histogram(c360: DataFrame, bins: int = 30) -> DataFrame:
    """Equal bins over 0-100; the top edge belongs to the last bin."""
    number = F.least(F.width_bucket(F.col("risque_composite"), F.lit(0.0), F.lit(100.0), F.lit(bins)), F.lit(bins))
    return c360.groupBy(number.cast("bigint").alias("classe")).agg(count_rows().alias("nb_clients"))


def open_complaints_by_category(complaints: DataFrame) -> DataFrame:
    return complaints.filter(F.col("status") == "Open").groupBy("category", "severity").agg(count_rows().alias("n"))


def complaint_points(c360: DataFrame, complaints: DataFrame) -> DataFrame:
    """Open complaints against risk, one point per customer."""
    opened = complaints.filter(F.col("status") == "Open").groupBy(ID).agg(count_rows().alias("n"))
    return (
        c360.select(ID, "segment", "risque_composite")
        .join(opened, ID, "left")
        .select(ID, "segment", "risque_composite", F.coalesce(F.col("n"), F.lit(0)).alias("n_reclamations_ouvertes"))
    )


def complaints_vs_risk(points: DataFrame) -> DataFrame:
    """Least-squares line through the points and its two ends; all NULL when x takes a single value."""
    x = F.col("n_reclamations_ouvertes").cast("double")
    line = points.agg(
        F.regr_slope("risque_composite", x).alias("pente"),
        F.regr_intercept("risque_composite", x).alias("ordonnee"),
        F.min(x).alias("x_min"), F.max(x).alias("x_max"),
    )
    drawn = F.col("x_min") < F.col("x_max")
    slope, intercept = F.when(drawn, F.col("pente")), F.when(drawn, F.col("ordonnee"))
    return line.select(
        slope.alias("pente"), intercept.alias("ordonnee"),
        (slope * F.col("x_min") + intercept).alias("y_debut"), (slope * F.col("x_max") + intercept).alias("y_fin"),
    )


def ai_zones(c360: DataFrame) -> DataFrame:
    """Action zones with an inclusive red cut, and the share of generated rows in each."""
    synthetic = F.lit(100.0) * F.count_if("is_synthetic").cast("double") / count_rows().cast("double")
    return c360.groupBy(zone(inclusive=True).alias("zone")).agg(
        count_rows().alias("nb_clients"), money("solde_total_xof").alias("solde"), money("nbi_estime_xof").alias("nbi"),
        F.count_if("is_synthetic").alias("nb_synthetiques"), synthetic.alias("part_synthetique_pct"),
    )
