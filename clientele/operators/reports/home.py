"""Home page: headline indicators, alerts, priority actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows, exact_mean
from clientele.operators.reports.common import ACTIVE, ACTIVE_DAYS, active_rate, active_status, money, rag
from clientele.operators.serve import is_target


def home_kpis(c360: DataFrame) -> DataFrame:
    """Active customers, total balance, open complaints (their sum) and mean risk with their statuses."""
    totals = c360.agg(
        count_rows().alias("nb_clients"),
        F.count_if(F.col(ACTIVE) <= ACTIVE_DAYS).alias("nb_actifs"),
        active_rate().alias("taux_actifs"),
        money("solde_total_xof").alias("solde_total"),
        F.sum("nb_reclamations_ouvertes").alias("reclamations_ouvertes"),
        exact_mean(F.col("risque_composite"), "decimal(5,1)").alias("risque_moyen"),
    )
    complaints, risk = F.col("reclamations_ouvertes"), F.col("risque_moyen")
    return totals.withColumns(
        {
            "statut_actifs": active_status(F.col("taux_actifs")),
            "statut_reclamations": rag(
                complaints, (complaints > 5, "danger"), (complaints >= 3, "warning"), default="success"
            ),
            "statut_risque": rag(risk, (risk >= 70, "danger"), (risk >= 40, "warning"), default="success"),
        }
    )


def vip_alert(c360: DataFrame, risk_cut: float = 70) -> DataFrame:
    """Premier customers above the cut and the balance they hold."""
    vip = c360.filter((F.col("segment") == "Premier") & (F.col("risque_composite") > risk_cut))
    return vip.agg(count_rows().alias("nb_vip"), money("solde_total_xof").alias("solde_vip"))


def opportunity_alert(c360: DataFrame) -> DataFrame:
    return c360.filter(is_target()).agg(
        count_rows().alias("nb_opportunites"), money("nbi_estime_xof").alias("nbi_opportunites")
    )


def priority_actions(c360: DataFrame) -> DataFrame:
    """Five counters in long form, smallest first."""
    counters = {
        "sans_carte": F.count_if(F.col("nb_cartes") == 0),
        "risque_credit_eleve": F.count_if(F.col("risk_band") == "High"),
        "reclamations_ouvertes": F.coalesce(F.sum("nb_reclamations_ouvertes"), F.lit(0)),
        "forte_valeur_a_risque": F.count_if("is_high_value_at_risk"),
        "reclamation_desengagement": F.count_if("is_complaints_churn_risk"),
    }
    wide = c360.agg(*[c.alias(n) for n, c in counters.items()])
    return wide.unpivot([], list(counters), "action", "n").orderBy("n", "action")
