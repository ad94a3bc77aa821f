"""Behaviour page: digital adoption, activity over time, segment profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows, exact_mean, share_pct
from clientele.operators.features import ID, as_of, with_channel_name
from clientele.operators.reports.common import mean_money, money, rag
from clientele.operators.scoring import Signal, minmax_0_100

# Channels of the adoption matrix and their display group, in display order.
ADOPTION_GROUPS = {
    "Mobile App": "app_mobile",
    "Internet Banking": "internet_banking",
    "ATM": "agence_dab",
    "Agent / Mobile Money": "mobile_money",
}
SEGMENT_ORDER = ("Mass", "Affluent", "Premier", "Youth")
MONTH = "txn_month"


def engagement_kpis(c360: DataFrame) -> DataFrame:
    any_channel = F.col("mobile_app_active") | F.col("internet_banking_active") | F.col("mobile_money_linked")
    dormant = F.col("score_digital") <= 1
    totals = c360.agg(
        share_pct(any_channel).alias("taux_digital"),
        mean_money("avg_balance_90d_xof").alias("solde_moyen_90j"),
        F.count_if(dormant).alias("nb_dormants"),
        share_pct(dormant).alias("part_dormants"),
    )
    adopted, share = F.col("taux_digital"), F.col("part_dormants")
    return totals.withColumns(
        {
            "statut_digital": rag(adopted, (adopted > 80, "success"), (adopted >= 60, "warning"), default="danger"),
            "statut_dormants": rag(share, (share > 30, "danger"), (share > 15, "warning"), default="success"),
        }
    )


def _since(txn: DataFrame, start: Column) -> DataFrame:
    """Transactions from ``start`` on; the month column, where the table is laid out by month, prunes folders."""
    rows = txn.filter(F.col("txn_datetime") >= start)
    return rows.filter(F.col(MONTH) >= F.date_format(start, "yyyy-MM")) if MONTH in txn.columns else rows


def latest_month_txn(txn: DataFrame, reference: Column | None = None) -> DataFrame:
    """Transactions of the month holding the last one, which ``reference`` tells where it is known already."""
    month = F.date_trunc("month", as_of(txn) if reference is None else reference).cast("timestamp_ntz")
    return _since(txn, month).agg(F.max(month.cast("date")).alias("mois"), count_rows().alias("nb_txn"))


def channel_rates(c360: DataFrame, txn: DataFrame, channels: DataFrame) -> DataFrame:
    """Share of each segment's customers seen on each channel, in percent."""
    wanted = channels.filter(F.col("channel_name").isin(*ADOPTION_GROUPS))
    used = txn.select(ID, "channel_id").distinct()
    pairs = with_channel_name(used, wanted, "inner").select(ID, "channel_name").distinct()
    seen = c360.select(ID, "segment").join(pairs, ID).groupBy("segment", "channel_name").agg(count_rows().alias("n"))
    sizes = c360.groupBy("segment").agg(count_rows().alias("nb_clients"))
    rate = F.lit(100.0) * F.col("n").cast("double") / F.col("nb_clients").cast("double")
    return seen.join(sizes, "segment").select("segment", "channel_name", rate.alias("taux"))


def channel_adoption(c360: DataFrame, txn: DataFrame, channels: DataFrame) -> DataFrame:
    """Segment x channel-group matrix."""
    group = F.create_map(*[F.lit(x) for pair in ADOPTION_GROUPS.items() for x in pair])[F.col("channel_name")]
    return (
        channel_rates(c360, txn, channels)
        .filter(F.col("segment").isin(*SEGMENT_ORDER))
        .withColumn("canal", group)
        .groupBy("segment")
        .pivot("canal", list(ADOPTION_GROUPS.values()))
        .agg(F.avg("taux"))
    )


def weakest_channel(matrix: DataFrame) -> DataFrame:
    """Smallest cell of the adoption matrix (first in display order on a tie)."""
    groups = list(ADOPTION_GROUPS.values())
    cells = matrix.unpivot(["segment"], groups, "canal", "taux").filter(F.col("taux").isNotNull())
    rank = F.struct(
        F.col("taux"),
        F.array_position(F.array(*[F.lit(s) for s in SEGMENT_ORDER]), F.col("segment")),
        F.array_position(F.array(*[F.lit(g) for g in groups]), F.col("canal")),
    )
    smallest = F.min_by(F.struct("segment", "canal", "taux"), rank).alias("cell")
    return cells.agg(smallest).select("cell.segment", "cell.canal", "cell.taux")


def digital_by_segment(c360: DataFrame) -> DataFrame:
    score = exact_mean(F.col("score_digital"), "decimal(5,0)").alias("score_digital")
    return c360.groupBy("segment").agg(score).orderBy("score_digital", "segment")


def monthly_volume(txn: DataFrame, reference: Column | None = None) -> DataFrame:
    """Volume of the last twelve months with its least-squares trend; the lowest month is marked.

    At most thirteen grouped rows reach the ordering window.
    """
    start = (as_of(txn) if reference is None else reference) - F.expr("interval 12 months")
    monthly = (
        _since(txn, start)
        .groupBy(F.date_trunc("month", F.col("txn_datetime")).cast("date").alias("mois"))
        .agg(money("amount_xof").alias("volume"))
        .withColumn("volume_m", F.col("volume").cast("double") / 1_000_000)
        .withColumn("indice", F.row_number().over(Window.orderBy("mois")) - 1)
    )
    every_month = Window.partitionBy()
    slope = F.regr_slope("volume_m", "indice").over(every_month)
    intercept = F.regr_intercept("volume_m", "indice").over(every_month)
    lowest = F.min_by("mois", F.struct("volume_m", "mois")).over(every_month)
    return monthly.select(
        "mois", "volume", "volume_m", (slope * F.col("indice") + intercept).alias("tendance_m"),
        (F.col("mois") == lowest).alias("est_creux"),
    )


def monthly_trend(volumes: DataFrame) -> DataFrame:
    """Change from the first to the last month and its label."""
    first, last = F.min_by("volume_m", "mois"), F.max_by("volume_m", "mois")
    change = volumes.agg((F.lit(100.0) * (last - first) / F.nullif(first, F.lit(0.0))).alias("variation_pct"))
    pct = F.col("variation_pct")
    label = F.when(pct > 5, "hausse").when(pct < -5, "baisse").when(pct.isNotNull(), "stable")
    return change.withColumn("tendance", label)


def top_txn_types(txn: DataFrame, k: int = 5) -> DataFrame:
    return (
        txn.groupBy("txn_type")
        .agg(money("amount_xof").alias("volume"), mean_money("amount_xof").alias("montant_moyen"))
        .orderBy(F.col("volume").desc(), "txn_type")
        .limit(k)
    )


def segment_profile(c360: DataFrame, interactions: DataFrame) -> DataFrame:
    """Five radar axes 0-100 per segment; contacts are counted per customer before they meet segments."""
    means = c360.groupBy("segment").agg(
        exact_mean(F.col("nb_txn_90j"), "decimal(18,0)").alias("_activity"),
        (exact_mean(F.col("score_digital"), "decimal(5,0)") / 3 * 100).alias("digital"),
        exact_mean(F.col("anciennete_jours"), "decimal(18,0)").alias("_tenure"),
        mean_money("solde_total_xof").alias("_value"),
    )
    per_customer = interactions.groupBy(ID).agg(
        F.count_if(F.col("sentiment") == "Positive").alias("pos"), F.count_if(F.col("sentiment") == "Negative").alias("neg")
    )
    mood = (
        c360.select(ID, "segment").join(per_customer, ID).groupBy("segment")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    rate = F.lit(100.0) * F.col("pos").cast("double") / F.nullif((F.col("pos") + F.col("neg")).cast("double"), F.lit(0.0))
    axes = {"activite": Signal("_activity"), "fidelite": Signal("_tenure"), "valeur": Signal("_value")}
    return (
        minmax_0_100(means, axes)
        .join(mood, "segment", "left")
        .select("segment", "activite", "digital", "fidelite", "valeur", F.coalesce(rate, F.lit(50.0)).alias("satisfaction"))
    )

