"""Sources, staging, features, marts, scores, serving and semantic queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.columns import round_doubles
from clientele.operators import features, marts, scoring, semantic, serve, staging
from clientele.operators.reports import opportunities, retention
from clientele.plans.warehouse import Warehouse, warehouse
from clientele.sources.schemas import TABLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def over(name: str) -> Callable[[Callable[[Warehouse], DataFrame]], Callable[[Warehouse], DataFrame]]:
    """Register a query written against a warehouse."""

    def register(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        QUERIES[name] = lambda spark, source_dir: build(warehouse(spark, source_dir))
        return build

    return register


def _register_all() -> None:
    for table in TABLES:
        over(f"stg_{table}")(lambda w, t=table: w.table(t))


_register_all()


@over("src1_table_rows")
def _(w: Warehouse) -> DataFrame:
    counts = [
        w.bronze(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t in TABLES
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


@over("src3_tag_real")
def _(w: Warehouse) -> DataFrame:
    untagged = staging.tag_real(w.bronze("channels").drop("is_synthetic")).select("channel_id", "is_synthetic")
    tagged = staging.tag_real(w.bronze("customers")).select(F.col("customer_id").alias("channel_id"), "is_synthetic")
    return untagged.unionByName(tagged).groupBy("is_synthetic").agg(F.count(F.lit(1)).alias("n"))


@over("src7_red_zone_list")
def _(w: Warehouse) -> DataFrame:
    return retention.retention_list(w.customer_360, w.nba, "rouge")


@over("src7_red_zone_list_cut45")
def _(w: Warehouse) -> DataFrame:
    return retention.retention_list(w.customer_360, w.nba, "rouge", red=45)


@over("src7_amber_zone_list")
def _(w: Warehouse) -> DataFrame:
    return retention.retention_list(w.customer_360, w.nba, "ambre")


@over("src7_open_complaint_list")
def _(w: Warehouse) -> DataFrame:
    return retention.retention_list(w.customer_360, w.nba, "reclamations")


@over("int1_recency")
def _(w: Warehouse) -> DataFrame:
    return features.recency(w.table("customers"), w.table("transactions"), reference=w.as_of())


@over("int2_txn_trend")
def _(w: Warehouse) -> DataFrame:
    return features.txn_trend(w.table("customers"), w.table("transactions"), w.as_of())


@over("int3_complaint_counts")
def _(w: Warehouse) -> DataFrame:
    return features.complaint_counts(w.table("customers"), w.table("complaints"))


@over("int4_digital_score")
def _(w: Warehouse) -> DataFrame:
    return features.digital_score(w.table("customers"))


@over("int5_product_counts")
def _(w: Warehouse) -> DataFrame:
    return features.product_counts(w.table("customers"), w.bronze("accounts"), w.table("cards"))


@over("int6_balances")
def _(w: Warehouse) -> DataFrame:
    return features.balances(w.table("customers"), w.bronze("accounts"))


@over("int7_nbi")
def _(w: Warehouse) -> DataFrame:
    return features.nbi(w.table("customers"), w.bronze("accounts"), w.table("transactions"))


@over("int8_majority_channel")
def _(w: Warehouse) -> DataFrame:
    return features.majority_channel(w.table("customers"), w.table("transactions"), w.table("channels"))


@over("int9_max_dpd")
def _(w: Warehouse) -> DataFrame:
    return features.max_dpd(w.table("customers"), w.table("loans"))


@over("mrt1_customer_features")
def _(w: Warehouse) -> DataFrame:
    return w.customer_features


@over("mrt2_minmax_signals")
def _(w: Warehouse) -> DataFrame:
    names = {f"s_{n}": s for n, s in scoring.RISK_SIGNALS.items()}
    return scoring.minmax_0_100(w.customer_features, names).select("customer_id", *names)


@over("mrt3_composite_risk")
def _(w: Warehouse) -> DataFrame:
    return scoring.composite_risk(w.customer_features)


@over("mrt4_opportunity_flags")
def _(w: Warehouse) -> DataFrame:
    return marts.opportunity_flags(w.customer_features).select("customer_id", *marts.FLAGS)


@over("mrt5_customer_360")
def _(w: Warehouse) -> DataFrame:
    return w.customer_360


@over("mrt6_customer_segments")
def _(w: Warehouse) -> DataFrame:
    return marts.customer_segments(w.customer_360)


@over("mrt7_next_best_action")
def _(w: Warehouse) -> DataFrame:
    return marts.next_best_action(w.customer_360)


@over("scr1_rule_score")
def _(w: Warehouse) -> DataFrame:
    return scoring.rule_score(w.customer_360)


@over("scr2_risk_contributions")
def _(w: Warehouse) -> DataFrame:
    return scoring.decompose_risk(w.customer_360)


@over("scr3_engagement_score")
def _(w: Warehouse) -> DataFrame:
    return scoring.engagement_score(
        w.table("customers"), w.table("transactions"), w.bronze("accounts"), w.table("interactions")
    )


@over("scr4_nbi_enrichment")
def _(w: Warehouse) -> DataFrame:
    return scoring.nbi_enrichment(w.table("customers"), w.bronze("accounts"), w.table("transactions"))


@over("scr5_risk_level")
def _(w: Warehouse) -> DataFrame:
    return w.customer_360.select("customer_id", scoring.risk_level(F.col("risque_composite")).alias("niveau"))


@over("sem1_time_spine_activity")
def _(w: Warehouse) -> DataFrame:
    """The spine over the days of the data, with each day's transactions (days without any stay NULL)."""
    spine = semantic.spine_over(w.bronze("transactions"), "txn_datetime")
    daily = (
        w.bronze("transactions").groupBy(F.col("txn_datetime").cast("date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("nb_txn"))
    )
    return spine.join(daily, "date_day", "left")


ALL_METRICS = semantic.MEASURES


@over("sem2_metrics_total")
def _(w: Warehouse) -> DataFrame:
    return semantic.metric(w.metric_cube, ALL_METRICS)


@over("sem2_metrics_by_segment_band")
def _(w: Warehouse) -> DataFrame:
    return semantic.metric(w.metric_cube, ALL_METRICS, ["segment", "risk_band"])


@over("sem2_metrics_by_flags")
def _(w: Warehouse) -> DataFrame:
    return semantic.metric(w.metric_cube, ALL_METRICS, list(marts.FLAGS))


@over("sem2_metrics_by_day")
def _(w: Warehouse) -> DataFrame:
    """Day grain, with the reference date of the data standing in for the update time."""
    stamped = w.customer_360.withColumn("updated_at", features.as_of(w.activity))
    return semantic.metric(semantic.metric_cube(stamped), ALL_METRICS, ["segment"], grain="day")


@over("srv1_at_risk")
def _(w: Warehouse) -> DataFrame:
    return serve.at_risk(w.customer_360)


@over("srv1_at_risk_premier")
def _(w: Warehouse) -> DataFrame:
    return serve.at_risk(w.customer_360, "Premier", 25)


@over("srv2_profile")
def _(w: Warehouse) -> DataFrame:
    return serve.profile(w.customer_360, w.nba, "C00000007")


@over("srv3_cross_sell")
def _(w: Warehouse) -> DataFrame:
    return serve.cross_sell(w.customer_360, w.table("offers"))


@over("srv3_cross_sell_by_offer")
def _(w: Warehouse) -> DataFrame:
    return serve.cross_sell(w.customer_360, w.table("offers"), "Travel card", 20)


@over("srv4_portfolio_kpis")
def _(w: Warehouse) -> DataFrame:
    return serve.portfolio_kpis(w.customer_360)


@over("srv4_portfolio_kpis_segment")
def _(w: Warehouse) -> DataFrame:
    return serve.portfolio_kpis(w.customer_360, "Premier")


@over("srv5_complaint_analysis")
def _(w: Warehouse) -> DataFrame:
    return serve.complaint_analysis(w.table("complaints"))


@over("srv5_complaint_analysis_category")
def _(w: Warehouse) -> DataFrame:
    return serve.complaint_analysis(w.table("complaints"), "Card")


@over("srv6_free_sql")
def _(w: Warehouse) -> DataFrame:
    tables = {"customer_360": w.customer_360, "stg_loans": w.table("loans")}
    sql = """
        SELECT c.segment, count(*) AS nb_prets, max(l.days_past_due) AS retard_max
        FROM customer_360 c JOIN stg_loans l ON l.customer_id = c.customer_id
        WHERE l.status_corrige = :status GROUP BY c.segment"""
    return serve.query(w.customer_360.sparkSession, tables, sql, status="Delinquent")
