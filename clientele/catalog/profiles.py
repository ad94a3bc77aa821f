"""Data quality, exploratory and synthetic-cohort queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.catalog.core import Query
from clientele.functions.columns import round_doubles
from clientele.operators import eda, features, quality, synth
from clientele.plans.warehouse import Warehouse, warehouse

QUERIES: dict[str, Query] = {}


def over(name, digits=6):
    def register(build):
        QUERIES[name] = lambda spark, source_dir: round_doubles(build(warehouse(spark, source_dir)), digits)
        return build

    return register


# Data quality
over("dq1_validation")(lambda w: eda.union_all([quality.validation(df, t) for t, df in w.sources().items()]))
over("dq2_schema_check")(
    lambda w: quality.check_schema(
        {t: df.drop("occupation", "severity") for t, df in w.sources().items() if t != "cards"}
    )
)
over("dq3_not_null")(lambda w: quality.not_null(w.source("customers"), "occupation").select("customer_id", "segment"))
over("dq4_unique")(lambda w: quality.unique(w.source("transactions"), "account_id"))
over("dq5_accepted_values")(
    lambda w: quality.accepted_values(w.source("transactions"), "txn_type", ["bill_payment", "card_purchase", "salary_credit"])
)
over("dq6_relationships")(
    lambda w: quality.relationships(w.source("transactions"), "account_id", w.source("cards"), "account_id")
)
over("dq7_action_filled")(
    lambda w: quality.expect(w.nba, quality.blank("next_best_action")).select("customer_id", "next_best_action")
)
over("dq7_blank_values")(lambda w: quality.expect(w.source("customers"), quality.blank("occupation")).select("customer_id"))
over("dq8_risk_bounds")(
    lambda w: quality.expect(w.customer_360, quality.outside_bounds("risque_composite", 0, 100)).select(
        "customer_id", "risque_composite"
    )
)
over("dq8_risk_bounds_5_40")(
    lambda w: quality.expect(w.customer_360, quality.outside_bounds("risque_composite", 5, 40)).select(
        "customer_id", "risque_composite"
    )
)
over("dq9_rule_suite")(lambda w: quality.run_suite(w.tested()))


@over("dq9_rule_suite_strict")
def _(w: Warehouse):
    """Stricter rules that the data violates, so that the counting itself is checked."""
    rules = [
        quality.Rule("unique", "stg_transactions", "customer_id"),
        quality.Rule("not_null", "stg_transactions", "channel_id"),
        quality.Rule("accepted_values", "stg_transactions", "txn_type", ("bill_payment", "salary_credit")),
        quality.Rule("accepted_values", "stg_transactions", "direction", ("IN",)),
        quality.Rule("not_null", "stg_transactions", "merchant_category"),
        quality.Rule("relationships", "stg_transactions", "account_id", parent=("stg_cards", "account_id")),
        quality.Rule("not_null", "stg_customers", "occupation"),
        quality.Rule("accepted_values", "stg_customers", "segment", ("Mass",)),
    ]
    tables = {f"stg_{t}": w.table(t) for t in ("transactions", "cards", "customers")}
    return quality.run_suite(tables, rules)


over("dq10_orphan_matrix")(lambda w: quality.orphan_matrix(w.sources()))


@over("dq10_orphan_matrix_broken")
def _(w: Warehouse):
    """The same matrix with half of the parents renamed, to check that orphans are counted."""
    tables = w.sources()
    tables["customers"] = tables["customers"].withColumn(
        "customer_id", F.when(F.col("gender") == "F", F.col("customer_id")).otherwise(F.concat(F.col("customer_id"), F.lit("x")))
    )
    return quality.orphan_matrix(tables)


over("dq11_null_profile")(lambda w: quality.null_profile(w.sources()))
over("dq11_null_profile_observed")(lambda w: quality.null_profile_of(w.bronze("customers").sparkSession, w.counts()))
over("dq11_dup_profile")(lambda w: quality.dup_profile(w.sources()))


@over("dq11_dup_profile_doubled")
def _(w: Warehouse):
    tables = w.sources()
    return quality.dup_profile({t: df.unionAll(df) if t in ("loans", "transactions") else df for t, df in tables.items()})




@over("dq12_lineage")
def _(w: Warehouse):
    """Row counts that the warehouse has taken already."""
    counts = {t: of["rows"] for t, of in w.counts().items()}
    rows = quality.lineage_rows(w.bronze("customers").sparkSession, counts, "star_schema")
    return quality.latest_lineage(rows).drop("updated_at")



over("dq13_iqr_outliers")(lambda w: quality.outlier_profile(w.sources()))
over("dq14_loan_status_conflicts")(lambda w: quality.loan_status_conflicts(w.source("loans")))
over("dq14_worst_arrears")(lambda w: quality.worst_arrears(w.source("loans")))
over("dq15_salary_flag_conflicts")(
    lambda w: quality.salary_flag_conflicts(w.source("accounts"), w.source("transactions"))
)

# Exploratory profiles
over("eda1_table_sizes")(lambda w: eda.table_sizes(w.sources()))
VALUE_COUNTS = (
    ("customers", "segment", None), ("customers", "risk_band", None), ("customers", "city", 8),
    ("accounts", "account_type", None), ("transactions", "txn_type", None), ("interactions", "sentiment", None),
    ("complaints", "status", None), ("complaints", "severity", None),
)
for _table, _column, _k in VALUE_COUNTS:
    over(f"eda2_{_table}_{_column}")(lambda w, t=_table, c=_column, k=_k: eda.value_counts(w.source(t), c, k))
DIGITAL = ["mobile_app_active", "internet_banking_active", "mobile_money_linked"]
over("eda3_digital_rates")(lambda w: eda.boolean_rates(w.source("customers"), DIGITAL))
over("eda3_domiciled_rate")(lambda w: eda.boolean_rates(w.source("accounts"), ["salary_domiciled_flag"]))
over("eda3_resolution_rate")(lambda w: eda.boolean_rates(w.source("interactions"), ["resolved_flag"]))
over("eda4_balance_five_numbers", 4)(lambda w: eda.five_numbers(w.source("accounts"), "account_type", "avg_balance_90d_xof"))
over("eda5_txn_by_channel_group")(lambda w: eda.txn_by_channel_group(w.source("transactions"), w.source("channels")))
over("eda6_recency_describe", 4)(lambda w: eda.describe(eda.observed_recency(w.source("transactions")), "recency_jours"))
over("eda6_recency_histogram")(lambda w: eda.histogram(eda.observed_recency(w.source("transactions")), "recency_jours", 30))


def _trend(w: Warehouse):
    return features.txn_trend(w.source("customers"), w.source("transactions"))


over("eda6_trend_describe", 4)(lambda w: eda.describe(_trend(w), "tendance_transactions"))
over("eda6_negative_trend")(lambda w: eda.negative_trend_count(_trend(w)))
over("eda6_dpd_histogram")(lambda w: eda.histogram(w.source("loans"), "days_past_due", 20))
over("eda7_loan_status_crosstab")(lambda w: eda.loan_status_crosstab(w.table("loans")))
over("eda8_card_holding")(lambda w: eda.card_holding(w.source("customers"), w.source("cards")))
over("eda9_offer_conversion")(lambda w: eda.offer_conversion(w.source("offers")))


def _numbers(w: Warehouse):
    return eda.customer_numbers(*(w.source(t) for t in ("customers", "transactions", "accounts", "complaints")))


over("eda10_customer_numbers")(_numbers)
over("eda10_correlations")(lambda w: eda.correlations(_numbers(w)))


# Synthetic cohort
def _draws(w: Warehouse):
    return synth.draw_customers(w.observed_rows("customers"))


over("syn1_draw_customers")(_draws)
over("syn1_copy_customers")(lambda w: synth.copy_customers(w.observed_rows("customers"), _draws(w)))
over("syn2_remap_accounts")(lambda w: synth.remap_accounts(_draws(w), w.observed_rows("accounts")))
for _table in synth.BY_ACCOUNT:
    over(f"syn3_remap_{_table}")(
        lambda w, t=_table: synth.remap_by_account(
            w.observed_rows(t), synth.account_map(_draws(w), w.observed_rows("accounts")), t
        )
    )
for _table in synth.BY_CUSTOMER:
    over(f"syn4_remap_{_table}")(lambda w, t=_table: synth.remap_by_customer(w.observed_rows(t), _draws(w), t))
over("syn5_inject_churn")(
    lambda w: synth.inject_churn(w.source("transactions"), w.source("customers")).select("txn_id", "customer_id", "txn_datetime")
)


@over("syn6_ks_income")
def _(w: Warehouse):
    observed, generated = w.twins("customers")
    return synth.ks_2samp(observed, generated, "monthly_income_xof")


@over("syn7_cohort_rows")
def _(w: Warehouse):
    return eda.table_sizes(synth.synthesize(w.observed()))
