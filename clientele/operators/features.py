"""Customer-grain features: every operator returns one row per customer.

Facts are aggregated by ``customer_id`` before any join, so a customer holding a large share of the rows is
reduced on the map side and joins stay one-to-one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import RULES, BusinessRules
from clientele.functions.columns import MONEY_SUM, count_rows

ID = "customer_id"

#: The staged tables that ``customer_features`` reads, besides a few columns of the transactions.
TABLES = ("customers", "accounts", "loans", "cards", "channels", "complaints")


def as_of(txn: DataFrame) -> Column:
    """Reference date of the portfolio: the last transaction seen, as a one-value subquery."""
    return txn.agg(F.max("txn_datetime").alias("as_of")).scalar()


def _reference(txn: DataFrame, known: Column | None) -> Column:
    return as_of(txn) if known is None else known


def _customers(cust: DataFrame) -> DataFrame:
    return cust.select(ID)


def recency(
    cust: DataFrame, txn: DataFrame, sentinel: int = RULES.no_activity_recency, reference: Column | None = None
) -> DataFrame:
    """Calendar days since the last transaction; ``sentinel`` for customers without any.

    ``reference`` is the as-of date where it is known already; it is looked up in ``txn`` otherwise.
    """
    last = txn.groupBy(ID).agg(F.max("txn_datetime").alias("derniere_txn_datetime"))
    days = F.coalesce(F.datediff(_reference(txn, reference), F.col("derniere_txn_datetime")), F.lit(sentinel))
    return _customers(cust).join(last, ID, "left").select(ID, "derniere_txn_datetime", days.cast("bigint").alias("recency_jours"))


def _window_counts(reference: Column) -> dict[str, Column]:
    when = F.col("txn_datetime")

    def since(days: int) -> Column:
        return reference - F.expr(f"interval {days} days")

    return {
        "_r30": F.count_if(when > since(30)),
        "_p30": F.count_if((when > since(60)) & (when <= since(30))),
        "_r90": F.count_if(when > since(90)),
        "_p90": F.count_if((when > since(180)) & (when <= since(90))),
    }


def _trend_columns() -> list[Column]:
    r30, p30, r90, p90 = (F.coalesce(F.col(c), F.lit(0)) for c in ("_r30", "_p30", "_r90", "_p90"))
    return [
        r30.alias("nb_txn_recent_30j"),
        p30.alias("nb_txn_precedent_30j"),
        (r30 - p30).alias("tendance_transactions"),
        r90.alias("nb_txn_90j"),
        (r90 - p90).alias("tendance_3m"),
    ]


def txn_trend(cust: DataFrame, txn: DataFrame, reference: Column | None = None) -> DataFrame:
    """Activity counts of the last 30/90 days against the 30/90 days before, in one pass."""
    counts = txn.groupBy(ID).agg(*[c.alias(n) for n, c in _window_counts(_reference(txn, reference)).items()])
    return _customers(cust).join(counts, ID, "left").select(ID, *_trend_columns())


def complaint_counts(cust: DataFrame, complaints: DataFrame) -> DataFrame:
    counts = _complaint_totals(complaints)
    names = ("nb_reclamations_total", "nb_reclamations_ouvertes", "nb_reclamations_severite_haute")
    return (
        _customers(cust)
        .join(counts, ID, "left")
        .select(ID, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])
    )


def _complaint_totals(complaints: DataFrame) -> DataFrame:
    return complaints.groupBy(ID).agg(
        count_rows().alias("nb_reclamations_total"),
        F.count_if(F.col("status") == "Open").alias("nb_reclamations_ouvertes"),
        F.count_if(F.col("severity") == "High").alias("nb_reclamations_severite_haute"),
    )


def digital_score_column() -> Column:
    """0 to 3: number of active digital channels; an unknown flag counts as inactive."""
    flags = ("mobile_app_active", "internet_banking_active", "mobile_money_linked")
    return sum((F.when(F.col(f), 1).otherwise(0) for f in flags), F.lit(0)).cast("bigint")


def digital_score(cust: DataFrame) -> DataFrame:
    return cust.select(ID, digital_score_column().alias("score_digital"))


def _per_customer_count(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(ID).agg(count_rows().alias(name))


def product_counts(cust: DataFrame, accounts: DataFrame, cards: DataFrame) -> DataFrame:
    n_accounts, n_cards = (F.coalesce(F.col(c), F.lit(0)) for c in ("nb_comptes", "nb_cartes"))
    return (
        _customers(cust)
        .join(_per_customer_count(accounts, "nb_comptes"), ID, "left")
        .join(_per_customer_count(cards, "nb_cartes"), ID, "left")
        .select(
            ID, n_accounts.alias("nb_comptes"), n_cards.alias("nb_cartes"),
            (n_accounts + n_cards).alias("nb_produits_total"),
        )
    )


def _money_or_zero(name: str) -> Column:
    return F.coalesce(F.col(name).cast(MONEY_SUM), F.lit(0).cast(MONEY_SUM))


def balances(cust: DataFrame, accounts: DataFrame) -> DataFrame:
    sums = accounts.groupBy(ID).agg(
        F.sum("current_balance_xof").alias("solde_total_xof"),
        F.sum("avg_balance_90d_xof").alias("avg_balance_90d_total_xof"),
    )
    return (
        _customers(cust)
        .join(sums, ID, "left")
        .select(ID, *[_money_or_zero(n).alias(n) for n in ("solde_total_xof", "avg_balance_90d_total_xof")])
    )


def nbi_column(balance: Column, n_txn: Column, n_accounts: Column, rules: BusinessRules = RULES) -> Column:
    """Estimated net banking income, rounded to the unit in exact decimal arithmetic."""
    rate = F.lit(rules.nbi_balance_rate).cast("decimal(4,3)")
    fees = (n_txn * rules.nbi_per_transaction + n_accounts * rules.nbi_per_account).cast("decimal(20,0)")
    return F.round(balance * rate + fees, 0).cast(MONEY_SUM)


def nbi(cust: DataFrame, accounts: DataFrame, txn: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    """INT7: the balance base, the transaction count and the number of accounts (cards do not count)."""
    per_account = accounts.groupBy(ID).agg(
        F.sum("avg_balance_90d_xof").alias("_balance"), count_rows().alias("_accounts")
    )
    value = nbi_column(
        _money_or_zero("_balance"), F.coalesce(F.col("_txn"), F.lit(0)), F.coalesce(F.col("_accounts"), F.lit(0)), rules
    )
    return (
        _customers(cust)
        .join(per_account, ID, "left")
        .join(_per_customer_count(txn, "_txn"), ID, "left")
        .select(ID, value.alias("nbi_estime_xof"))
    )


def _top_channel(count_col: str) -> Column:
    """Most used channel: highest count, then name, a missing name last."""
    order = F.struct(-F.col(count_col), F.col("channel_name").isNull(), F.col("channel_name"))
    return F.min_by("channel_name", order)


def with_channel_name(per_channel: DataFrame, channels: DataFrame, how: str = "left") -> DataFrame:
    """Name the channels of (customer, channel) rows.

    The reduced rows are moved to their customer first: every later grouping by customer, or by customer and
    name, and the join with customers then run where the rows are.
    """
    names = channels.select("channel_id", "channel_name")
    return per_channel.repartition(F.col(ID)).join(names, "channel_id", how)


def majority_channel(cust: DataFrame, txn: DataFrame, channels: DataFrame) -> DataFrame:
    """Counts shrink to (customer, channel) before they meet the channel list."""
    by_id = txn.groupBy(ID, "channel_id").agg(count_rows().alias("n"))
    by_name = (
        with_channel_name(by_id, channels)
        .groupBy(ID, "channel_name")
        .agg(F.sum("n").alias("n"))
    )
    top = by_name.groupBy(ID).agg(_top_channel("n").alias("canal_majoritaire"))
    return _customers(cust).join(top, ID, "left").select(ID, "canal_majoritaire")


def max_dpd(cust: DataFrame, loans: DataFrame) -> DataFrame:
    worst = loans.groupBy(ID).agg(F.max("days_past_due").alias("dpd_max"))
    return _customers(cust).join(worst, ID, "left").select(ID, F.coalesce(F.col("dpd_max"), F.lit(0)).alias("dpd_max"))


def transaction_profile(txn: DataFrame, channels: DataFrame, reference: Column | None = None) -> DataFrame:
    """Everything the mart needs from transactions in one scan, which is reduced before it is shuffled.

    The scan is reduced to (customer, channel) counters; the second level works on a handful of rows per
    customer.
    """
    reference = _reference(txn, reference)
    counters = {"_n": count_rows(), **_window_counts(reference)}
    by_id = txn.groupBy(ID, "channel_id").agg(
        F.max("txn_datetime").alias("_last"), *[c.alias(n) for n, c in counters.items()]
    )
    by_name = (
        with_channel_name(by_id, channels)
        .groupBy(ID, "channel_name")
        .agg(F.max("_last").alias("_last"), *[F.sum(n).alias(n) for n in counters])
    )
    return by_name.groupBy(ID).agg(
        F.max("_last").alias("_last"),
        *[F.sum(n).alias(n) for n in counters if n != "_n"],
        F.sum("_n").alias("_n_txn"),
        _top_channel("_n").alias("canal_majoritaire"),
    )


def customer_features(
    silver: dict[str, DataFrame], rules: BusinessRules = RULES, reference: Column | None = None
) -> DataFrame:
    """All features side by side: customers left-joined with five one-row-per-customer aggregates."""
    cust, txn = silver["customers"], silver["transactions"]
    accounts = silver["accounts"].groupBy(ID).agg(
        count_rows().alias("_accounts"),
        F.sum("current_balance_xof").alias("_current"),
        F.sum("avg_balance_90d_xof").alias("_average"),
        F.bool_or("salary_domiciled_corrige").alias("_salary"),
    )
    cards = _per_customer_count(silver["cards"], "_cards")
    loans = silver["loans"].groupBy(ID).agg(F.max("days_past_due").alias("_dpd"))

    joined = cust
    for part in (
        transaction_profile(txn, silver["channels"], reference), _complaint_totals(silver["complaints"]), accounts, cards, loans
    ):
        joined = joined.join(part, ID, "left")

    reference = _reference(txn, reference)
    n_accounts, n_cards = (F.coalesce(F.col(c), F.lit(0)) for c in ("_accounts", "_cards"))
    balance = _money_or_zero("_average")
    recency_days = F.coalesce(F.datediff(reference, F.col("_last")), F.lit(rules.no_activity_recency))
    trend = {"nb_txn_recent_30j": "nb_txn_30j"}
    complaint_names = ("nb_reclamations_ouvertes", "nb_reclamations_total", "nb_reclamations_severite_haute")
    return joined.select(
        ID, "full_name", "segment", "risk_band", "city", "district", "monthly_income_xof", "preferred_channel",
        "mobile_app_active", "internet_banking_active", "mobile_money_linked",
        F.coalesce(F.col("_salary"), F.lit(False)).alias("salaire_domicilie"),
        recency_days.cast("bigint").alias("recency_jours"),
        *_trend_columns(),
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in complaint_names],
        digital_score_column().alias("score_digital"),
        n_accounts.alias("nb_comptes"), n_cards.alias("nb_cartes"), (n_accounts + n_cards).alias("nb_produits_total"),
        _money_or_zero("_current").alias("solde_total_xof"),
        balance.alias("avg_balance_90d_xof"),
        nbi_column(balance, F.coalesce(F.col("_n_txn"), F.lit(0)), n_accounts, rules).alias("nbi_estime_xof"),
        "canal_majoritaire",
        F.coalesce(F.col("_dpd"), F.lit(0)).alias("dpd_max"),
        F.datediff(reference, F.col("onboarding_date")).cast("bigint").alias("anciennete_jours"),
        "is_synthetic",
    ).withColumnsRenamed(trend).drop("nb_txn_precedent_30j")
