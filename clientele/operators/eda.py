"""Exploratory profiles of the source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import MONEY_SUM, count_rows, whole_table_value
from clientele.functions.ordered import counted_values, quantiles_of_counts
from clientele.operators.features import ID, as_of

QUARTILES = {"q1": 0.25, "mediane": 0.5, "q3": 0.75}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, largest first."""
    sizes = [
        df.agg(count_rows().alias("lignes")).select(
            F.lit(name).alias("table_name"), "lignes", F.lit(len(df.columns)).cast("bigint").alias("colonnes")
        )
        for name, df in tables.items()
    ]
    return union_all(sizes).orderBy(F.col("lignes").desc(), "table_name")


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Frequencies of a column's non-missing values, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("n"))
    ordered = counts.orderBy(F.col("n").desc(), column)
    return ordered if k is None else ordered.limit(k)


def boolean_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of true values per flag."""
    rates = {c: F.lit(100.0) * F.count_if(c).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double") for c in columns}
    return df.agg(*[rate.alias(c) for c, rate in rates.items()]).unpivot([], columns, "indicateur", "taux_pct")


def five_numbers(df: DataFrame, by: str, column: str) -> DataFrame:
    """Minimum, quartiles and maximum of the known values per group, from one count of them."""
    counts = counted_values(df.filter(F.col(by).isNotNull()), column, [by])
    ends = counts.groupBy(by).agg(*[f(F.col("_v").cast("double")).alias(n) for n, f in (("minimum", F.min), ("maximum", F.max))])
    return ends.join(quantiles_of_counts(counts, QUARTILES, [by]), by).select(by, "minimum", "q1", "mediane", "q3", "maximum")


def txn_by_channel_group(txn: DataFrame, channels: DataFrame) -> DataFrame:
    """Transactions per channel group; counted per channel before the join."""
    by_channel = txn.filter(F.col("channel_id").isNotNull()).groupBy("channel_id").agg(count_rows().alias("n"))
    return by_channel.join(channels, "channel_id").groupBy("channel_group").agg(F.sum("n").alias("n"))


def observed_recency(txn: DataFrame) -> DataFrame:
    """Elapsed whole days since the last transaction, for customers with transactions."""
    last = txn.groupBy(ID).agg(F.max("txn_datetime").alias("last"))
    return last.select(ID, F.timestamp_diff("DAY", F.col("last"), as_of(txn)).alias("recency_jours"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the known values in one row, from one count of them."""
    counts = counted_values(df, column)
    value, n = F.col("_v").cast("double"), F.col("n")
    spread = whole_table_value(counts, n=F.coalesce(F.sum(n), F.lit(0)), mean=F.sum(value * n) / F.sum(n), low=F.min(value), high=F.max(value))
    squares = whole_table_value(counts, s=F.sum(n * (value - spread["mean"]) * (value - spread["mean"])))
    return quantiles_of_counts(counts, QUARTILES).select(
        spread["n"].alias("n"), spread["mean"].alias("moyenne"),
        F.sqrt(squares["s"] / F.nullif(spread["n"] - 1, F.lit(0))).alias("ecart_type"),
        spread["low"].alias("minimum"), "q1", "mediane", "q3", spread["high"].alias("maximum"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts of the known values in equal bins between the extremes (last edge included); empty bins are left out."""
    counts = counted_values(df, column)
    value = F.col("_v").cast("double")
    ends = whole_table_value(counts, lo=F.min(value), hi=F.max(value))
    width = (ends["hi"] - ends["lo"]) / bins
    number = F.when(width > 0, F.least(F.floor((value - ends["lo"]) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return counts.groupBy(number.cast("bigint").alias("classe")).agg(F.sum("n").alias("n"))


def negative_trend_count(trend: DataFrame) -> DataFrame:
    return trend.agg(F.count_if(F.col("tendance_transactions") < 0).alias("clients_en_baisse"))


def loan_status_crosstab(loans: DataFrame) -> DataFrame:
    """Declared status against corrected status."""
    statuses = ["Current", "Delinquent", "Watchlist"]
    return loans.groupBy("status").pivot("status_corrige", statuses).agg(count_rows()).na.fill(0)


def card_holding(cust: DataFrame, cards: DataFrame) -> DataFrame:
    """Customers with and without a card."""
    holders = cards.select(ID).distinct().withColumn("_card", F.lit(True))
    marked = cust.select(ID).join(holders, ID, "left")
    return marked.agg(
        F.count_if(F.col("_card").isNotNull()).alias("avec_carte"), F.count_if(F.col("_card").isNull()).alias("sans_carte")
    )


def offer_conversion(offers: DataFrame) -> DataFrame:
    rate = F.count_if("accepted_flag").cast("double") / F.count("accepted_flag").cast("double")
    return (
        offers.groupBy("offer_type")
        .agg(rate.alias("taux_conversion"), F.count("accepted_flag").alias("nb_offres"))
        .orderBy(F.col("taux_conversion").desc(), "offer_type")
    )


CORRELATED = (
    "monthly_income_xof", "nb_transactions", "volume_total_xof", "nb_comptes", "solde_moyen_total", "nb_reclamations"
)


def customer_numbers(cust: DataFrame, txn: DataFrame, accounts: DataFrame, complaints: DataFrame) -> DataFrame:
    """Six numbers per customer, missing ones as 0."""
    parts = [
        txn.groupBy(ID).agg(F.count("txn_id").alias("nb_transactions"), F.sum("amount_xof").alias("volume_total_xof")),
        accounts.groupBy(ID).agg(
            F.count("account_id").alias("nb_comptes"), F.sum("avg_balance_90d_xof").alias("solde_moyen_total")
        ),
        complaints.groupBy(ID).agg(count_rows().alias("nb_reclamations")),
    ]
    joined = cust.select(ID, "monthly_income_xof")
    for part in parts:
        joined = joined.join(part, ID, "left")

    def filled(name: str) -> Column:
        kind = MONEY_SUM if name in ("monthly_income_xof", "volume_total_xof", "solde_moyen_total") else "bigint"
        return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind)).alias(name)

    return joined.select(ID, *[filled(n) for n in CORRELATED])


def correlations(numbers: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of the six numbers, from one aggregate."""
    pairs = {
        f"{a}|{b}": F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
        for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]
    }
    wide = numbers.agg(*[c.alias(n) for n, c in pairs.items()])
    long = wide.unpivot([], [f"`{n}`" for n in pairs], "paire", "correlation")
    names = F.split("paire", r"\|")
    return long.select(names[0].alias("colonne_a"), names[1].alias("colonne_b"), "correlation")
