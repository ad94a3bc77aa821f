"""Staging: union of observed and generated rows, explicit types, business corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.config import RULES
from clientele.sources.schemas import COLUMNS


def tag_real(df: DataFrame) -> DataFrame:
    """Mark rows as observed where the source does not say: no such column, or NULL in it."""
    said = F.col("is_synthetic").cast("boolean") if "is_synthetic" in df.columns else F.lit(None).cast("boolean")
    return df.withColumn("is_synthetic", F.coalesce(said, F.lit(False)))


def _typed(df: DataFrame, table: str) -> DataFrame:
    casts = [F.col(name).cast(kind).alias(name) for name, kind in COLUMNS[table].items()]
    return df.select(*casts, F.col("is_synthetic").cast("boolean").alias("is_synthetic"))


def _union(real: DataFrame, synth: DataFrame | None, table: str) -> DataFrame:
    columns = [*COLUMNS[table], "is_synthetic"]
    rows = tag_real(real).select(*columns)
    if synth is not None:
        rows = rows.unionByName(synth.select(*columns))
    return _typed(rows, table)


def stg_customers(real: DataFrame, synth: DataFrame | None = None) -> DataFrame:
    return _union(real, synth, "customers")


def stg_transactions(real: DataFrame, synth: DataFrame | None = None) -> DataFrame:
    return _union(real, synth, "transactions")


def salary_accounts(stg_txn: DataFrame) -> DataFrame:
    """Accounts that received a salary at least once; duplicates go before the shuffle."""
    return stg_txn.filter(F.col("txn_type") == "salary_credit").select("account_id").distinct()


def stg_accounts(real: DataFrame, synth: DataFrame | None, stg_txn: DataFrame) -> DataFrame:
    """Accounts with ``salary_domiciled_corrige``: declared flag, or a salary credit seen."""
    paid = salary_accounts(stg_txn).withColumn("_paid", F.lit(True))
    flag = F.col("salary_domiciled_flag") | F.col("_paid").isNotNull()
    columns = list(COLUMNS["accounts"])
    at = columns.index("salary_domiciled_flag") + 1
    return (
        _union(real, synth, "accounts")
        .join(paid, "account_id", "left")
        .withColumn("salary_domiciled_corrige", flag)
        .select(*columns[:at], "salary_domiciled_corrige", *columns[at:], "is_synthetic")
    )


def stg_loans(
    real: DataFrame, synth: DataFrame | None = None, dpd_threshold: int = RULES.dpd_threshold_days
) -> DataFrame:
    """Loans with ``status_corrige``: delinquent beyond the threshold whatever the declared status."""
    corrected = F.when(F.col("days_past_due") > dpd_threshold, F.lit("Delinquent")).otherwise(F.col("status"))
    columns = list(COLUMNS["loans"])
    at = columns.index("status") + 1
    return (
        _union(real, synth, "loans")
        .withColumn("status_corrige", corrected)
        .select(*columns[:at], "status_corrige", *columns[at:], "is_synthetic")
    )


def stg_cards(real: DataFrame, synth: DataFrame | None = None) -> DataFrame:
    return _union(real, synth, "cards")


def stg_branches(real: DataFrame) -> DataFrame:
    return _union(real.drop("is_synthetic"), None, "branches")


def stg_channels(real: DataFrame) -> DataFrame:
    return _union(real.drop("is_synthetic"), None, "channels")


def stg_interactions(real: DataFrame, synth: DataFrame | None = None) -> DataFrame:
    return _union(real, synth, "interactions")


def stg_complaints(real: DataFrame, synth: DataFrame | None = None) -> DataFrame:
    return _union(real, synth, "complaints")


def stg_offers(real: DataFrame, synth: DataFrame | None = None) -> DataFrame:
    return _union(real, synth, "offers")
