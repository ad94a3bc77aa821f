"""Pieces several report pages share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import MONEY_SUM, count_rows, share_pct

ACTIVE = "recency_jours"
ACTIVE_DAYS = 30


def rag(value: Column, *steps: tuple[Column, str], default: str) -> Column:
    """Traffic-light status: first step that holds; NULL for an unknown value."""
    status = F.when(value.isNull(), F.lit(None).cast("string"))
    for condition, colour in steps:
        status = status.when(condition, F.lit(colour))
    return status.otherwise(F.lit(default))


def money(name: str) -> Column:
    """Sum of a money column, 0 on empty input."""
    return F.coalesce(F.sum(name).cast(MONEY_SUM), F.lit(0).cast(MONEY_SUM))


def money_if(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(name))).cast(MONEY_SUM), F.lit(0).cast(MONEY_SUM))


def mean_money(name: str) -> Column:
    return F.sum(name).cast("double") / F.count(name)


def active_rate() -> Column:
    return share_pct(F.col(ACTIVE) <= ACTIVE_DAYS)


def active_status(rate: Column) -> Column:
    return rag(rate, (rate > 80, "success"), (rate >= 60, "warning"), default="danger")


def composition(df: DataFrame, column: str) -> DataFrame:
    """Value counts with a display label."""
    label = F.concat(F.col(column), F.lit(" ("), F.col("nb_clients").cast("string"), F.lit(")"))
    return df.groupBy(column).agg(count_rows().alias("nb_clients")).withColumn("libelle", label)
