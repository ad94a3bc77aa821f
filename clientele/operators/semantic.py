"""Semantic layer: named metrics over the Customer 360 table, and the day spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators.marts import FLAGS

# Dimensions and the spine's span.
DIMENSIONS = ("segment", "risk_band", *FLAGS)
TIME_DIMENSION = "updated_at"
DAY = "_updated_day"
SPINE_START, SPINE_END = "2023-01-01", "2027-12-31"


MEASURES = ("risque_composite_moyen", "engagement_digital_moyen", "nombre_clients")

# Columns of the cube: exact sums and counts that merge across any of its rows.
_SUMS = {"risque_composite_moyen": ("risque_composite", "decimal(5,1)"), "engagement_digital_moyen": ("score_digital", "decimal(5,0)")}


def _measure(name: str) -> Column:
    if name not in MEASURES:
        raise ValueError(f"metric: unknown metric {name}")
    if name in _SUMS:
        return (F.sum(f"sum_{name}").cast("double") / F.nullif(F.sum(f"n_{name}"), F.lit(0))).alias(name)
    return F.coalesce(F.sum(f"n_{name}"), F.lit(0)).cast("bigint").alias(name)


def metric_cube(c360: DataFrame) -> DataFrame:
    """Mergeable sums of all measures per combination of the dimensions (and day of update, where there is one).

    Every metric over any subset of the dimensions is answered from these rows: their number depends on the values
    of the dimensions and the days, not on the customers.
    """
    keys = [F.col(d) for d in DIMENSIONS]
    if TIME_DIMENSION in c360.columns:
        keys.append(F.col(TIME_DIMENSION).cast("date").alias(DAY))
    sums = []
    for name, (column, kind) in _SUMS.items():
        sums += [F.sum(F.col(column).cast(kind)).alias(f"sum_{name}"), F.count(column).alias(f"n_{name}")]
    return c360.groupBy(*keys).agg(*sums, F.count("customer_id").alias("n_nombre_clients"))


def time_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def spine_over(df: DataFrame, stamp: str) -> DataFrame:
    """One row per day from the first to the last stamp of ``df``; none if it has no stamp."""
    day = F.col(stamp).cast("date")
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).filter("first is not null")
    return ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_day"))


def metric(
    cube: DataFrame, names: Sequence[str], by: Sequence[str] = (), grain: str | None = None,
    spine: DataFrame | None = None,
) -> DataFrame:
    """Metrics grouped by dimensions and, with ``grain`` (a day or longer), by the truncated update time.

    ``cube`` comes from ``metric_cube``. ``spine`` keeps days without data as NULL rows.
    """
    unknown = [d for d in by if d not in DIMENSIONS]
    if unknown:
        raise ValueError(f"metric: unknown dimensions {unknown}")
    keys: list[Column] = [F.col(d) for d in by]
    if grain is not None:
        keys.append(F.date_trunc(grain, F.col(DAY)).cast("date").alias("date_day"))
    result = cube.groupBy(*keys).agg(*[_measure(n) for n in names])
    if spine is not None and grain is not None:
        result = spine.join(result, "date_day", "left")
    return result
