"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_SUM = "decimal(25,2)"


def round_half_up(value: Column, digits: int = 0) -> Column:
    """Round a double half away from zero on its binary value (``F.round`` goes through its decimal text)."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / F.lit(scale) + F.lit(0.0)


def portable_hash(seed: int, key: Column) -> Column:
    """60-bit number taken from md5 of ``seed-key``: uniform, seeded, and the same on any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def count_rows() -> Column:
    return F.count(F.lit(1))


def flag_count(condition: Column) -> Column:
    """Number of rows where the condition is true; 0, not NULL, on empty input."""
    return F.count_if(condition)


def exact_mean(value: Column, decimal_type: str) -> Column:
    """Mean as an exact decimal sum over a count, so the result does not depend on row order."""
    return F.sum(value.cast(decimal_type)).cast("double") / F.count(value)


def share_pct(condition: Column) -> Column:
    """100 x rows meeting the condition / all rows, as a double; NULL on empty input."""
    return (F.lit(100.0) * F.count_if(condition).cast("double")) / F.nullif(count_rows(), F.lit(0)).cast("double")


def whole_table_value(df: DataFrame, **aggregates: Column) -> Column:
    """One-row aggregate of ``df`` as a struct-valued scalar subquery.

    The aggregate runs once and its single row becomes a constant of the outer query: no join, and no
    ``over ()`` window, which would move every row to one task.
    """
    return df.agg(F.struct(*[agg.alias(name) for name, agg in aggregates.items()]).alias("v")).scalar()


def least_squares(x: Column, y: Column) -> dict[str, Column]:
    """Slope and intercept aggregates; NULL when x has fewer than two distinct values."""
    return {"slope": F.regr_slope(y, x), "intercept": F.regr_intercept(y, x)}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, to compare results across engines and partition orders."""
    return df.select(
        *[round_half_up(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )
