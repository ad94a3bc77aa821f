"""Running totals, ranks and exact quantiles over a whole table without a one-task global window.

All of them work in two levels: rows fall into ordered ranges, the ranges' totals (a few rows) give each
range its starting offset, and a window runs inside each range only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.sources.storage import store

GROUP = "_group"
HASH_RANGE_SHIFT = 48  # a 60-bit hash keeps its top 12 bits: 4096 ordered, evenly filled ranges


def _range_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _range_edges(df: DataFrame, value: str, ranges: int) -> list[float]:
    """Ascending edges that spread the rows of ``df``; at most ``ranges - 1`` numbers reach the driver."""
    probabilities = [i / ranges for i in range(1, ranges)]
    edges = df.stat.approxQuantile(value, probabilities, 1.0 / (4 * ranges)) if probabilities else []
    return sorted(set(edges))


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its group as one struct, which is never NULL, and the key to use for it.

    Inside a struct NULL equals NULL, so windows, groupings and joins can share the same plain keys and one exchange.
    """
    return (df.withColumn(GROUP, F.struct(*by)), [GROUP]) if by else (df, [])


def _ranged(counts: DataFrame, value: str, ranges: int | None) -> DataFrame:
    """Add ``_range``, the number of the ordered range each value falls into; ``counts`` are read several times."""
    numeric = counts.withColumn("_position", F.col(value).cast("double"))
    edges = _range_edges(numeric, "_position", ranges or _range_count(counts))
    if not edges:
        return numeric.withColumn("_range", F.lit(0)).drop("_position")
    splits = [float("-inf"), *edges, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_position", outputCol="_bucket").transform(numeric)
    return ranged.withColumn("_range", F.col("_bucket").cast("int")).drop("_position", "_bucket")


def _range_offsets(ranged: DataFrame, totals: Sequence[str], by: Sequence[str], descending: bool = False) -> DataFrame:
    """Per range: its own totals ``_sum_<t>`` and those of all ranges before it, ``_off_<t>``.

    One row per range and group reaches the window, whatever the size of the data.
    """
    range_order = F.col("_range").desc() if descending else F.col("_range")
    before = Window.partitionBy(*by).orderBy(range_order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.groupBy(*by, "_range")
        .agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
        .withColumns({f"_off_{t}": F.coalesce(F.sum(f"_sum_{t}").over(before), F.lit(0)) for t in totals})
    )


def known_value(df: DataFrame, value: str) -> Column:
    """Not missing: neither NULL nor NaN."""
    present = F.col(value).isNotNull()
    return present & ~F.isnan(value) if df.schema[value].dataType.typeName() in ("double", "float") else present


def prefix_sums(
    counts: DataFrame,
    value: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add ``cum_<t>`` (inclusive running total in ``value`` order) for each column of ``totals``.

    ``counts`` holds one row per (``by``, ``value``); ``value`` must be numeric and not NULL. Aggregating to
    distinct values first is what makes a value shared by a third of all rows harmless. The counts are written once,
    because edges, offsets and running totals all read them, unless the caller says that they are ``stored``.
    """
    counts, by = _grouped(counts if stored else store(counts, "value_counts"), by)
    ranged = _ranged(counts, value, ranges)
    offsets = _range_offsets(ranged, totals, by, descending).drop(*[f"_sum_{t}" for t in totals])
    value_order = F.col(value).desc() if descending else F.col(value)
    inside = (
        Window.partitionBy(*by, "_range").orderBy(value_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = ranged.withColumns({f"_run_{t}": F.sum(t).over(inside) for t in totals})
    joined = running.join(offsets, [*by, "_range"])
    return joined.withColumns({f"cum_{t}": F.col(f"_run_{t}") + F.col(f"_off_{t}") for t in totals}).drop(
        "_range", GROUP, *[f"_run_{t}" for t in totals], *[f"_off_{t}" for t in totals]
    )


def hash_rank(df: DataFrame, hash_col: str, tie: str, by: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Add the 1-based rank of each row by (``hash_col``, ``tie``) inside each ``by`` group.

    The top bits of the hash split even a single group into 4096 ordered windows.
    """
    grouped, by = _grouped(df, by)
    ranged = grouped.withColumn("_range", F.shiftright(F.col(hash_col), HASH_RANGE_SHIFT).cast("int"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    inside = Window.partitionBy(*by, "_range").orderBy(hash_col, tie)
    return (
        ranged.withColumn("_row", F.row_number().over(inside))
        .join(offsets, [*by, "_range"])
        .withColumn(rank_col, F.col("_row").cast("bigint") + F.col("_off"))
        .drop("_range", "_row", "_off", GROUP)
    )


def counted_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, ``_v``, ``n``): how often each known value of ``value`` occurs in each group, written once.

    NULL and NaN are left out. All profiles of a column can be taken from its counts.
    """
    counts = df.filter(known_value(df, value)).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    return store(counts, "value_counts")


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles per group (one row per ``by``; one row in all without ``by``).

    Column names are the keys of ``probabilities``. NULL and NaN are ignored.
    """
    return quantiles_of_counts(counted_values(df, value, by), probabilities, by)


def quantiles_of_counts(counts: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles from ``counted_values``.

    Values are counted and ordered in their own type; decimals beyond 2**53 stay apart, and only interpolation goes
    through doubles. The totals of the ordered ranges tell which ranges hold the wanted ranks; only their values are
    ordered. Unlike ``percentile`` no task holds all distinct values of a group.
    """
    names = list(by)
    counts, by = _grouped(counts, names)
    ranged = _ranged(counts, "_v", None)

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_size") - 1)

    ranks = [rank(position(p)) for p in probabilities.values() for rank in (F.floor, F.ceil)]
    holds: Column = F.lit(False)
    for rank in ranks:
        holds = holds | ((F.col("_off_n") <= rank) & (rank < F.col("_off_n") + F.col("_sum_n")))
    wanted = (
        _range_offsets(ranged, ["n"], by)
        .withColumn("_size", F.sum("_sum_n").over(Window.partitionBy(*by)))
        .filter(holds)
        .select(*by, "_range", "_off_n", "_size")
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cumulative = ranged.join(wanted, [*by, "_range"]).withColumn("_cum", F.sum("n").over(inside) + F.col("_off_n"))

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("_cum") > rank, F.col("_v")))

    bounds = [F.max("_size").alias("_size")]
    for name, p in probabilities.items():
        bounds.append(value_at(F.floor(position(p))).alias(f"_lo_{name}"))
        bounds.append(value_at(F.ceil(position(p))).alias(f"_hi_{name}"))
    found = cumulative.groupBy(*by).agg(*bounds)

    def interpolated(name: str, p: float) -> Column:
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        return (low + (high - low) * (position(p) - F.floor(position(p)))).alias(name)

    return found.select(*[F.col(f"{GROUP}.{c}") for c in names], *[interpolated(name, p) for name, p in probabilities.items()])
