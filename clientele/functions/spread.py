"""Joins of raw rows by a key that may hold a large share of them.

The rows of each key are counted first. A key with more than an average task's share is heavy: its rows are dealt to
parts, and what they are joined with is repeated once per part. All other keys have one part. There are fewer heavy
keys than shuffle partitions, whatever the input, so the table of their parts may always be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows
from clientele.sources.storage import store

FINENESS = 8  # parts of an average task's share: the more, the more evenly a heavy key is spread


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """(``key``, ``_parts``) of the keys that hold more rows than an average task; written, because both sides read it.

    NULL joins with nothing and is never heavy.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = store(rows.groupBy(F.col(key).alias(key)).agg(count_rows().alias("_n")), "rows_by_key")
    share = F.col("_n") * F.lit(tasks) / counts.agg(F.sum("_n")).scalar()
    parts = F.ceil(share * F.lit(FINENESS)).cast("int").alias("_parts")
    return store(counts.filter(F.col(key).isNotNull() & (share > 1)).select(key, parts), "heavy_keys")


def spread_join(rows: DataFrame, other: DataFrame, key: str, other_key: str, deal_by: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``other`` where ``key`` equals ``other_key``: the same rows as a plain inner or left join.

    ``deal_by`` (best the row's own key) decides the part of a row of a heavy key, so that a lost task is redone alike.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join: how must be inner or left")
    heavy = heavy_keys(rows, key)
    known = F.broadcast(heavy.select(F.col(key).alias("_heavy"), "_parts"))
    dealt = rows.join(known, F.col(key) == F.col("_heavy"), "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64(deal_by), F.col("_parts")).cast("int"), F.lit(0))
    )
    repeated = other.join(known, F.col(other_key) == F.col("_heavy"), "left").withColumn(
        "_other_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    )
    same = (F.col(key) == F.col("_other_key")) & (F.col("_part") == F.col("_other_part"))
    repeated = repeated.withColumnRenamed(other_key, "_other_key").drop("_heavy", "_parts")
    joined = dealt.drop("_heavy", "_parts").join(repeated, same, how)
    if other_key != key:
        joined = joined.withColumnRenamed("_other_key", other_key)
    return joined.drop("_part", "_other_part", "_other_key")
