"""Synthetic cohort: bootstrap of customers with every linked row, set-based and reproducible by seed.

Draw number and source customer together identify a copy, so a customer drawn twice gets two independent
copies of all rows. New ids derive from the new customer and the old id and are unique by construction. Joins on raw
rows split heavy customers and accounts (``spread_join``); the churned customers of a cohort are marked in the account
map, so that its transactions are joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import RULES
from clientele.functions.columns import count_rows, portable_hash, whole_table_value
from clientele.functions.ordered import hash_rank, known_value, prefix_sums
from clientele.functions.spread import spread_join
from clientele.operators.features import ID
from clientele.operators.staging import tag_real
from clientele.sources.schemas import COLUMNS, KEYS, REFERENCE_TABLES
from clientele.sources.storage import store

BY_ACCOUNT = ("transactions", "cards")
BY_CUSTOMER = ("loans", "interactions", "complaints", "offers")
INDEX_SEED = 0


def draw_customers(cust: DataFrame, n: int = RULES.synthetic_customers, seed: int = RULES.seed) -> DataFrame:
    """n draws with replacement: ``new_customer_id`` and the customer it copies.

    Customers get a dense index in hash order; draw k picks index hash(seed, k) mod number of customers.
    """
    indexed = hash_rank(cust.select(ID).withColumn("_h", portable_hash(INDEX_SEED, F.col(ID))), "_h", ID).select(
        F.col(ID).alias("source_customer_id"), (F.col("rank") - 1).alias("_index")
    )
    size = whole_table_value(cust, n=count_rows())["n"]
    draw = F.col("id")
    digits = draw.cast("string")
    new_id = F.concat(F.lit("SYN-"), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))
    draws = cust.sparkSession.range(1, n + 1).select(
        new_id.alias("new_customer_id"), F.pmod(portable_hash(seed, draw), F.nullif(size, F.lit(0))).alias("_index")
    )
    return draws.join(indexed, "_index").select("new_customer_id", "source_customer_id")


def _copied(joined: DataFrame, table: str, replaced: dict[str, Column]) -> DataFrame:
    columns = [replaced[c].alias(c) if c in replaced else F.col(c) for c in COLUMNS[table]]
    return joined.select(*columns, F.lit(True).alias("is_synthetic"))


def _derived(key: str) -> Column:
    return F.concat_ws("-", F.col("new_customer_id"), F.col(key))


def copy_customers(cust: DataFrame, draws: DataFrame) -> DataFrame:
    joined = cust.join(draws, F.col(ID) == F.col("source_customer_id"))
    return _copied(joined, "customers", {ID: F.col("new_customer_id")})


def account_map(draws: DataFrame, accounts: DataFrame) -> DataFrame:
    """Old account, new account and new customer of every copied account."""
    owned = accounts.select(F.col("account_id").alias("source_account_id"), F.col(ID).alias("source_customer_id"))
    return draws.join(owned, "source_customer_id").select(
        "source_account_id", _derived("source_account_id").alias("new_account_id"), "new_customer_id"
    )


def remap_accounts(draws: DataFrame, accounts: DataFrame) -> DataFrame:
    joined = accounts.join(draws, F.col(ID) == F.col("source_customer_id"))
    return _copied(joined, "accounts", {"account_id": _derived("account_id"), ID: F.col("new_customer_id")})


def remap_by_account(
    df: DataFrame, mapping: DataFrame, table: str, days: int = RULES.synthetic_shift_days
) -> DataFrame:
    """Rows hanging on an account follow their account; rows of accounts that were not copied stay out.

    Where the mapping has a column ``churned``, transactions of accounts with it are moved into the past.
    """
    key = KEYS[table]
    joined = spread_join(df, mapping, "account_id", "source_account_id", F.col(key))
    replaced = {key: _derived(key), "account_id": F.col("new_account_id"), ID: F.col("new_customer_id")}
    if table == "transactions" and "churned" in mapping.columns:
        replaced["txn_datetime"] = _moved(F.col("churned"), days)
    return _copied(joined, table, replaced)


def remap_by_customer(df: DataFrame, draws: DataFrame, table: str) -> DataFrame:
    key = KEYS[table]
    joined = spread_join(df, draws, ID, "source_customer_id", F.col(key))
    return _copied(joined, table, {key: _derived(key), ID: F.col("new_customer_id")})


def _moved(churned: Column, days: int) -> Column:
    return F.when(churned, F.col("txn_datetime") - F.expr(f"interval {days} days")).otherwise(F.col("txn_datetime"))


def churned_customers(cust: DataFrame, rate: float, seed: int) -> DataFrame:
    """max(1, floor(n x rate)) customers without replacement: the lowest seeded hashes."""
    wanted = whole_table_value(cust, k=F.greatest(F.lit(1), F.floor(count_rows() * F.lit(float(rate)))))["k"]
    hashed = cust.select(ID).withColumn("_h", portable_hash(seed, F.col(ID)))
    return hash_rank(hashed, "_h", ID).filter(F.col("rank") <= wanted).select(ID)


def inject_churn(
    txn: DataFrame, cust: DataFrame, rate: float = RULES.synthetic_churn_rate, seed: int = RULES.seed,
    days: int = RULES.synthetic_shift_days,
) -> DataFrame:
    """Move all transactions of the chosen customers into the past."""
    chosen = churned_customers(cust, rate, seed).select(F.col(ID).alias("_churned"), F.lit(True).alias("_shift"))
    joined = spread_join(txn, chosen, ID, "_churned", F.col("txn_id"), "left")
    columns = txn.columns
    return joined.withColumn("txn_datetime", _moved(F.col("_shift"), days)).select(*columns)


def ks_2samp(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov: sizes, largest distance of the distribution functions, asymptotic p."""
    sample = a.select(F.col(column).alias("_x"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        b.select(F.col(column).alias("_x"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = (
        sample.filter(known_value(sample, "_x")).groupBy(F.col("_x").cast("double").alias("_x"))
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    counts = store(counts, "ks_counts")
    running = prefix_sums(counts, "_x", ["a", "b"], stored=True)
    size = whole_table_value(counts, a=F.sum("a"), b=F.sum("b"))
    distance = F.abs(F.col("cum_a") / F.nullif(size["a"], F.lit(0)) - F.col("cum_b") / F.nullif(size["b"], F.lit(0)))
    found = running.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.max(distance).alias("statistique"))
    root = F.sqrt(F.col("n_a") * F.col("n_b") / (F.col("n_a") + F.col("n_b"))) * F.col("statistique")
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(k * k * root * root * -2.0),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    p_value = F.when(root < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    return found.withColumn("p_value", F.when(F.col("statistique").isNotNull(), p_value))


def synthesize(
    tables: dict[str, DataFrame], n: int = RULES.synthetic_customers, churn_rate: float = RULES.synthetic_churn_rate,
    seed: int = RULES.seed,
) -> dict[str, DataFrame]:
    """The whole cohort: eight re-keyed tables, the two reference lists as they are.

    The draws and the account map are written first: every table joins one of them.
    """
    draws = store(draw_customers(tables["customers"], n, seed), "draws")
    copied = copy_customers(tables["customers"], draws)
    churned = churned_customers(copied, churn_rate, seed).select(F.col(ID).alias("new_customer_id"), F.lit(True).alias("churned"))
    mapping = store(account_map(draws, tables["accounts"]).join(churned, "new_customer_id", "left"), "account_map")
    result = {"customers": copied, "accounts": remap_accounts(draws, tables["accounts"])}
    for table in BY_ACCOUNT:
        result[table] = remap_by_account(tables[table], mapping, table)
    for table in BY_CUSTOMER:
        result[table] = remap_by_customer(tables[table], draws, table)
    for table in REFERENCE_TABLES:
        result[table] = tag_real(tables[table])
    return result
