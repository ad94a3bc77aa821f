"""Data quality: table validation, declarative rules, orphan keys, profiles, outliers, lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.config import RULES
from clientele.functions.columns import count_rows, round_half_up, whole_table_value
from clientele.functions.ordered import counted_values, quantiles_of_counts
from clientele.operators.eda import union_all
from clientele.sources.concurrent import run_all
from clientele.sources.schemas import COLUMNS, FOREIGN_KEYS, KEYS

SUITE_QUERIES = 8  # of the rule suite at once


# Validation of one table -------------------------------------------------------------------------
@dataclass(frozen=True)
class Report:
    table: str
    rows: int
    null_pct: float
    errors: tuple[str, ...]


def validation(df: DataFrame, name: str, required: Sequence[str] = ()) -> DataFrame:
    """One row: number of rows, NULL percentage over all cells, list of errors. One pass, never raises."""
    missing = [c for c in required if c not in df.columns]
    nulls: Column = F.lit(0).cast("bigint")
    for c in df.columns:
        nulls = nulls + F.count_if(F.col(f"`{c}`").isNull())
    totals = df.agg(count_rows().alias("lignes"), nulls.alias("_nulls"))
    cells = F.greatest(F.col("lignes") * len(df.columns), F.lit(1))
    errors = F.concat_ws(
        ", ",
        F.when(F.col("lignes") == 0, F.lit("table vide")),
        F.lit(f"colonnes manquantes: {', '.join(missing)}" if missing else None).cast("string"),
    )
    pct = round_half_up(F.lit(100.0) * F.col("_nulls").cast("double") / cells.cast("double"), 2)
    return totals.select(F.lit(name).alias("table_name"), "lignes", pct.alias("taux_nuls_pct"), errors.alias("erreurs"))


def validate(df: DataFrame, name: str, required: Sequence[str] = ()) -> Report:
    """Validate one table; an empty table or a missing required column raises."""
    row = validation(df, name, required).first()
    report = Report(name, row["lignes"], row["taux_nuls_pct"], tuple(e for e in [row["erreurs"]] if e))
    if report.errors:
        raise ValueError(f"validation failed for {name}: {report.errors[0]}")
    return report


def check_schema(tables: dict[str, DataFrame]) -> DataFrame:
    """Full report over the ten tables: contract columns, emptiness, NULL share. A missing table is an error row."""
    reports = []
    for name, columns in COLUMNS.items():
        if name in tables:
            reports.append(validation(tables[name], name, list(columns)))
    absent = [name for name in COLUMNS if name not in tables]
    if absent:
        spark = next(iter(tables.values())).sparkSession
        rows = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in absent])).alias("table_name"))
        reports.append(
            rows.select(
                "table_name", F.lit(0).cast("bigint").alias("lignes"), F.lit(None).cast("double").alias("taux_nuls_pct"),
                F.lit("table absente").alias("erreurs"),
            )
        )
    return union_all(reports)


# Single rules ------------------------------------------------------------------------------------
def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-missing values that occur more than once."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-missing values outside the list, with their frequency."""
    outside = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return outside.groupBy(column).agg(count_rows().alias("n"))


def relationships(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-missing child keys without a parent and how many rows carry each.

    Keys are counted before the anti-join: a key on a third of the rows travels as one row.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("cle")).agg(count_rows().alias("n"))
    return keys.join(parent.select(F.col(parent_key).alias("cle")), "cle", "left_anti")


def expect(df: DataFrame, violated: Column) -> DataFrame:
    """Rows for which a condition of violation holds."""
    return df.filter(violated)


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


def outside_bounds(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


# Rule suite --------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    kind: str  # not_null, unique, accepted_values, relationships, expect
    table: str
    column: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        target = f"->{self.parent[0]}.{self.parent[1]}" if self.parent else ""
        return f"{self.kind}:{self.table}.{self.column}{target}"


# Accepted values per table and column.
ACCEPTED: dict[str, dict[str, tuple[str, ...]]] = {
    "stg_customers": {
        "segment": ("Mass", "Affluent", "Premier", "Youth"),
        "risk_band": ("Low", "Medium", "High"),
        "kyc_level": ("Enhanced", "Standard"),
        "gender": ("F", "M"),
        "marital_status": ("Married", "Single"),
        "preferred_channel": ("ATM", "Branch", "Internet Banking", "Mobile App"),
    },
    "stg_accounts": {
        "account_type": ("Current", "Premier Current", "Savings", "Student"),
        "status": ("Dormant", "Open"),
        "currency": ("XOF",),
    },
    "stg_transactions": {
        "txn_type": (
            "atm_withdrawal", "bill_payment", "card_purchase", "cash_deposit", "loan_repayment",
            "mobilemoney_cashout", "p2p_transfer", "salary_credit", "transfer_in", "transfer_out",
        ),
        "direction": ("IN", "OUT"),
    },
    "stg_loans": {
        "status": ("Current", "Delinquent", "Watchlist"),
        "status_corrige": ("Current", "Delinquent", "Watchlist"),
        "loan_type": ("Asset Finance", "Personal Loan", "Salary Advance"),
    },
    "stg_cards": {"card_type": ("Credit", "Debit", "Prepaid"), "status": ("Active", "Blocked", "Expired")},
    "stg_branches": {"branch_type": ("Flagship", "Regional", "Urban")},
    "stg_channels": {"channel_group": ("Digital", "Partner", "Payment", "Physical", "Service")},
    "stg_interactions": {"sentiment": ("Negative", "Neutral", "Positive")},
    "stg_complaints": {"severity": ("Low", "Medium", "High"), "status": ("Open", "Closed")},
    "stg_offers": {
        "offer_type": ("Card upgrade", "Digital activation", "Personal loan", "Savings product", "Travel card"),
    },
    "customer_360": {
        "segment": ("Mass", "Affluent", "Premier", "Youth"),
        "risk_band": ("Low", "Medium", "High"),
    },
}

# Columns that must be filled besides the keys.
REQUIRED: dict[str, tuple[str, ...]] = {
    "stg_accounts": ("customer_id",),
    "customer_360": (
        "risque_composite", "is_high_value_at_risk", "is_digitally_dormant_salary", "is_complaints_churn_risk",
        "is_cross_sell_target", "is_salary_upsell_opportunity", "solde_total_xof", "nbi_estime_xof", "nb_txn_30j",
        "nb_txn_90j", "dpd_max", "anciennete_jours",
    ),
}

FEATURE_TABLES = (
    "int_customer_recency", "int_customer_transaction_trend", "int_customer_complaints", "int_customer_digital_score",
    "int_customer_products", "int_customer_balance", "int_customer_nbi", "int_customer_channel", "int_customer_loans",
)
UNIQUE_KEYS: dict[str, str] = {
    **{f"stg_{t}": k for t, k in KEYS.items()},
    **dict.fromkeys(FEATURE_TABLES, "customer_id"),
    "customer_360": "customer_id", "customer_segments": "segment", "nba": "customer_id",
}

# References under test (source lists are checked by the orphan matrix only).
TESTED_REFERENCES = tuple(fk for fk in FOREIGN_KEYS if fk[2] not in ("branches", "channels"))


def _expectation(table: str, column: str) -> Column:
    if (table, column) == ("nba", "next_best_action"):
        return blank(column)
    if (table, column) == ("customer_360", "risque_composite"):
        return outside_bounds(column, 0, 100)
    raise ValueError(f"no expectation on {table}.{column}")


def suite_rules() -> list[Rule]:
    """The 93 rules of the silver and gold tables."""
    rules = []
    for table, key in UNIQUE_KEYS.items():
        rules += [Rule("unique", table, key), Rule("not_null", table, key)]
    rules += [Rule("not_null", t, c) for t, columns in REQUIRED.items() for c in columns]
    rules += [Rule("accepted_values", t, c, v) for t, lists in ACCEPTED.items() for c, v in lists.items()]
    rules += [
        Rule("relationships", f"stg_{child}", ck, parent=(f"stg_{parent}", pk)) for child, ck, parent, pk in TESTED_REFERENCES
    ]
    rules.append(Rule("relationships", "nba", "customer_id", parent=("customer_360", "customer_id")))
    rules += [Rule("expect", "nba", "next_best_action"), Rule("expect", "customer_360", "risque_composite")]
    return rules


def _row_rules(df: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """not_null, accepted_values and expect rules of one table in one scan to one row.

    Only a column that does hold values outside its list is read once more, to count these values.
    """
    outside = {r: F.col(r.column).isNotNull() & ~F.col(r.column).isin(*r.values) for r in rules if r.kind == "accepted_values"}
    checks = outside | {
        r: F.col(r.column).isNull() if r.kind == "not_null" else F.coalesce(_expectation(r.table, r.column), F.lit(False))
        for r in rules if r.kind != "accepted_values"
    }
    row = df.agg(*[F.count_if(check).alias(f"f{i}") for i, check in enumerate(checks.values())]).first()
    failed = {r: row[f"f{i}"] for i, r in enumerate(checks)}
    listed = [r for r in outside if failed[r]]
    return {r.name: failed[r] for r in checks} | {
        r.name: df.filter(outside[r]).agg(F.count_distinct(r.column)).first()[0] for r in listed
    }


def _key_rules(df: DataFrame, key: str, rules: list[Rule]) -> dict[str, int]:
    """unique and not_null of one key from the same per-key counts."""
    per_key = df.groupBy(F.col(key).alias("_key")).agg(count_rows().alias("_n"))
    counts = {
        "unique": F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)),
        "not_null": F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)),
    }
    row = per_key.agg(*[counts[r.kind].alias(r.kind) for r in rules]).first()
    return {r.name: row[r.kind] for r in rules}


def _reference_rule(tables: dict[str, DataFrame], rule: Rule) -> dict[str, int]:
    parent, key = rule.parent
    orphans = relationships(tables[rule.table], rule.column, tables[parent], key)
    return {rule.name: orphans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]}


def run_suite(tables: dict[str, DataFrame], rules: Iterable[Rule] | None = None) -> DataFrame:
    """One row per rule with its number of violations.

    Violations are failing rows for not_null, expect and relationships; failing values for unique and
    accepted_values. Every table is scanned once for its row rules and once per key or reference; these small queries
    run side by side, and each hands one row of counts to the driver.
    """
    rules = list(suite_rules() if rules is None else rules)
    spark = next(iter(tables.values())).sparkSession
    queries: list[Callable[[], dict[str, int]]] = []
    for table in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == table]
        keys = {r.column for r in own if r.kind == "unique"}
        for key in sorted(keys):
            queries.append(partial(_key_rules, tables[table], key, [r for r in own if r.column == key and r.kind in ("unique", "not_null")]))
        row_rules = [
            r for r in own if r.kind in ("accepted_values", "expect") or (r.kind == "not_null" and r.column not in keys)
        ]
        if row_rules:
            queries.append(partial(_row_rules, tables[table], row_rules))
        queries += [partial(_reference_rule, tables, r) for r in own if r.kind == "relationships"]
    violations = {name: n for found in run_all(spark, queries, SUITE_QUERIES) for name, n in found.items()}
    rows = [(r.name, r.kind, r.table, r.column, int(violations[r.name])) for r in rules]
    return spark.createDataFrame(rows, "regle string, type_regle string, table_name string, colonne string, violations bigint")


# Profiles ----------------------------------------------------------------------------------------
def orphan_matrix(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct orphan keys of each of the twelve references."""
    parts = []
    for child, ck, parent, pk in FOREIGN_KEYS:
        orphans = relationships(tables[child], ck, tables[parent], pk)
        parts.append(
            orphans.agg(count_rows().alias("cles_orphelines")).select(
                F.lit(f"{child}.{ck} -> {parent}").alias("relation"), "cles_orphelines"
            )
        )
    return union_all(parts)


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns with missing values, their number and percentage; one wide aggregate per table."""
    parts = []
    for name, df in tables.items():
        wide = df.agg(count_rows().alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        parts.append(
            wide.unpivot(["_rows"], df.columns, "colonne", "nulls")
            .filter("nulls > 0")
            .select(
                F.lit(name).alias("table_name"), "colonne", "nulls",
                round_half_up(F.lit(100.0) * F.col("nulls").cast("double") / F.col("_rows").cast("double"), 1).alias("pct"),
            )
        )
    return union_all(parts).orderBy(F.col("pct").desc(), "table_name", "colonne")


def null_profile_of(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """``null_profile`` from counts taken before: rows and missing values per column."""
    rows = [(t, c, n, 100.0 * n / of["rows"]) for t, of in counts.items() for c, n in of.items() if c != "rows" and n > 0]
    found = spark.createDataFrame(rows, "table_name string, colonne string, nulls bigint, pct double")
    return found.withColumn("pct", round_half_up(F.col("pct"), 1)).orderBy(F.col("pct").desc(), "table_name", "colonne")


def dup_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose key already occurred, for the eight tables with own keys."""
    names = [t for t in tables if t not in ("branches", "channels")]
    parts = []
    for name in names:
        per_key = tables[name].groupBy(KEYS[name]).agg(count_rows().alias("n"))
        parts.append(
            per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("doublons")).select(
                F.lit(name).alias("table_name"), F.lit(KEYS[name]).alias("cle"), "doublons"
            )
        )
    return union_all(parts)


def outliers_of(columns: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Known values beyond 1.5 interquartile ranges, with exact quartiles, of all named columns at once.

    The columns' values are counted together once; quartiles and outliers both come from these counts.
    """
    values = union_all([df.select(F.lit(name).alias("colonne"), F.col(c).alias("v")) for name, (df, c) in columns.items()])
    counts = counted_values(values, "v", ["colonne"])
    quartiles = quantiles_of_counts(counts, {"q1": 0.25, "q3": 0.75}, ["colonne"])
    value, reach = F.col("_v").cast("double"), (F.col("q3") - F.col("q1")) * 1.5
    outside = (value < F.col("q1") - reach) | (value > F.col("q3") + reach)
    found = counts.join(quartiles, "colonne").groupBy("colonne").agg(F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("found"))
    names = values.sparkSession.createDataFrame([(name,) for name in columns], "colonne string")
    return names.join(found, "colonne", "left").select("colonne", F.coalesce("found", F.lit(0)).alias("nb_aberrants"))


def iqr_outliers(df: DataFrame, column: str, label: str | None = None) -> DataFrame:
    """``outliers_of`` for one column."""
    return outliers_of({label or column: (df, column)})


# Money columns profiled for outliers.
OUTLIER_COLUMNS = (
    ("transactions", "amount_xof"), ("accounts", "avg_balance_90d_xof"), ("loans", "outstanding_balance_xof"),
    ("customers", "monthly_income_xof"),
)


def outlier_profile(tables: dict[str, DataFrame]) -> DataFrame:
    return outliers_of({f"{t}.{c}": (tables[t], c) for t, c in OUTLIER_COLUMNS})


def loan_status_conflicts(loans: DataFrame, threshold: int = RULES.dpd_threshold_days) -> DataFrame:
    """Loans in arrears beyond the threshold still declared current, worst first."""
    late = loans.filter((F.col("days_past_due") > threshold) & (F.col("status") == "Current"))
    return late.select("loan_id", "status", "days_past_due").orderBy(F.col("days_past_due").desc(), "loan_id")


def worst_arrears(loans: DataFrame, k: int = 10) -> DataFrame:
    return loans.select("loan_id", "status", "days_past_due").orderBy(F.col("days_past_due").desc(), "loan_id").limit(k)


def salary_flag_conflicts(accounts: DataFrame, txn: DataFrame) -> DataFrame:
    """Accounts not declared as salary accounts that receive salary transactions."""
    paid = txn.filter(F.contains(F.lower("txn_type"), F.lit("salary"))).select("account_id").distinct()
    undeclared = accounts.filter(~F.col("salary_domiciled_flag"))
    return undeclared.join(paid, "account_id", "left_semi").select("account_id", "customer_id", "salary_domiciled_flag")


# Lineage -----------------------------------------------------------------------------------------
LINEAGE_COLUMNS = "table_name string, source string, row_count bigint, is_synthetic boolean, updated_at timestamp"


def lineage(tables: dict[str, DataFrame], source: str, is_synthetic: bool = False) -> DataFrame:
    """Audit rows of the given tables: where from, how many rows, generated or not, when (UTC)."""
    return union_all(
        [
            df.agg(count_rows().alias("row_count")).select(
                F.lit(name).alias("table_name"), F.lit(source).alias("source"), "row_count",
                F.lit(is_synthetic).alias("is_synthetic"), F.current_timestamp().alias("updated_at"),
            )
            for name, df in tables.items()
        ]
    )


def lineage_rows(spark: SparkSession, counts: dict[str, int], source: str, is_synthetic: bool = False) -> DataFrame:
    """Audit rows from row counts already known."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame([(t, source, n, is_synthetic, now) for t, n in counts.items()], LINEAGE_COLUMNS)


def record_lineage(rows: DataFrame, path: str) -> None:
    """Append audit rows; the log keeps every load."""
    rows.write.mode("append").parquet(path)


def latest_lineage(log: DataFrame) -> DataFrame:
    """Last audit row of each table."""
    return log.groupBy("table_name").agg(
        *[F.max_by(c, "updated_at").alias(c) for c in ("source", "row_count", "is_synthetic")],
        F.max("updated_at").alias("updated_at"),
    )


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    return latest_lineage(spark.read.schema(LINEAGE_COLUMNS).parquet(path))
