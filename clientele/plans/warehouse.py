"""Bronze, silver and gold of one source, each built when first asked for and shared by all later queries.

* bronze: the ten tables as given, observed and generated rows in separate partitions; transactions also by
  month, clustered by ``rebalance`` so that adaptive execution sizes the files and splits a heavy month;
* silver: views over bronze;
* the last transaction date, row counts and missing values are taken from bronze once, one wide aggregate a table,
  so no query scans for them again (an ``Observation`` during the write would save that scan, but a session that has
  one can no longer ship Spark ML models to its tasks);
* every bronze table remembers the state of its source files: ``renew`` builds again what has changed, and what
  depends on it, and leaves the rest;
* activity: the few columns of transactions that customer features need. Where the source is the star schema and no
  query has asked for whole transactions, a narrow table is written for them in place of the table by month;
* gold: written tables. Customer features are written before they are scored, because scoring reads them
  twice (bounds, rows).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.config import RULES, BusinessRules
from clientele.functions.columns import count_rows
from clientele.operators import features, marts, semantic, staging
from clientele.operators.reports import opportunities
from clientele.operators.staging import tag_real
from clientele.sources.storage import file_state, remove, store
from clientele.sources.bank_tables import ACTIVITY, SOURCE_FILES, activity, bank_table, transactions_by_month
from clientele.sources.concurrent import run_all
from clientele.sources.schemas import COLUMNS, REFERENCE_TABLES, TABLES

MONTH = "txn_month"

TableSource = Callable[[str], DataFrame]
Store = Callable[[DataFrame, str, tuple[str, ...]], DataFrame]
FileState = Callable[[str], str]
GOLD = ("customer_360", "customer_segments", "nba")
ACTIVE = ("activity", "_last_active")
BUILT = ("accounts", "silver", "customer_features", "customer_360", "customer_segments", "nba", "metric_cube", "offer_stats")


class Warehouse:
    """``tables`` yields a source table, ``keep`` writes a named table and reads it back.

    ``monthly`` yields the tagged transactions clustered by month, where the source has a cheaper way than moving whole rows;
    ``narrow`` their ``ACTIVITY`` columns from a narrow table that its argument keeps, where whole rows are not needed.
    """

    def __init__(
        self, tables: TableSource, rules: BusinessRules = RULES, keep: Store = store, state: FileState | None = None,
        monthly: Callable[[], DataFrame] | None = None, narrow: Callable[[Callable[[DataFrame], DataFrame]], DataFrame] | None = None,
    ):
        self._source = tables
        self._rules = rules
        self._write = keep
        self._state = state
        self._monthly = monthly
        self._narrow = narrow
        self._states: dict[str, str] = {}
        self._kept: list[DataFrame] = []
        self._bronze: dict[str, DataFrame] = {}
        self._counted: dict[str, dict[str, object]] = {}

    @classmethod
    def from_star_schema(cls, spark: SparkSession, source_dir: str, rules: BusinessRules = RULES) -> Warehouse:
        return cls(
            lambda table: bank_table(spark, source_dir, table), rules,
            state=lambda table: file_state(spark, [f"{source_dir}/{name}.parquet" for name in SOURCE_FILES[table]]),
            monthly=lambda: transactions_by_month(spark, source_dir, MONTH),
            narrow=lambda keep: activity(spark, source_dir, keep),
        )

    def _keep(self, df: DataFrame, name: str, partition_by: tuple[str, ...]) -> DataFrame:
        self._kept.append(self._write(df, name, partition_by))
        return self._kept[-1]

    def renew(self) -> list[str]:
        """Forget the tables whose source files have changed since they were read, and all that was built from them.

        Returns the names of the changed tables. They, and what depends on them, are built anew when next asked for;
        without changes everything stays. Tables handed out before stay readable until ``close``.
        """
        if self._state is None:
            return []
        changed = [t for t, known in self._states.items() if self._state(t) != known]
        for table in changed:
            del self._states[table]
            self._bronze.pop(table, None)
            self._counted.pop(table, None)
        if changed:
            for name in (*BUILT, *(ACTIVE if "transactions" in changed else ())):
                self.__dict__.pop(name, None)
        return changed

    def close(self) -> None:
        """Remove every table that this warehouse has written; nothing handed out can be read afterwards."""
        for df in self._kept:
            remove(df)
        self._kept.clear()
        for kept in (self._bronze, self._states, self._counted):
            kept.clear()
        for name in (*BUILT, *ACTIVE):
            self.__dict__.pop(name, None)

    def _note_state(self, table: str) -> None:
        """Called before the files are read, so one that comes later counts as a change; a state noted already stays."""
        if self._state is not None and table not in self._states:
            self._states[table] = self._state(table)

    # bronze -----------------------------------------------------------------------------------------
    def bronze(self, table: str) -> DataFrame:
        if table not in self._bronze:
            self._note_state(table)
            name = f"bronze/{table}"
            if table == "transactions" and self._monthly is not None:
                self._bronze[table] = self._keep(self._monthly(), name, ("is_synthetic", MONTH))
                return self._bronze[table]
            rows = tag_real(self._source(table))
            if table == "transactions":
                by_month = rows.withColumn(MONTH, F.date_format("txn_datetime", "yyyy-MM"))
                clustered = by_month.hint("rebalance", "is_synthetic", MONTH)
                self._bronze[table] = self._keep(clustered, name, ("is_synthetic", MONTH))
            elif table in REFERENCE_TABLES:
                self._bronze[table] = self._keep(rows.withColumn("is_synthetic", F.lit(False)), name, ())
            else:
                self._bronze[table] = self._keep(rows, name, ("is_synthetic",))
        return self._bronze[table]

    def _count(self, table: str) -> dict[str, object]:
        """Rows, missing values and, of transactions, the last date, in one row; taken once."""
        if table not in self._counted:
            rows = self.bronze(table)
            missing = [F.count_if(F.col(c).isNull()).alias(c) for c in COLUMNS[table] if c in rows.columns]
            last = [F.max("txn_datetime").alias("last")] if table == "transactions" else []
            self._counted[table] = rows.agg(count_rows().alias("rows"), *missing, *last).first().asDict()
        return self._counted[table]

    def counts(self) -> dict[str, dict[str, int]]:
        """Per table its ``rows`` and the missing values of each column."""
        self.fill_bronze()
        spark = self.bronze(TABLES[0]).sparkSession
        found = run_all(spark, [partial(self._count, t) for t in TABLES], len(TABLES))
        return {t: {c: n for c, n in of.items() if c != "last"} for t, of in zip(TABLES, found, strict=True)}

    def as_of(self) -> Column:
        """Reference date of the portfolio."""
        last = self._last_active if self._is_narrow() else self._count("transactions")["last"]
        return F.lit(None if last is None else str(last)).cast("timestamp_ntz")

    def twins(self, table: str) -> tuple[DataFrame, DataFrame | None]:
        """Observed and generated rows; the filter prunes partitions."""
        rows = self.bronze(table)
        if table in REFERENCE_TABLES:
            return rows, None
        return rows.filter(~F.col("is_synthetic")), rows.filter("is_synthetic")

    def fill_bronze(self, tables: Iterable[str] = TABLES) -> None:
        """Write the tables, independent ones side by side."""
        missing = [t for t in tables if t not in self._bronze]
        if missing:
            spark = self._source(missing[0]).sparkSession
            run_all(spark, [partial(self.bronze, t) for t in missing])

    # silver -----------------------------------------------------------------------------------------
    @cached_property
    def accounts(self) -> DataFrame:
        """Corrected accounts, written: features, checks and reports share the scan for salary credits."""
        paid = self.activity if self._is_narrow() else self.table("transactions")
        corrected = staging.stg_accounts(*self.twins("accounts"), paid)
        return self._keep(corrected, "silver/accounts", ())

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        self.fill_bronze()
        return {t: self.table(t) for t in TABLES}

    def table(self, name: str) -> DataFrame:
        """A staged table."""
        if name == "accounts":
            return self.accounts
        if name == "loans":
            return staging.stg_loans(*self.twins(name), self._rules.dpd_threshold_days)
        build = getattr(staging, f"stg_{name}")
        return build(self.twins(name)[0]) if name in REFERENCE_TABLES else build(*self.twins(name))

    @property
    def monthly_transactions(self) -> DataFrame:
        """Staged transactions with their month, which prunes folders when filtered."""
        return self.bronze("transactions")

    # activity ---------------------------------------------------------------------------------------
    @cached_property
    def activity(self) -> DataFrame:
        """The ``ACTIVITY`` columns of the staged transactions: of the whole table where it stands or no narrow one can be had."""
        if self._narrow is None or "transactions" in self._bronze:
            return self.table("transactions").select(*ACTIVITY)
        self._note_state("transactions")
        rows = self._narrow(lambda df: self._keep(df, "silver/activity", ()))
        return rows.select(*[F.col(c).cast(COLUMNS["transactions"][c]).alias(c) for c in ACTIVITY])

    def _is_narrow(self) -> bool:
        """Whether transactions have been read as activity only."""
        return "activity" in self.__dict__ and "transactions" not in self._bronze

    @cached_property
    def _last_active(self) -> object:
        return self.activity.agg(F.max("txn_datetime")).first()[0]

    # gold -------------------------------------------------------------------------------------------
    @cached_property
    def customer_features(self) -> DataFrame:
        spark = self._source(features.TABLES[0]).sparkSession
        run_all(spark, [lambda: self.activity, *[partial(self.bronze, t) for t in features.TABLES]])
        silver = {t: self.table(t) for t in features.TABLES} | {"transactions": self.activity}
        return self._keep(features.customer_features(silver, self._rules, self.as_of()), "silver/customer_features", ())

    @cached_property
    def customer_360(self) -> DataFrame:
        return self._keep(marts.score_features(self.customer_features, self._rules), "gold/customer_360", ())

    @cached_property
    def customer_segments(self) -> DataFrame:
        return self._keep(marts.customer_segments(self.customer_360), "gold/customer_segments", ())

    @cached_property
    def nba(self) -> DataFrame:
        return self._keep(marts.next_best_action(self.customer_360), "gold/nba", ())

    @cached_property
    def metric_cube(self) -> DataFrame:
        """Sums from which every metric over any of the dimensions is answered."""
        return self._keep(semantic.metric_cube(self.customer_360), "gold/metric_cube", ())

    @cached_property
    def offer_stats(self) -> DataFrame:
        """Offer history by type: a few rows that several opportunity reports read more than once."""
        return self._keep(opportunities.offer_stats(self.table("offers")), "silver/offer_stats", ())

    def gold(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in GOLD}

    def source(self, table: str) -> DataFrame:
        """A source table with its contract columns only."""
        return self.bronze(table).select(*COLUMNS[table])

    def sources(self) -> dict[str, DataFrame]:
        return {t: self.source(t) for t in TABLES}

    def observed_rows(self, table: str) -> DataFrame:
        """The observed rows of one table; no other is built for it."""
        return self.twins(table)[0].select(*COLUMNS[table])

    def observed(self) -> dict[str, DataFrame]:
        """The observed rows of the ten tables, as a bootstrap wants them."""
        return {t: self.observed_rows(t) for t in TABLES}

    def tested(self) -> dict[str, DataFrame]:
        """Silver, feature and gold tables under the names the rule suite uses.

        The feature models are read from the written feature table, not computed again.
        """
        silver, made = self.silver, self.customer_features  # in this order: whole transactions are read anyway

        def part(*columns: str) -> DataFrame:
            return made.select("customer_id", *columns)

        return {
            **{f"stg_{t}": df for t, df in silver.items()},
            "int_customer_recency": part("recency_jours"),
            "int_customer_transaction_trend": part("tendance_transactions", "nb_txn_30j", "nb_txn_90j", "tendance_3m"),
            "int_customer_complaints": part("nb_reclamations_total", "nb_reclamations_ouvertes", "nb_reclamations_severite_haute"),
            "int_customer_digital_score": part("score_digital"),
            "int_customer_products": part("nb_comptes", "nb_cartes", "nb_produits_total"),
            "int_customer_balance": part("solde_total_xof", "avg_balance_90d_xof"),
            "int_customer_nbi": part("nbi_estime_xof"),
            "int_customer_channel": part("canal_majoritaire"),
            "int_customer_loans": part("dpd_max"),
            "customer_360": self.customer_360,
            "customer_segments": self.customer_segments,
            "nba": self.nba,
        }


_open: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, source_dir: str) -> Warehouse:
    """The warehouse of ``source_dir`` for the running application."""
    key = (spark.sparkContext.applicationId, source_dir)
    if key not in _open:
        _open[key] = Warehouse.from_star_schema(spark, source_dir)
    return _open[key]
