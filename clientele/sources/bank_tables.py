"""The ten bank tables derived from the given star-schema and event tables.

Each output column is one SQL expression over integer keys, written so that Spark and DuckDB read it alike;
``FIXTURES.md`` part C documents them. One row source per table, no pair of big tables is multiplied: the up
to three accounts (two cards) of a customer come from ``explode(sequence(...))``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _padded_id(prefix: str, key: str) -> str:
    """Key padded to eight digits and never cut, so that ids stay unique beyond 99,999,999 customers."""
    digits = f"cast({key} as string)"
    return f"'{prefix}'||lpad({digits},cast(greatest(8,length({digits})) as int),'0')"


#: Some customers have no history of a kind: their rows belong to a neighbour, so that no row is left out. The key
#: names an account, and rows on it belong to that account's owner.
ORDER_KEY = "(o_custkey-case when o_custkey%50=49 then 1 else 0 end)"
CARD_KEY = "(case when c_custkey%10<3 then greatest(1,c_custkey-c_custkey%10-1) else c_custkey end)"


def _owner(key: str) -> str:
    return f"({key}-case when {key}%17=16 then 1 else 0 end)"


# The five service channels, one per region.
_CHANNEL_NAME = (
    "case r_regionkey when 0 then 'Mobile App' when 1 then 'Internet Banking' when 2 then 'ATM' when 3 then "
    "'Agent / Mobile Money' else 'Branch' end"
)

# Derivation of every column.
COLUMN_RULES: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": _padded_id("C", "c_custkey"),
        "full_name": "c_name",
        "gender": "case when c_custkey%2=0 then 'F' else 'M' end",
        "date_of_birth": (
            "make_date(cast(1950+c_custkey%50 as int),cast(1+c_custkey%12 as "
            "int),cast(1+c_custkey%28 as int))"
        ),
        "city": "n_name",
        "district": "r_name",
        "occupation": "case when c_custkey%9=0 then null else 'JOB'||cast(c_custkey%9 as string) end",
        "segment": (
            "case c_mktsegment when 'AUTOMOBILE' then 'Premier' when 'BUILDING' then "
            "'Affluent' when 'MACHINERY' then 'Youth' else 'Mass' end"
        ),
        "monthly_income_xof": "cast(round(abs(c_acctbal)*100,0) as decimal(15,2))",
        "onboarding_date": (
            "make_date(cast(1990+c_custkey%5 as int),cast(1+c_custkey%12 as "
            "int),cast(1+c_custkey%28 as int))"
        ),
        "primary_branch_id": "'B'||cast(c_nationkey as string)",
        "preferred_channel": (
            "case c_custkey%4 when 0 then 'ATM' when 1 then 'Branch' when 2 then 'Internet "
            "Banking' else 'Mobile App' end"
        ),
        "mobile_app_active": "c_custkey%2=0",
        "internet_banking_active": "c_custkey%3=0",
        "mobile_money_linked": "c_custkey%5<>0",
        "kyc_level": "case when c_custkey%3=0 then 'Enhanced' else 'Standard' end",
        "risk_band": "case when c_custkey%20=0 then 'High' when c_custkey%20<5 then 'Medium' else 'Low' end",
        "marketing_opt_in": "c_custkey%2=1",
        "last_contact_date": "make_date(2001,cast(1+c_custkey%12 as int),cast(1+c_custkey%28 as int))",
        "marital_status": "case when c_custkey%3=1 then 'Married' else 'Single' end",
        "is_synthetic": "c_custkey%4=3",
    },
    "accounts": {
        "account_id": _padded_id("A", "c_custkey") + "||'-'||cast(i as string)",
        "customer_id": _padded_id("C", _owner("c_custkey")),
        "account_type": (
            "case when i=0 and c_mktsegment='MACHINERY' then 'Student' when i=0 then "
            "'Current' when i=1 then 'Savings' else 'Premier Current' end"
        ),
        "currency": "'XOF'",
        "open_date": "make_date(cast(1990+c_custkey%5 as int),cast(1+i as int),cast(1+c_custkey%28 as int))",
        "status": "case when (c_custkey+i)%8=0 then 'Dormant' else 'Open' end",
        "branch_id": "'B'||cast(c_nationkey as string)",
        "avg_balance_90d_xof": "cast(round(abs(c_acctbal)*900/(i+1),0) as decimal(15,2))",
        "current_balance_xof": "cast(round(c_acctbal*1000/(i+1),0) as decimal(15,2))",
        "salary_domiciled_flag": "(c_custkey%6=0 and i=0)",
        "overdraft_limit_xof": "cast(50000*(i+1) as decimal(15,2))",
        "is_synthetic": _owner("c_custkey") + "%4=3",
    },
    "transactions": {
        "txn_id": (
            "'T'||cast(l_orderkey as string)||'-'||cast(l_linenumber as "
            "string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as "
            "string)||'-'||cast(l_shipdate as date)"
        ),
        "account_id": _padded_id("A", ORDER_KEY) + "||'-0'",
        "customer_id": _padded_id("C", _owner(ORDER_KEY)),
        "txn_datetime": "l_shipdate",
        "txn_type": (
            "case when l_partkey%160=0 then 'salary_credit' else case l_partkey%9 when 0 then"
            " 'atm_withdrawal' when 1 then 'bill_payment' when 2 then 'card_purchase' when 3 "
            "then 'cash_deposit' when 4 then 'loan_repayment' when 5 then "
            "'mobilemoney_cashout' when 6 then 'p2p_transfer' when 7 then 'transfer_in' else "
            "'transfer_out' end end"
        ),
        "channel_id": "case when l_suppkey%10=9 then null else 'CH'||cast(l_suppkey%5 as string) end",
        "merchant_category": "case when l_partkey%9=2 then 'MCC'||cast(l_partkey%4 as string) end",
        "amount_xof": "cast(l_extendedprice as decimal(15,2))",
        "direction": "case when l_partkey%160=0 or l_partkey%9 in (3,7) then 'IN' else 'OUT' end",
        "counterparty_type": "case when l_suppkey%2=0 then 'Person' else 'Merchant' end",
        "city": "'CITY'||cast(l_suppkey%7 as string)",
        "is_international": "l_returnflag='N' and l_linestatus='F'",
        "is_disputed": "l_returnflag='R' and l_partkey%50=1",
        "is_synthetic": _owner(ORDER_KEY) + "%4=3",
    },
    "loans": {
        "loan_id": "'L'||cast(o_orderkey as string)",
        "customer_id": _padded_id("C", _owner(ORDER_KEY)),
        "repayment_account_id": _padded_id("A", ORDER_KEY) + "||'-0'",
        "loan_type": (
            "case o_orderkey%3 when 0 then 'Asset Finance' when 1 then 'Personal Loan' else "
            "'Salary Advance' end"
        ),
        "origination_date": "cast(o_orderdate as date)",
        "principal_xof": "cast(o_totalprice as decimal(15,2))",
        "interest_rate_pct": "cast(5+o_orderkey%10 as decimal(5,2))",
        "term_months": "cast(12*(1+o_orderkey%5) as int)",
        "monthly_installment_xof": "cast(floor(o_totalprice/24) as decimal(15,2))",
        "outstanding_balance_xof": "cast(floor(o_totalprice/2) as decimal(15,2))",
        "days_past_due": "cast(o_orderkey%45 as int)",
        "status": (
            "case o_orderstatus when 'O' then 'Current' when 'P' then 'Watchlist' else "
            "'Delinquent' end"
        ),
        "purpose": "'P'||cast(o_orderkey%6 as string)",
        "collateral_flag": "o_orderkey%2=0",
        "next_due_date": "cast(o_orderdate + interval 30 day as date)",
        "is_synthetic": _owner(ORDER_KEY) + "%4=3",
    },
    "cards": {
        "card_id": _padded_id("K", "c_custkey") + "||'-'||cast(i as string)",
        "customer_id": _padded_id("C", _owner(CARD_KEY)),
        "account_id": _padded_id("A", CARD_KEY) + "||'-0'",
        "card_type": "case (c_custkey+i)%3 when 0 then 'Credit' when 1 then 'Debit' else 'Prepaid' end",
        "card_tier": "case when c_custkey%4=0 then 'Gold' else 'Classic' end",
        "network": "case when c_custkey%2=0 then 'NET-A' else 'NET-B' end",
        "issue_date": "make_date(cast(1996+i*2 as int),cast(1+c_custkey%12 as int),1)",
        "expiry_date": "make_date(cast(2002+i*2 as int),cast(1+c_custkey%12 as int),1)",
        "status": "case (c_custkey+i)%10 when 0 then 'Blocked' when 1 then 'Expired' else 'Active' end",
        "contactless_flag": "c_custkey%2=0",
        "ecommerce_enabled": "c_custkey%3=0",
        "monthly_spend_90d_xof": "cast(round(abs(c_acctbal)*10,0) as decimal(15,2))",
        "is_synthetic": _owner(CARD_KEY) + "%4=3",
    },
    "branches": {
        "branch_id": "'B'||cast(n_nationkey as string)",
        "branch_name": "'Branch '||n_name",
        "city": "n_name",
        "district": "r_name",
        "branch_type": "case n_nationkey%3 when 0 then 'Flagship' when 1 then 'Regional' else 'Urban' end",
    },
    "channels": {
        "channel_id": "'CH'||cast(r_regionkey as string)",
        "channel_name": _CHANNEL_NAME,
        "channel_group": "case r_regionkey when 0 then 'Digital' when 1 then 'Digital' when 3 then 'Partner' else 'Physical' end",
        "description": _CHANNEL_NAME + "||' channel'",
    },
    "interactions": {
        "interaction_id": "'I'||cast(event_id as string)",
        "customer_id": _padded_id("C", "user_id"),
        "interaction_datetime": "ts",
        "channel": "case event_id%3 when 0 then 'Phone' when 1 then 'Branch' else 'Chat' end",
        "interaction_type": "event_type",
        "topic": "'T'||cast(event_id%5 as string)",
        "sentiment": (
            "case when event_type in ('purchase','signup') and event_id%4<>0 then 'Positive' "
            "when event_id%4=1 then 'Neutral' else 'Negative' end"
        ),
        "resolved_flag": "event_id%3<>0",
        "resolution_time_hours": "cast(round(value,2) as decimal(10,2))",
        "agent_team": "'TEAM'||cast(event_id%4 as string)",
        "notes": "props",
        "is_synthetic": "user_id%4=3",
    },
    "complaints": {
        "complaint_id": "'CMP'||cast(event_id as string)",
        "customer_id": _padded_id("C", "user_id"),
        "opened_date": "cast(ts as date)",
        "closed_date": "case when event_id%5=0 then null else cast(ts + interval 7 day as date) end",
        "category": (
            "case event_id%4 when 0 then 'Card' when 1 then 'Fees' when 2 then 'Mobile App' "
            "else 'Branch' end"
        ),
        "severity": "case event_id%3 when 0 then 'High' when 1 then 'Medium' else 'Low' end",
        "status": "case when event_id%5=0 then 'Open' else 'Closed' end",
        "root_cause": "'RC'||cast(event_id%6 as string)",
        "compensation_xof": "cast(round(value*100,0) as decimal(15,2))",
        "free_text": "props",
        "is_synthetic": "user_id%4=3",
    },
    "offers": {
        "offer_id": "'O'||cast(o_orderkey as string)",
        "customer_id": _padded_id("C", "o_custkey"),
        "offer_date": "cast(o_orderdate as date)",
        "offer_type": (
            "case o_orderpriority when '1-URGENT' then 'Card upgrade' when '2-HIGH' then "
            "'Digital activation' when '3-MEDIUM' then 'Personal loan' when '5-LOW' then "
            "'Savings product' else 'Travel card' end"
        ),
        "channel": "case when o_orderkey%8=1 then 'Email' else 'Branch' end",
        "accepted_flag": "o_orderstatus='F'",
        "product_target": "'PT'||cast(o_orderkey%3 as string)",
        "expected_value_xof": "cast(o_totalprice as decimal(15,2))",
        "is_synthetic": "o_custkey%4=3",
    },
}

def _read(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{source_dir}/{name}.parquet")


def _customer_rows(spark: SparkSession, d: str) -> DataFrame:
    nation = _read(spark, d, "nation").join(
        _read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return _read(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def _per_customer(last: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _read(spark, d, "customer").withColumn("i", F.explode(F.expr(f"sequence(0, cast({last} as int))")))


def _transaction_rows(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").join(_read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))


def _branch_rows(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "nation").join(
        _read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def _whole(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _read(spark, d, name)


def _filtered(name: str, keep: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _read(spark, d, name).filter(keep)


ROW_SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": _customer_rows,
    "accounts": _per_customer("c_custkey%3"),
    "transactions": _transaction_rows,
    "loans": _whole("orders"),
    "cards": _per_customer("c_custkey%2"),
    "branches": _branch_rows,
    "channels": _whole("region"),
    "interactions": _filtered("events", "event_type<>'error'"),
    "complaints": _filtered("events", "event_type='error'"),
    "offers": _whole("orders"),
}


#: The given tables that each bank table is derived from.
SOURCE_FILES: dict[str, tuple[str, ...]] = {
    "customers": ("customer", "nation", "region"), "accounts": ("customer",), "transactions": ("lineitem", "orders"), "loans": ("orders",),
    "cards": ("customer",), "branches": ("nation", "region"), "channels": ("region",), "interactions": ("events",),
    "complaints": ("events",), "offers": ("orders",),
}


#: What the columns of a transaction are derived from.
TRANSACTION_KEYS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_returnflag", "l_linestatus", "o_custkey",
)


def transactions_by_month(spark: SparkSession, source_dir: str, month: str) -> DataFrame:
    """Transactions with their ``month``, brought together and sorted by ``is_synthetic`` and month.

    What moves and is sorted are the narrow given columns; the texts, several times as wide, are derived behind that.
    """
    rules = COLUMN_RULES["transactions"]
    rows = ROW_SOURCES["transactions"](spark, source_dir)
    said = F.coalesce(F.expr(rules["is_synthetic"]), F.lit(False)).alias("is_synthetic")
    when = F.date_format(F.expr(rules["txn_datetime"]), "yyyy-MM").alias(month)
    narrow = rows.select(*TRANSACTION_KEYS, said, when).hint("rebalance", "is_synthetic", month).sortWithinPartitions("is_synthetic", month)
    return narrow.select(*[F.expr(rule).alias(name) for name, rule in rules.items() if name != "is_synthetic"], "is_synthetic", month)


#: The columns of a transaction that customer features read; the first two are texts of the customer's number.
ACTIVITY = ("account_id", "customer_id", "txn_datetime", "txn_type", "channel_id")


def activity(spark: SparkSession, source_dir: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The ``ACTIVITY`` columns of all transactions from a narrow table that ``keep`` writes and reads back.

    Only the given columns behind them meet the orders, nothing moves by month, and the number is what is written.
    """
    rules = COLUMN_RULES["transactions"]
    plain = [F.expr(rules[name]).alias(name) for name in ACTIVITY[2:]]
    kept = keep(ROW_SOURCES["transactions"](spark, source_dir).select("o_custkey", *plain))
    return kept.select(*[F.expr(rules[name]).alias(name) for name in ACTIVITY[:2]], *ACTIVITY[2:])


def bank_table(spark: SparkSession, source_dir: str, table: str) -> DataFrame:
    """One of the ten bank tables; all but the reference lists carry ``is_synthetic``."""
    rules = COLUMN_RULES[table]
    return ROW_SOURCES[table](spark, source_dir).selectExpr(*[f"{rule} AS {name}" for name, rule in rules.items()])
