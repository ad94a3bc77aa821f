"""Column contract of the ten source tables: names, types, keys, accepted values and references."""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "decimal(15,2)"

# The source column contract.
COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "string", "full_name": "string", "gender": "string", "date_of_birth": "date",
        "city": "string", "district": "string", "occupation": "string", "segment": "string",
        "monthly_income_xof": MONEY, "onboarding_date": "date", "primary_branch_id": "string",
        "preferred_channel": "string", "mobile_app_active": "boolean", "internet_banking_active": "boolean",
        "mobile_money_linked": "boolean", "kyc_level": "string", "risk_band": "string",
        "marketing_opt_in": "boolean", "last_contact_date": "date", "marital_status": "string",
    },
    "accounts": {
        "account_id": "string", "customer_id": "string", "account_type": "string", "currency": "string",
        "open_date": "date", "status": "string", "branch_id": "string", "avg_balance_90d_xof": MONEY,
        "current_balance_xof": MONEY, "salary_domiciled_flag": "boolean", "overdraft_limit_xof": MONEY,
    },
    "transactions": {
        "txn_id": "string", "account_id": "string", "customer_id": "string", "txn_datetime": "timestamp_ntz",
        "txn_type": "string", "channel_id": "string", "merchant_category": "string", "amount_xof": MONEY,
        "direction": "string", "counterparty_type": "string", "city": "string",
        "is_international": "boolean", "is_disputed": "boolean",
    },
    "loans": {
        "loan_id": "string", "customer_id": "string", "repayment_account_id": "string", "loan_type": "string",
        "origination_date": "date", "principal_xof": MONEY, "interest_rate_pct": "decimal(5,2)",
        "term_months": "int", "monthly_installment_xof": MONEY, "outstanding_balance_xof": MONEY,
        "days_past_due": "int", "status": "string", "purpose": "string", "collateral_flag": "boolean",
        "next_due_date": "date",
    },
    "cards": {
        "card_id": "string", "customer_id": "string", "account_id": "string", "card_type": "string",
        "card_tier": "string", "network": "string", "issue_date": "date", "expiry_date": "date",
        "status": "string", "contactless_flag": "boolean", "ecommerce_enabled": "boolean",
        "monthly_spend_90d_xof": MONEY,
    },
    "branches": {
        "branch_id": "string", "branch_name": "string", "city": "string", "district": "string",
        "branch_type": "string",
    },
    "channels": {
        "channel_id": "string", "channel_name": "string", "channel_group": "string", "description": "string",
    },
    "interactions": {
        "interaction_id": "string", "customer_id": "string", "interaction_datetime": "timestamp_ntz",
        "channel": "string", "interaction_type": "string", "topic": "string", "sentiment": "string",
        "resolved_flag": "boolean", "resolution_time_hours": "decimal(10,2)", "agent_team": "string",
        "notes": "string",
    },
    "complaints": {
        "complaint_id": "string", "customer_id": "string", "opened_date": "date", "closed_date": "date",
        "category": "string", "severity": "string", "status": "string", "root_cause": "string",
        "compensation_xof": MONEY, "free_text": "string",
    },
    "offers": {
        "offer_id": "string", "customer_id": "string", "offer_date": "date", "offer_type": "string",
        "channel": "string", "accepted_flag": "boolean", "product_target": "string",
        "expected_value_xof": MONEY,
    },
}

TABLES: tuple[str, ...] = tuple(COLUMNS)
REFERENCE_TABLES = ("branches", "channels")  # shared lists without generated rows
GENERATED_TABLES = tuple(t for t in TABLES if t not in REFERENCE_TABLES)

KEYS: dict[str, str] = {
    "customers": "customer_id", "accounts": "account_id", "transactions": "txn_id", "loans": "loan_id",
    "cards": "card_id", "branches": "branch_id", "channels": "channel_id", "interactions": "interaction_id",
    "complaints": "complaint_id", "offers": "offer_id",
}

# Child table, child key, parent table, parent key.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("accounts", "customer_id", "customers", "customer_id"),
    ("transactions", "account_id", "accounts", "account_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("loans", "customer_id", "customers", "customer_id"),
    ("cards", "customer_id", "customers", "customer_id"),
    ("cards", "account_id", "accounts", "account_id"),
    ("interactions", "customer_id", "customers", "customer_id"),
    ("complaints", "customer_id", "customers", "customer_id"),
    ("offers", "customer_id", "customers", "customer_id"),
    ("accounts", "branch_id", "branches", "branch_id"),
    ("customers", "primary_branch_id", "branches", "branch_id"),
    ("transactions", "channel_id", "channels", "channel_id"),
)


def struct_type(table: str, with_flag: bool = False) -> StructType:
    """Explicit reader schema of a source table."""
    fields = [f"`{name}` {kind}" for name, kind in COLUMNS[table].items()]
    if with_flag:
        fields.append("`is_synthetic` boolean")
    return StructType.fromDDL(", ".join(fields))
