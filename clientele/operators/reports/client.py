"""Client page: search, detail, products, recent activity, advisor suggestion.

Functions taking ``customer_id`` serve one client (the filter reaches the scan) or, without it, all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows
from clientele.operators.features import ID

SEARCH_COLUMNS = ("customer_id", "full_name", "city", "segment")
RESULT_COLUMNS = ("customer_id", "full_name", "segment", "city", "risque_composite")


def _of(df: DataFrame, customer_id: str | None) -> DataFrame:
    return df if customer_id is None else df.filter(F.col(ID) == customer_id)


def search(c360: DataFrame, text: str = "", suggestions: int = 10) -> DataFrame:
    """Customers whose id, name, city or segment contains the text, whatever its case and accents.

    Without text, the riskiest customers are suggested.
    """
    if not text:
        return c360.select(*RESULT_COLUMNS).orderBy(F.col("risque_composite").desc(), ID).limit(suggestions)
    hit: Column = F.lit(False)
    for name in SEARCH_COLUMNS:
        hit = hit | F.contains(F.collate(F.col(name), "UNICODE_CI_AI"), F.collate(F.lit(text), "UNICODE_CI_AI"))
    return c360.filter(hit).select(*RESULT_COLUMNS)


def client_detail(c360: DataFrame, nba: DataFrame, cust: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Customer 360 row with the recommended action and the occupation."""
    return (
        _of(c360, customer_id)
        .join(_of(nba, customer_id).select(ID, "next_best_action"), ID, "left")
        .join(_of(cust, customer_id).select(ID, "occupation"), ID, "left")
    )


def product_snapshot(
    cust: DataFrame, cards: DataFrame, accounts: DataFrame, loans: DataFrame, customer_id: str | None = None
) -> DataFrame:
    """Newest card, largest account, newest loan and a savings account of each customer."""

    def top(df: DataFrame, fields: dict[str, str], order: Column) -> DataFrame:
        picked = F.max_by(F.struct(*[F.col(c).alias(n) for n, c in fields.items()]), order).alias("top")
        return _of(df, customer_id).groupBy(ID).agg(picked).select(ID, "top.*")

    card = top(cards, {"carte_niveau": "card_tier", "carte_statut": "status"}, F.struct("issue_date", "card_id"))
    account = top(
        accounts, {"compte_type": "account_type", "compte_solde": "current_balance_xof"},
        F.struct("current_balance_xof", "account_id"),
    )
    loan = top(
        loans, {"pret_encours": "outstanding_balance_xof", "pret_statut": "status_corrige"},
        F.struct("origination_date", "loan_id"),
    )
    savings = top(
        accounts.filter(F.col("account_type") == "Savings"), {"epargne_solde": "current_balance_xof"}, F.col("account_id")
    )
    result = _of(cust, customer_id).select(ID)
    for part in (card, account, loan, savings):
        result = result.join(part, ID, "left")
    return result


def monthly_activity(txn: DataFrame, customer_id: str | None = None, months: int = 6) -> DataFrame:
    """Transactions per month over the last months with activity; ``en_hausse`` when the last is not below the first."""
    per_month = (
        _of(txn, customer_id)
        .groupBy(ID, F.date_trunc("month", F.col("txn_datetime")).cast("date").alias("mois"))
        .agg(count_rows().alias("nb_txn"))
    )
    newest = Window.partitionBy(ID).orderBy(F.col("mois").desc())
    kept = per_month.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= months)
    whole = Window.partitionBy(ID)
    rising = F.max_by("nb_txn", "mois").over(whole) >= F.min_by("nb_txn", "mois").over(whole)
    return kept.select(ID, "mois", "nb_txn", rising.alias("en_hausse"))


def _latest(df: DataFrame, when: str, key: str, k: int) -> DataFrame:
    """The k latest rows per customer; each task drops all but its own k before the shuffle."""
    newest = Window.partitionBy(ID).orderBy(F.col(when).desc(), F.col(key).desc())
    return df.withColumn("rang", F.row_number().over(newest)).filter(F.col("rang") <= k)


def recent_txns(txn: DataFrame, channels: DataFrame, customer_id: str | None = None, k: int = 5) -> DataFrame:
    narrow = _of(txn, customer_id).select(ID, "txn_id", "txn_datetime", "txn_type", "amount_xof", "channel_id")
    return (
        _latest(narrow, "txn_datetime", "txn_id", k)
        .join(channels.select("channel_id", "channel_name"), "channel_id", "left")
        .select(ID, "rang", "txn_id", "txn_datetime", "txn_type", "amount_xof", "channel_name")
    )


def recent_interactions(interactions: DataFrame, customer_id: str | None = None, k: int = 5) -> DataFrame:
    narrow = _of(interactions, customer_id).select(
        ID, "interaction_id", "interaction_datetime", "interaction_type", "sentiment"
    )
    return _latest(narrow, "interaction_datetime", "interaction_id", k)


def open_complaints(complaints: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Open complaints, newest first."""
    return (
        _of(complaints, customer_id)
        .filter(F.col("status") == "Open")
        .select(ID, "complaint_id", "category", "severity", "opened_date", "status")
        .orderBy(F.col("opened_date").desc(), "complaint_id")
    )


def advisor_action(c360: DataFrame) -> DataFrame:
    """What the adviser should propose, by risk level and then by missing product."""
    risk = F.col("risque_composite")
    action = (
        F.when(risk >= 70, "appel_urgent")
        .when(risk >= 40, "offre_fidelisation")
        .when(F.col("nb_cartes") == 0, "offre_carte")
        .when(~F.col("salaire_domicilie"), "offre_domiciliation_salaire")
        .otherwise("offre_epargne")
    )
    return c360.select(ID, "risque_composite", action.alias("action_conseiller"))
