"""Oracle SQL of quality, exploratory, synthetic-cohort and learning queries."""

from __future__ import annotations

from clientele.operators.quality import suite_rules
from clientele.oracle.base import with_bank
from clientele.sources.schemas import COLUMNS, FOREIGN_KEYS, KEYS, TABLES

ORACLES: dict[str, str] = {}


def sql(name: str, text: str, **extra: str) -> None:
    ORACLES[name] = with_bank(text, **extra)


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# Data quality ------------------------------------------------------------------------------------
def _validation(table: str, columns: list[str], errors: str) -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    return (f"SELECT '{table}' AS table_name, count(*) AS lignes, round(100.0 * ({nulls}) / (count(*) * {len(columns)}), 2) "
            f"AS taux_nuls_pct, '{errors}' AS erreurs FROM bank_{table}")


sql("dq1_validation", union([_validation(t, list(c), "") for t, c in COLUMNS.items()]))
_parts = []
for _t, _c in COLUMNS.items():
    if _t == "cards":
        continue
    _gone = [c for c in _c if c in ("occupation", "severity")]
    _parts.append(_validation(_t, [c for c in _c if c not in _gone], f"colonnes manquantes: {', '.join(_gone)}" if _gone else ""))
_parts.append("SELECT 'cards', 0, NULL, 'table absente'")
sql("dq2_schema_check", union(_parts))
sql("dq3_not_null", "SELECT customer_id, segment FROM bank_customers WHERE occupation IS NULL")
sql("dq4_unique", """SELECT account_id, count(*) AS n FROM bank_transactions WHERE account_id IS NOT NULL GROUP BY 1
HAVING count(*) > 1""")
sql("dq5_accepted_values", """
SELECT txn_type, count(*) AS n FROM bank_transactions
WHERE txn_type NOT IN ('bill_payment', 'card_purchase', 'salary_credit') GROUP BY 1""")
sql("dq6_relationships", """
SELECT account_id AS cle, count(*) AS n FROM bank_transactions
WHERE account_id NOT IN (SELECT account_id FROM bank_cards) GROUP BY 1""")
sql("dq7_action_filled", """
SELECT customer_id, next_best_action FROM nba WHERE next_best_action IS NULL OR trim(next_best_action) = ''""")
sql("dq7_blank_values", "SELECT customer_id FROM bank_customers WHERE occupation IS NULL OR trim(occupation) = ''")
sql("dq8_risk_bounds", """
SELECT customer_id, risque_composite FROM c360 WHERE risque_composite < 0 OR risque_composite > 100""")
sql("dq8_risk_bounds_5_40", """
SELECT customer_id, risque_composite FROM c360 WHERE risque_composite < 5 OR risque_composite > 40""")

_SUITE_TABLES = {
    "int_customer_recency": "int_recency", "int_customer_transaction_trend": "int_trend",
    "int_customer_complaints": "int_complaints", "int_customer_digital_score": "int_digital",
    "int_customer_products": "int_products", "int_customer_balance": "int_balance", "int_customer_nbi": "int_nbi",
    "int_customer_channel": "int_channel", "int_customer_loans": "int_loans", "customer_360": "c360",
    "customer_segments": "segments",
}
_VIOLATIONS = {
    "not_null": "SELECT count(*) FROM {t} WHERE {c} IS NULL",
    "unique": "SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) q",
    "accepted_values": "SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ({v})",
    "relationships": "SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{c})",
}
_EXPECTED = {
    "nba": "SELECT count(*) FROM nba WHERE next_best_action IS NULL OR trim(next_best_action) = ''",
    "customer_360": "SELECT count(*) FROM c360 WHERE risque_composite < 0 OR risque_composite > 100",
}


def _suite(rules) -> str:
    lines = []
    for r in rules:
        if r.kind == "expect":
            count = _EXPECTED[r.table]
        else:
            parent, key = r.parent or ("", "")
            count = _VIOLATIONS[r.kind].format(
                t=_SUITE_TABLES.get(r.table, r.table), c=r.column, v=", ".join(f"'{v}'" for v in r.values),
                p=_SUITE_TABLES.get(parent, parent), pk=key,
            )
        lines.append(f"SELECT '{r.name}' AS regle, '{r.kind}' AS type_regle, '{r.table}' AS table_name, "
                     f"'{r.column}' AS colonne, ({count}) AS violations")
    return union(lines)


sql("dq9_rule_suite", _suite(suite_rules()))
_STRICT = (
    ("unique:stg_transactions.customer_id", "unique", "stg_transactions", "customer_id",
     "SELECT count(*) FROM (SELECT customer_id FROM stg_transactions GROUP BY 1 HAVING count(*) > 1) q"),
    ("not_null:stg_transactions.channel_id", "not_null", "stg_transactions", "channel_id",
     "SELECT count(*) FROM stg_transactions WHERE channel_id IS NULL"),
    ("accepted_values:stg_transactions.txn_type", "accepted_values", "stg_transactions", "txn_type",
     "SELECT count(DISTINCT txn_type) FROM stg_transactions WHERE txn_type NOT IN ('bill_payment', 'salary_credit')"),
    ("accepted_values:stg_transactions.direction", "accepted_values", "stg_transactions", "direction",
     "SELECT count(DISTINCT direction) FROM stg_transactions WHERE direction <> 'IN'"),
    ("not_null:stg_transactions.merchant_category", "not_null", "stg_transactions", "merchant_category",
     "SELECT count(*) FROM stg_transactions WHERE merchant_category IS NULL"),
    ("relationships:stg_transactions.account_id->stg_cards.account_id", "relationships", "stg_transactions", "account_id",
     "SELECT count(*) FROM stg_transactions WHERE account_id NOT IN (SELECT account_id FROM stg_cards)"),
    ("not_null:stg_customers.occupation", "not_null", "stg_customers", "occupation",
     "SELECT count(*) FROM stg_customers WHERE occupation IS NULL"),
    ("accepted_values:stg_customers.segment", "accepted_values", "stg_customers", "segment",
     "SELECT count(DISTINCT segment) FROM stg_customers WHERE segment <> 'Mass'"),
)
sql("dq9_rule_suite_strict", union([
    f"SELECT '{n}' AS regle, '{k}' AS type_regle, '{t}' AS table_name, '{c}' AS colonne, ({q}) AS violations"
    for n, k, t, c, q in _STRICT]))


def _orphans(customers: str) -> str:
    def table(name: str) -> str:
        return customers if name == "customers" else f"bank_{name}"

    return union([
        f"SELECT '{c}.{ck} -> {p}' AS relation, (SELECT count(DISTINCT {ck}) FROM {table(c)} x WHERE {ck} IS NOT NULL AND NOT "
        f"EXISTS (SELECT 1 FROM {table(p)} y WHERE y.{pk} = x.{ck})) AS cles_orphelines" for c, ck, p, pk in FOREIGN_KEYS])


sql("dq10_orphan_matrix", _orphans("bank_customers"))
sql("dq10_orphan_matrix_broken", _orphans("broken"), broken="""
SELECT * REPLACE (CASE WHEN gender = 'F' THEN customer_id ELSE customer_id || 'x' END AS customer_id) FROM bank_customers""")
sql("dq11_null_profile", "SELECT * FROM (" + union([
    f"SELECT '{t}' AS table_name, '{c}' AS colonne, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 1) AS pct FROM bank_{t}"
    for t, columns in COLUMNS.items() for c in columns]) + ") q WHERE nulls > 0")
sql("src6_rerun", union([
    f"SELECT '{t}' AS table_name, FALSE AS rebuilt, count(*) AS rows_before, count(*) AS rows_after FROM bank_{t}" for t in TABLES]))
sql("src9_refresh_job", union([
    f"SELECT '{s}' AS step, 'ok' AS status, (SELECT count(*) + 400 FROM bank_customers WHERE NOT is_synthetic) AS published_customers"
    for s in ("load", "enrich", "synthesize", "bronze", "gold", "checks", "model", "publish")]))
ORACLES["dq11_null_profile_observed"] = ORACLES["dq11_null_profile"]
_OWN = [t for t in TABLES if t not in ("branches", "channels")]
sql("dq11_dup_profile", union([
    f"SELECT '{t}' AS table_name, '{KEYS[t]}' AS cle, count(*) - count(DISTINCT {KEYS[t]}) AS doublons FROM bank_{t}" for t in _OWN]))
sql("dq11_dup_profile_doubled", union([
    f"SELECT '{t}' AS table_name, '{KEYS[t]}' AS cle, {2 if t in ('loans', 'transactions') else 1} * count(*) "
    f"- count(DISTINCT {KEYS[t]}) AS doublons FROM bank_{t}" for t in _OWN]))
sql("dq12_lineage", union([
    f"SELECT '{t}' AS table_name, 'star_schema' AS source, count(*) AS row_count, FALSE AS is_synthetic FROM bank_{t}"
    for t in TABLES]))
sql("dq13_iqr_outliers", union([
    f"SELECT '{t}.{c}' AS colonne, (SELECT count(*) FROM (SELECT CAST({c} AS DOUBLE) AS x FROM bank_{t}) d, "
    f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM bank_{t}) q "
    f"WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS nb_aberrants"
    for t, c in (("transactions", "amount_xof"), ("accounts", "avg_balance_90d_xof"), ("loans", "outstanding_balance_xof"),
                 ("customers", "monthly_income_xof"))]))
sql("dq14_loan_status_conflicts", """
SELECT loan_id, status, days_past_due FROM bank_loans WHERE days_past_due > 15 AND status = 'Current'""")
sql("dq14_worst_arrears", "SELECT loan_id, status, days_past_due FROM bank_loans ORDER BY days_past_due DESC, loan_id LIMIT 10")
sql("dq15_salary_flag_conflicts", """
SELECT account_id, customer_id, salary_domiciled_flag FROM bank_accounts WHERE NOT salary_domiciled_flag
  AND account_id IN (SELECT account_id FROM bank_transactions WHERE txn_type ILIKE '%salary%')""")

# Exploratory profiles ----------------------------------------------------------------------------
sql("eda1_table_sizes", union([
    f"SELECT '{t}' AS table_name, count(*) AS lignes, {len(c)} AS colonnes FROM bank_{t}" for t, c in COLUMNS.items()]))
for _table, _column, _k in (
    ("customers", "segment", None), ("customers", "risk_band", None), ("customers", "city", 8),
    ("accounts", "account_type", None), ("transactions", "txn_type", None), ("interactions", "sentiment", None),
    ("complaints", "status", None), ("complaints", "severity", None),
):
    sql(f"eda2_{_table}_{_column}", f"SELECT {_column}, count(*) AS n FROM bank_{_table} GROUP BY 1 ORDER BY n DESC, {_column}"
        + (f" LIMIT {_k}" if _k else ""))
for _name, _table, _flags in (
    ("eda3_digital_rates", "customers", ("mobile_app_active", "internet_banking_active", "mobile_money_linked")),
    ("eda3_domiciled_rate", "accounts", ("salary_domiciled_flag",)),
    ("eda3_resolution_rate", "interactions", ("resolved_flag",)),
):
    sql(_name, union([f"SELECT '{f}' AS indicateur, round(100.0 * avg(CAST({f} AS INT)), 6) AS taux_pct FROM bank_{_table}"
                      for f in _flags]))


def _quartiles(x: str) -> str:
    return (f"round(quantile_cont({x}, 0.25), 4) AS q1, round(quantile_cont({x}, 0.5), 4) AS mediane, "
            f"round(quantile_cont({x}, 0.75), 4) AS q3")


sql("eda4_balance_five_numbers", f"""
SELECT account_type, round(min(x), 4) AS minimum, {_quartiles("x")}, round(max(x), 4) AS maximum
FROM (SELECT account_type, CAST(avg_balance_90d_xof AS DOUBLE) AS x FROM bank_accounts) q GROUP BY 1""")
sql("eda5_txn_by_channel_group", """
SELECT channel_group, count(*) AS n FROM bank_transactions t JOIN bank_channels c ON c.channel_id = t.channel_id GROUP BY 1""")
_ELAPSED = """
SELECT customer_id, date_sub('day', max(txn_datetime), (SELECT max(txn_datetime) FROM bank_transactions)) AS x
FROM bank_transactions GROUP BY 1"""


def _describe(source: str) -> str:
    return f"""
SELECT count(x) AS n, round(avg(x), 4) AS moyenne, round(stddev_samp(x), 4) AS ecart_type, min(x) AS minimum,
  {_quartiles("x")}, max(x) AS maximum FROM (SELECT CAST(x AS DOUBLE) AS x FROM {source}) q"""


def _histogram(source: str, bins: int) -> str:
    return f"""
SELECT CAST(least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS classe, count(*) AS n
FROM (SELECT CAST(x AS DOUBLE) AS x FROM {source}) q,
     (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM {source}) b GROUP BY 1"""


sql("eda6_recency_describe", _describe("elapsed"), elapsed=_ELAPSED)
sql("eda6_recency_histogram", _histogram("elapsed", 30), elapsed=_ELAPSED)
sql("eda6_trend_describe", _describe("trend"), trend="SELECT tendance_transactions AS x FROM int_trend")
sql("eda6_negative_trend", "SELECT count(*) FILTER (WHERE tendance_transactions < 0) AS clients_en_baisse FROM int_trend")
sql("eda6_dpd_histogram", _histogram("dpd", 20), dpd="SELECT days_past_due AS x FROM bank_loans")
sql("eda7_loan_status_crosstab", """
SELECT status, count(*) FILTER (WHERE status_corrige = 'Current') AS "Current",
  count(*) FILTER (WHERE status_corrige = 'Delinquent') AS "Delinquent",
  count(*) FILTER (WHERE status_corrige = 'Watchlist') AS "Watchlist" FROM stg_loans GROUP BY 1""")
sql("eda8_card_holding", """
SELECT count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM bank_cards)) AS avec_carte,
  count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM bank_cards)) AS sans_carte FROM bank_customers""")
sql("eda9_offer_conversion", """
SELECT offer_type, round(avg(CAST(accepted_flag AS INT)), 6) AS taux_conversion, count(*) AS nb_offres FROM bank_offers GROUP BY 1""")
_NUMBERS = """
SELECT c.customer_id, CAST(c.monthly_income_xof AS DECIMAL(25,2)) AS monthly_income_xof, coalesce(t.n, 0) AS nb_transactions,
  CAST(coalesce(t.v, 0) AS DECIMAL(25,2)) AS volume_total_xof, coalesce(a.n, 0) AS nb_comptes,
  CAST(coalesce(a.v, 0) AS DECIMAL(25,2)) AS solde_moyen_total, coalesce(k.n, 0) AS nb_reclamations
FROM bank_customers c
LEFT JOIN (SELECT customer_id, count(*) AS n, sum(amount_xof) AS v FROM bank_transactions GROUP BY 1) t ON t.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n, sum(avg_balance_90d_xof) AS v FROM bank_accounts GROUP BY 1) a
  ON a.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM bank_complaints GROUP BY 1) k ON k.customer_id = c.customer_id"""
_NAMES = ("monthly_income_xof", "nb_transactions", "volume_total_xof", "nb_comptes", "solde_moyen_total", "nb_reclamations")
sql("eda10_customer_numbers", "SELECT * FROM numbers", numbers=_NUMBERS)
sql("eda10_correlations", union([
    f"SELECT '{a}' AS colonne_a, '{b}' AS colonne_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation "
    f"FROM numbers" for i, a in enumerate(_NAMES) for b in _NAMES[i + 1:]]), numbers=_NUMBERS)


# Synthetic cohort --------------------------------------------------------------------------------
def hashed(seed: int, key: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}-' || {key}), 1, 15)) AS BIGINT)"


def _real(table: str) -> str:
    return f"SELECT {', '.join(COLUMNS[table])} FROM bank_{table}" + (
        "" if table in ("branches", "channels") else " WHERE NOT is_synthetic")


SYN = {f"real_{t}": _real(t) for t in COLUMNS}
SYN["indexed"] = f"""
SELECT customer_id, row_number() OVER (ORDER BY {hashed(0, "customer_id")}, customer_id) - 1 AS i FROM real_customers"""
SYN["draws"] = f"""
SELECT 'SYN-' || lpad(CAST(k AS VARCHAR), greatest(4, length(CAST(k AS VARCHAR)))::INT, '0') AS new_id, x.customer_id AS old_id
FROM (SELECT range AS k FROM range(1, 401)) d
JOIN indexed x ON x.i = {hashed(42, "CAST(k AS VARCHAR)")} % (SELECT count(*) FROM real_customers)"""


def _copy(table: str, key: str | None) -> str:
    columns = []
    for c in COLUMNS[table]:
        if c == "customer_id":
            columns.append("d.new_id AS customer_id")
        elif c == key:
            columns.append(f"d.new_id || '-' || s.{c} AS {c}")
        elif c == "account_id" and table in ("transactions", "cards"):
            columns.append("d.new_id || '-' || s.account_id AS account_id")
        else:
            columns.append(f"s.{c}")
    return ", ".join(columns)


sql("syn1_draw_customers", "SELECT new_id AS new_customer_id, old_id AS source_customer_id FROM draws", **SYN)
for _name, _table in {
    "syn1_copy_customers": "customers", "syn2_remap_accounts": "accounts", "syn4_remap_loans": "loans",
    "syn4_remap_interactions": "interactions", "syn4_remap_complaints": "complaints", "syn4_remap_offers": "offers",
}.items():
    sql(_name, f"SELECT {_copy(_table, None if _table == 'customers' else KEYS[_table])}, TRUE AS is_synthetic "
               f"FROM real_{_table} s JOIN draws d ON d.old_id = s.customer_id", **SYN)
for _table in ("transactions", "cards"):
    sql(f"syn3_remap_{_table}", f"""SELECT {_copy(_table, KEYS[_table])}, TRUE AS is_synthetic
FROM real_{_table} s JOIN real_accounts a ON a.account_id = s.account_id JOIN draws d ON d.old_id = a.customer_id""", **SYN)
sql("syn5_inject_churn", f"""
SELECT txn_id, customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM chosen) THEN txn_datetime - INTERVAL 180 DAY
  ELSE txn_datetime END AS txn_datetime FROM bank_transactions""", chosen=f"""
SELECT customer_id FROM (SELECT customer_id, row_number() OVER (ORDER BY {hashed(42, "customer_id")}, customer_id) AS r
  FROM bank_customers) q WHERE r <= greatest(1, floor((SELECT count(*) FROM bank_customers) * CAST(0.1 AS DOUBLE)))""")
sql("syn6_ks_income", """
SELECT CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, round(dist, 6) AS statistique,
  round(CASE WHEN sqrt(n_a * n_b / (n_a + n_b)) * dist < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
    (SELECT sum((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * n_a * n_b / (n_a + n_b) * dist * dist))
     FROM (SELECT range AS k FROM range(1, 101)) s))) END, 6) AS p_value
FROM (SELECT max(abs(fa - fb)) AS dist, CAST(max(na) AS DOUBLE) AS n_a, CAST(max(nb) AS DOUBLE) AS n_b FROM steps) q""", steps="""
SELECT sum(a) OVER w / CAST(sum(a) OVER () AS DOUBLE) AS fa, sum(b) OVER w / CAST(sum(b) OVER () AS DOUBLE) AS fb,
  sum(a) OVER () AS na, sum(b) OVER () AS nb
FROM (SELECT monthly_income_xof AS x, count(*) FILTER (WHERE NOT is_synthetic) AS a, count(*) FILTER (WHERE is_synthetic) AS b
      FROM bank_customers WHERE monthly_income_xof IS NOT NULL GROUP BY 1) v WINDOW w AS (ORDER BY x)""")
_LINKED = {"accounts": "customer_id", "loans": "customer_id", "interactions": "customer_id", "complaints": "customer_id",
           "offers": "customer_id"}
sql("syn7_cohort_rows", union(
    ["SELECT 'customers' AS table_name, count(*) AS lignes, 21 AS colonnes FROM draws"]
    + [f"SELECT '{t}', (SELECT count(*) FROM real_{t} s JOIN draws d ON d.old_id = s.{k}), {len(COLUMNS[t]) + 1}" for t, k in _LINKED.items()]
    + [f"SELECT '{t}', (SELECT count(*) FROM real_{t} s JOIN real_accounts a ON a.account_id = s.account_id "
       f"JOIN draws d ON d.old_id = a.customer_id), {len(COLUMNS[t]) + 1}" for t in ("transactions", "cards")]
    + [f"SELECT '{t}', (SELECT count(*) FROM bank_{t}), {len(COLUMNS[t]) + 1}" for t in ("branches", "channels")]), **SYN)

# Learning ----------------------------------------------------------------------------------------
_LABELLED = """
SELECT *, CASE WHEN crit >= 2 THEN 1 ELSE 0 END AS churn_flag FROM (
  SELECT *, (CASE WHEN recency_jours > 90 THEN 1 ELSE 0 END) + (CASE WHEN nb_reclamations_ouvertes > 0 THEN 1 ELSE 0 END)
    + (CASE WHEN tendance_transactions < 0 THEN 1 ELSE 0 END) + (CASE WHEN score_digital <= 1 THEN 1 ELSE 0 END) AS crit
  FROM c360) q"""
ML = {
    "labelled": _LABELLED,
    "ranked": f"""SELECT customer_id, churn_flag,
  row_number() OVER (PARTITION BY churn_flag ORDER BY {hashed(42, "customer_id")}, customer_id) AS r,
  count(*) OVER (PARTITION BY churn_flag) AS n FROM labelled""",
    "scored": """SELECT customer_id, segment, churn_flag, risque_composite AS s,
  risque_composite >= (SELECT quantile_cont(risque_composite, 0.5) FROM labelled) AS said FROM labelled""",
    "steps": """SELECT *, sum(p) OVER (ORDER BY s DESC) AS cp, sum(q) OVER (ORDER BY s DESC) AS cq, sum(p) OVER () AS np, sum(q) OVER () AS nq
FROM (SELECT s, count(*) FILTER (WHERE churn_flag = 1) AS p, count(*) FILTER (WHERE churn_flag = 0) AS q FROM scored GROUP BY s) x""",
    "points": """SELECT s AS seuil, CAST(cq AS DOUBLE) / nq AS fpr, CAST(cp AS DOUBLE) / np AS tpr, CAST(cp AS DOUBLE) / (cp + cq) AS precision
FROM steps""",
}
sql("ml1_label", "SELECT customer_id, churn_flag FROM labelled", **ML)
sql("ml1_label_observed", "SELECT customer_id, churn_flag FROM labelled WHERE NOT is_synthetic", **ML)
sql("ml1b_label_study", """
SELECT count(*) AS n, count(*) FILTER (WHERE recency_jours > 90) AS positifs_naif,
  count(*) FILTER (WHERE crit >= 1) AS positifs_1_criteres, count(*) FILTER (WHERE crit >= 2) AS positifs_2_criteres,
  count(*) FILTER (WHERE crit >= 3) AS positifs_3_criteres FROM labelled""", **ML)
_INPUTS = ("recency_jours", "tendance_transactions", "nb_reclamations_ouvertes", "nb_reclamations_total", "score_digital",
           "nb_comptes", "nb_cartes", "nb_produits_total", "monthly_income_xof")
sql("ml2_features", "SELECT customer_id, churn_flag, " + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in _INPUTS)
    + " FROM labelled", **ML)
sql("ml3_stratified_split", "SELECT customer_id, churn_flag, r <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test FROM ranked", **ML)
sql("ml11_stratified_folds", "SELECT customer_id, churn_flag, CAST((r - 1) % 5 AS INT) AS fold FROM ranked", **ML)


def _metrics(scored: str) -> str:
    return f"""
SELECT round((SELECT sum(q * (cp - p / 2.0)) / max(np * nq) FROM steps), 3) AS auc,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(pos, 0), 0), 3) AS recall,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(sd, 0), 0), 3) AS precision,
  round(coalesce(2.0 * tp / nullif(pos + sd, 0), 0), 3) AS f1, n AS n_test, pos AS n_positifs_test,
  CASE WHEN n < 200 OR pos < 20 THEN 'echantillon de test trop petit' END AS avertissement
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE churn_flag = 1) AS pos, count(*) FILTER (WHERE said) AS sd,
        count(*) FILTER (WHERE said AND churn_flag = 1) AS tp FROM {scored}) m"""


sql("ml8_rule_metrics", _metrics("scored"), **ML)
sql("ml9_roc_points", """
SELECT round(seuil, 6) AS seuil, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, round(precision, 6) AS precision FROM points""", **ML)
sql("ml9_best_threshold", """
SELECT round(seuil, 3) AS seuil_retenu, round(fpr, 6) AS fpr_seuil, round(tpr, 6) AS tpr_seuil,
  round(precision, 3) AS precision_seuil FROM points ORDER BY tpr - fpr DESC, seuil DESC LIMIT 1""", **ML)
sql("ml9_auc_by_segment", """
SELECT a.segment, round(sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0.0 END) / count(*), 6) AS auc
FROM scored a JOIN scored b ON a.segment = b.segment AND a.churn_flag = 1 AND b.churn_flag = 0 GROUP BY 1""", **ML)


def _psi(column: str) -> tuple[str, dict[str, str]]:
    edges = ", ".join(f"quantile_cont(CAST({column} AS DOUBLE), {i / 10})" for i in range(11))
    return """
SELECT round(CASE WHEN (SELECT len(e) FROM edges) < 3 THEN 0.0 ELSE coalesce(sum(
  (greatest(coalesce(c, 0) / nc, 1e-4) - greatest(coalesce(r, 0) / nr, 1e-4))
  * ln(greatest(coalesce(c, 0) / nc, 1e-4) / greatest(coalesce(r, 0) / nr, 1e-4))), 0.0) END, 4) AS psi
FROM (SELECT b, CAST(count(*) FILTER (WHERE NOT g) AS DOUBLE) AS r, CAST(count(*) FILTER (WHERE g) AS DOUBLE) AS c FROM binned GROUP BY b) x,
     (SELECT CAST(count(*) FILTER (WHERE NOT g) AS DOUBLE) AS nr, CAST(count(*) FILTER (WHERE g) AS DOUBLE) AS nc FROM binned) t""", {
        "edges": f"SELECT list_sort(list_distinct([{edges}])) AS e FROM c360 WHERE NOT is_synthetic",
        "binned": f"""SELECT is_synthetic AS g, (SELECT count(*) FROM (SELECT unnest(e[2:len(e)-1]) AS z FROM edges) y WHERE z < {column}) AS b
FROM c360""",
    }


for _name, _column in {"ml10_psi_risk": "risque_composite", "ml10_psi_few_edges": "nb_reclamations_total"}.items():
    _text, _extra = _psi(_column)
    sql(_name, _text, **_extra)
_OBSERVED = {
    **ML,
    "parts": """SELECT customer_id, churn_flag,
  coalesce(100.0 * (recency_jours - min(recency_jours) OVER ()) / nullif(max(recency_jours) OVER () - min(recency_jours) OVER (), 0), 50) * 0.4
  + coalesce(100.0 * (nb_reclamations_ouvertes - min(nb_reclamations_ouvertes) OVER ())
      / nullif(max(nb_reclamations_ouvertes) OVER () - min(nb_reclamations_ouvertes) OVER (), 0), 50) * 0.3
  + coalesce(100 - 100.0 * (score_digital - min(score_digital) OVER ()) / nullif(max(score_digital) OVER () - min(score_digital) OVER (), 0), 50) * 0.2
  + coalesce(100 - 100.0 * (tendance_transactions - min(tendance_transactions) OVER ())
      / nullif(max(tendance_transactions) OVER () - min(tendance_transactions) OVER (), 0), 50) * 0.1 AS raw
FROM labelled WHERE NOT is_synthetic""",
    "scored": """SELECT *, round(raw, 1) AS s, round(raw, 1) >= (SELECT quantile_cont(round(raw, 1), 0.5) FROM parts) AS said FROM parts""",
}
sql("ml12_rules_baseline", f"SELECT auc, recall, precision, f1 FROM ({_metrics('scored')}) z", **_OBSERVED)
