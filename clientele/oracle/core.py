"""Oracle SQL of sources, staging, features, marts, scores, serving and semantic queries."""

from __future__ import annotations

from clientele.oracle.base import with_bank
from clientele.sources.schemas import COLUMNS, TABLES

ORACLES: dict[str, str] = {}


def sql(name: str, text: str, **extra: str) -> None:
    ORACLES[name] = with_bank(text, **extra)


for _t in TABLES:
    sql(f"stg_{_t}", f"SELECT * FROM stg_{_t}")

sql("src1_table_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM bank_{t}" for t in TABLES))
sql("src3_tag_real", """
SELECT is_synthetic, count(*) AS n FROM (
  SELECT FALSE AS is_synthetic FROM bank_channels UNION ALL SELECT is_synthetic FROM bank_customers) u GROUP BY 1""")

_EXPORT = """SELECT c.customer_id, c.full_name, c.segment, c.risque_composite, c.recency_jours, c.nb_reclamations_ouvertes,
  c.solde_total_xof, n.next_best_action FROM c360 c LEFT JOIN nba n ON n.customer_id = c.customer_id WHERE """
sql("src7_red_zone_list", _EXPORT + "c.risque_composite > 70")
sql("src7_red_zone_list_cut45", _EXPORT + "c.risque_composite > 45")
sql("src7_amber_zone_list", _EXPORT + "c.risque_composite >= 40 AND c.risque_composite <= 70")
sql("src7_open_complaint_list", _EXPORT + "c.nb_reclamations_ouvertes > 0")

OFFER_STATS = """
SELECT offer_type, count(*) AS n, CAST(sum(CASE WHEN accepted_flag THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS taux,
       CAST(sum(expected_value_xof) AS DOUBLE) / count(*) AS valeur
FROM stg_offers GROUP BY offer_type"""
OFFER_MARKS = """
SELECT avg(taux) AS rate, avg(valeur) AS val,
  coalesce(max(taux) FILTER (WHERE offer_type = 'Card upgrade'), avg(taux)) AS card_rate,
  coalesce(max(valeur) FILTER (WHERE offer_type = 'Card upgrade'), 0.0) AS card_value
FROM offer_base"""
CALL_LIST = """
SELECT customer_id, full_name, segment, is_cross_sell_target AS x, is_salary_upsell_opportunity AS u,
  CASE WHEN is_cross_sell_target THEN 'Card upgrade' ELSE 'Domiciliation de salaire' END AS offre_recommandee,
  100.0 * CASE WHEN is_cross_sell_target THEN card_rate ELSE rate END AS probabilite,
  CASE WHEN is_cross_sell_target THEN card_value ELSE CAST(monthly_income_xof AS DOUBLE) * 0.02 END AS valeur_potentielle,
  salaire_domicilie, preferred_channel
FROM c360, offer_marks WHERE is_cross_sell_target OR is_salary_upsell_opportunity"""
OFFERS = {"offer_base": OFFER_STATS, "offer_marks": OFFER_MARKS, "calls": CALL_LIST}
CALL_COLUMNS = """full_name, segment, offre_recommandee, round(probabilite, 4) AS probabilite,
  round(valeur_potentielle, 4) AS valeur_potentielle, salaire_domicilie, preferred_channel,
  CASE WHEN probabilite > 80 THEN 'haute' WHEN probabilite >= 60 THEN 'moyenne' ELSE 'basse' END AS bande_probabilite"""
sql("src8_call_list_export", f"SELECT {CALL_COLUMNS} FROM calls", **OFFERS)

for _name, _cte in {
    "int1_recency": "int_recency", "int2_txn_trend": "int_trend", "int3_complaint_counts": "int_complaints",
    "int4_digital_score": "int_digital", "int5_product_counts": "int_products", "int6_balances": "int_balance",
    "int7_nbi": "int_nbi", "int8_majority_channel": "int_channel", "int9_max_dpd": "int_loans",
    "mrt5_customer_360": "c360", "mrt6_customer_segments": "segments", "mrt7_next_best_action": "nba",
}.items():
    sql(_name, f"SELECT * FROM {_cte}")

_FLAGS = """is_high_value_at_risk, is_digitally_dormant_salary, is_complaints_churn_risk, is_cross_sell_target,
  is_salary_upsell_opportunity"""
sql("mrt1_customer_features", f"""
SELECT * EXCLUDE (risque_composite, {_FLAGS}) FROM c360""")
sql("mrt2_minmax_signals", "SELECT customer_id, s_recency, s_reclamations, s_digital, s_tendance FROM c360_parts")
sql("mrt3_composite_risk", "SELECT customer_id, risque_composite FROM c360")
sql("mrt4_opportunity_flags", f"SELECT customer_id, {_FLAGS} FROM c360")
sql("scr1_rule_score", "SELECT customer_id, risque_composite AS score_regles FROM c360")
sql("scr2_risk_contributions", """
SELECT customer_id, round(s_recency * 0.4, 1) AS recency, round(s_reclamations * 0.3, 1) AS reclamations,
  round(s_digital * 0.2, 1) AS digital, round(s_tendance * 0.1, 1) AS tendance FROM c360_parts""")
sql("scr3_engagement_score", """
SELECT customer_id, round(
    coalesce(100.0 - 100.0 * (rec - min(rec) OVER ()) / nullif(max(rec) OVER () - min(rec) OVER (), 0), 50) * 0.3
  + coalesce(100.0 * (act - min(act) OVER ()) / nullif(max(act) OVER () - min(act) OVER (), 0), 50) * 0.25
  + coalesce(100.0 * (dig - min(dig) OVER ()) / nullif(max(dig) OVER () - min(dig) OVER (), 0), 50) * 0.25
  + coalesce(100.0 * (acc - min(acc) OVER ()) / nullif(max(acc) OVER () - min(acc) OVER (), 0), 50) * 0.2, 1)
  AS score_engagement
FROM eng""", eng_raw="""
SELECT c.customer_id, date_sub('day', t.last_txn, r.d) AS elapsed, coalesce(t.n, 0) + coalesce(i.n, 0) AS act,
       g.score_digital AS dig, coalesce(a.n, 0) AS acc
FROM stg_customers c CROSS JOIN ref_date r JOIN int_digital g ON g.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, max(txn_datetime) AS last_txn, count(*) AS n FROM stg_transactions GROUP BY 1) t
  ON t.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM stg_interactions GROUP BY 1) i ON i.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM stg_accounts GROUP BY 1) a ON a.customer_id = c.customer_id""",
    eng="SELECT *, coalesce(elapsed, max(elapsed) OVER ()) AS rec FROM eng_raw")
sql("scr4_nbi_enrichment", "SELECT customer_id, nbi_estime_xof, TRUE AS estimated_nbi_flag FROM int_nbi")
sql("scr5_risk_level", """
SELECT customer_id, CASE WHEN risque_composite >= 70 THEN 'high' WHEN risque_composite >= 40 THEN 'moderate' ELSE 'low' END
  AS niveau FROM c360""")
sql("sem1_time_spine_activity", """
SELECT s.date_day, d.nb_txn
FROM (SELECT CAST(unnest(generate_series(CAST(min(txn_datetime) AS DATE), CAST(max(txn_datetime) AS DATE), INTERVAL 1 DAY)) AS DATE)
        AS date_day FROM stg_transactions) s
LEFT JOIN (SELECT CAST(txn_datetime AS DATE) AS date_day, count(*) AS nb_txn FROM stg_transactions GROUP BY 1) d
  ON d.date_day = s.date_day""")
_METRICS = """CAST(sum(CAST(risque_composite AS DECIMAL(5,1))) AS DOUBLE) / count(*) AS risque_composite_moyen,
  CAST(sum(score_digital) AS DOUBLE) / count(*) AS engagement_digital_moyen, count(customer_id) AS nombre_clients"""
sql("sem2_metrics_total", f"SELECT {_METRICS} FROM c360")
sql("sem2_metrics_by_segment_band", f"SELECT segment, risk_band, {_METRICS} FROM c360 GROUP BY 1, 2")
sql("sem2_metrics_by_flags", f"SELECT {_FLAGS}, {_METRICS} FROM c360 GROUP BY ALL")
sql("sem2_metrics_by_day", f"SELECT segment, CAST(d AS DATE) AS date_day, {_METRICS} FROM c360, ref_date GROUP BY 1, 2")

_RISK = "SELECT customer_id, full_name, segment, city, risque_composite, recency_jours, nb_reclamations_ouvertes FROM c360"
sql("srv1_at_risk", f"{_RISK} ORDER BY risque_composite DESC, customer_id LIMIT 10")
sql("srv1_at_risk_premier", f"{_RISK} WHERE segment = 'Premier' ORDER BY risque_composite DESC, customer_id LIMIT 25")
sql("srv2_profile", """
SELECT c.*, n.next_best_action FROM c360 c LEFT JOIN nba n ON n.customer_id = c.customer_id
WHERE c.customer_id = 'C00000007'""")
_CAND = "SELECT DISTINCT c.customer_id, c.full_name, c.segment, c.city, c.monthly_income_xof FROM c360 c"
_TARGET = "(c.is_cross_sell_target OR c.is_salary_upsell_opportunity)"
sql("srv3_cross_sell", f"{_CAND} WHERE {_TARGET} ORDER BY c.customer_id LIMIT 10")
sql("srv3_cross_sell_by_offer", f"""{_CAND} JOIN stg_offers o ON o.customer_id = c.customer_id
WHERE {_TARGET} AND o.offer_type = 'Travel card' ORDER BY c.customer_id LIMIT 20""")
sql("srv4_portfolio_kpis", """
SELECT count(*) AS nb_clients,
  round(CAST(sum(CAST(risque_composite AS DECIMAL(5,1))) AS DOUBLE) / count(*), 1) AS risque_composite_moyen,
  count(*) FILTER (WHERE is_high_value_at_risk) AS nb_high_value_at_risk,
  count(*) FILTER (WHERE is_cross_sell_target) AS nb_cross_sell_target,
  round(100.0 * count(*) FILTER (WHERE salaire_domicilie) / count(*), 1) AS taux_salaire_domicilie_pct FROM c360""")
sql("srv4_portfolio_kpis_segment", "SELECT * FROM segments WHERE segment = 'Premier'")
for _name, _where in {"srv5_complaint_analysis": "", "srv5_complaint_analysis_category": "WHERE category = 'Card'"}.items():
    sql(_name, f"""
SELECT severity, status, count(*) AS nb_reclamations, FALSE AS is_total FROM stg_complaints {_where} GROUP BY 1, 2
UNION ALL SELECT NULL, NULL, count(*), TRUE FROM stg_complaints {_where}""")
sql("srv6_free_sql", """
SELECT c.segment, count(*) AS nb_prets, max(l.days_past_due) AS retard_max
FROM c360 c JOIN stg_loans l ON l.customer_id = c.customer_id WHERE l.status_corrige = 'Delinquent' GROUP BY 1""")

sql("src2_bronze_twins", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, is_synthetic, count(*) AS n FROM bank_{t} GROUP BY is_synthetic"
    for t in TABLES if t not in ("branches", "channels")))
sql("src5_gold_rows", """
SELECT 'customer_360' AS table_name, count(*) AS n FROM c360 UNION ALL SELECT 'nba', count(*) FROM nba
UNION ALL SELECT 'customer_segments', count(*) FROM segments""")
sql("src7_export_csv", _EXPORT + "c.risque_composite >= 40 AND c.risque_composite <= 70")
sql("src1_load_sources", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS lignes, {len(c)} AS colonnes FROM bank_{t}"
    + ("" if t in ("branches", "channels") else " WHERE NOT is_synthetic") for t, c in COLUMNS.items()))
_, _rest = ORACLES["scr3_engagement_score"].split("WITH ", 1)
_ctes, _select = _rest.rsplit("\nSELECT customer_id, round(", 1)
ORACLES["src4_enriched_export"] = (
    f"SELECT e.customer_id, e.score_engagement, n.nbi_estime_xof, n.estimated_nbi_flag FROM (WITH {_ctes}\n"
    f"SELECT customer_id, round({_select}) e JOIN ({ORACLES['scr4_nbi_enrichment']}) n ON n.customer_id = e.customer_id")
