"""Oracle SQL of the report queries."""

from __future__ import annotations

from clientele.oracle.base import with_bank
from clientele.oracle.core import CALL_COLUMNS, OFFERS

ORACLES: dict[str, str] = {}


_TEXTS: dict[str, str] = {}


def sql(name: str, text: str, **extra: str) -> None:
    _TEXTS[name] = text
    ORACLES[name] = with_bank(text, **extra)


_RISK_MEAN = "CAST(sum(CAST(risque_composite AS DECIMAL(5,1))) AS DOUBLE) / count(*)"
_ACTIVE = "100.0 * CAST(count(*) FILTER (WHERE recency_jours <= 30) AS DOUBLE) / count(*)"
_ACTIVE_STATUS = f"CASE WHEN {_ACTIVE} > 80 THEN 'success' WHEN {_ACTIVE} >= 60 THEN 'warning' ELSE 'danger' END"
_HIGH = "100.0 * CAST(count(*) FILTER (WHERE risk_band = 'High') AS DOUBLE) / count(*)"


def _money(column: str, condition: str = "TRUE") -> str:
    return f"CAST(coalesce(sum({column}) FILTER (WHERE {condition}), 0) AS DECIMAL(25,2))"


sql("rpt1_home_kpis", f"""
SELECT count(*) AS nb_clients, count(*) FILTER (WHERE recency_jours <= 30) AS nb_actifs,
  round({_ACTIVE}, 6) AS taux_actifs, {_money("solde_total_xof")} AS solde_total,
  CAST(sum(nb_reclamations_ouvertes) AS BIGINT) AS reclamations_ouvertes, round({_RISK_MEAN}, 6) AS risque_moyen,
  {_ACTIVE_STATUS} AS statut_actifs,
  CASE WHEN sum(nb_reclamations_ouvertes) > 5 THEN 'danger' WHEN sum(nb_reclamations_ouvertes) >= 3 THEN 'warning'
       ELSE 'success' END AS statut_reclamations,
  CASE WHEN {_RISK_MEAN} >= 70 THEN 'danger' WHEN {_RISK_MEAN} >= 40 THEN 'warning' ELSE 'success' END AS statut_risque
FROM c360""")
for _name, _cut in {"rpt2_vip_alert": 70, "rpt2_vip_alert_cut45": 45}.items():
    sql(_name, f"""SELECT count(*) AS nb_vip, {_money("solde_total_xof")} AS solde_vip
FROM c360 WHERE segment = 'Premier' AND risque_composite > {_cut}""")
sql("rpt3_opportunity_alert", f"""SELECT count(*) AS nb_opportunites, {_money("nbi_estime_xof")} AS nbi_opportunites
FROM c360 WHERE is_cross_sell_target OR is_salary_upsell_opportunity""")
sql("rpt4_priority_actions", """
SELECT 'sans_carte' AS action, count(*) FILTER (WHERE nb_cartes = 0) AS n FROM c360
UNION ALL SELECT 'risque_credit_eleve', count(*) FILTER (WHERE risk_band = 'High') FROM c360
UNION ALL SELECT 'reclamations_ouvertes', CAST(sum(nb_reclamations_ouvertes) AS BIGINT) FROM c360
UNION ALL SELECT 'forte_valeur_a_risque', count(*) FILTER (WHERE is_high_value_at_risk) FROM c360
UNION ALL SELECT 'reclamation_desengagement', count(*) FILTER (WHERE is_complaints_churn_risk) FROM c360""")
for _col in ("segment", "risk_band"):
    sql(f"rpt5_composition_{_col}", f"""
SELECT {_col}, count(*) AS nb_clients, {_col} || ' (' || count(*) || ')' AS libelle FROM c360 GROUP BY {_col}""")
for _name, _where in {"rpt6_portfolio_kpis": "", "rpt6_portfolio_kpis_affluent": "WHERE segment = 'Affluent'"}.items():
    sql(_name, f"""
SELECT count(*) AS nb_clients, count(*) FILTER (WHERE recency_jours <= 30) AS nb_actifs, round({_ACTIVE}, 6) AS taux_actifs,
  {_money("nbi_estime_xof")} AS nbi_total, {_money("solde_total_xof")} AS solde_total, round({_HIGH}, 6) AS taux_risque_eleve,
  {_ACTIVE_STATUS} AS statut_actifs,
  CASE WHEN {_HIGH} > 5 THEN 'danger' WHEN {_HIGH} >= 3 THEN 'warning' ELSE 'success' END AS statut_risque_eleve
FROM c360 {_where}""")
sql("rpt7_balance_at_risk", f"""
SELECT {_money("solde_total_xof", "recency_jours > 60 AND solde_total_xof > 5000000")} AS solde_a_risque,
  count(*) FILTER (WHERE risk_band = 'High') AS nb_risque_eleve,
  {_money("solde_total_xof", "risk_band = 'High'")} AS solde_risque_eleve FROM c360""")
sql("rpt7b_value_engagement", """
SELECT customer_id, segment, recency_jours, score_digital, round(CAST(solde_total_xof AS DOUBLE) / 1000000, 6) AS solde_m,
  nbi_estime_xof,
  CASE WHEN recency_jours > 60 AND solde_total_xof >= 5000000 THEN 'rouge'
       WHEN recency_jours > 30 AND solde_total_xof >= 1000000 THEN 'ambre' WHEN recency_jours <= 30 THEN 'vert' END AS zone_valeur,
  CASE WHEN recency_jours <= 30 THEN 'vert' WHEN recency_jours <= 60 THEN 'ambre' ELSE 'rouge' END AS zone_recence
FROM c360""")

_RECAP = f"""
SELECT segment, count(*) AS nb_clients, {_money("solde_total_xof")} AS solde_total,
  CAST(sum(solde_total_xof) AS DOUBLE) / count(*) AS solde_moyen,
  CAST(sum(monthly_income_xof) AS DOUBLE) / count(monthly_income_xof) AS revenu_moyen, {_ACTIVE} AS taux_actifs,
  CAST(sum(score_digital) AS DOUBLE) / count(*) AS score_digital_moyen,
  CAST(sum(nbi_estime_xof) AS DOUBLE) / count(*) AS nbi_estime, {_money("nbi_estime_xof")} AS nbi_total,
  {_RISK_MEAN} AS risque_composite_moyen
FROM c360 GROUP BY segment"""
_SHARES = """
SELECT *, 100.0 * nb_clients / sum(nb_clients) OVER () AS pct_clients,
  100.0 * CAST(solde_total AS DOUBLE) / CAST(sum(solde_total) OVER () AS DOUBLE) AS pct_solde FROM recap"""
sql("rpt8_segment_recap", """
SELECT segment, nb_clients, solde_total, round(solde_moyen, 4) AS solde_moyen, round(revenu_moyen, 4) AS revenu_moyen,
  round(taux_actifs, 4) AS taux_actifs, round(score_digital_moyen, 4) AS score_digital_moyen,
  round(nbi_estime, 4) AS nbi_estime, nbi_total, round(risque_composite_moyen, 4) AS risque_composite_moyen,
  CASE WHEN risque_composite_moyen > 40 THEN 'renforcer_suivi' WHEN taux_actifs < 70 THEN 'campagne_reactivation'
       ELSE 'maintenir_relation' END AS action_prioritaire,
  round(pct_clients, 4) AS pct_clients, round(pct_solde, 4) AS pct_solde
FROM shares""", recap=_RECAP, shares=_SHARES)
sql("rpt9_contribution_long", """
SELECT segment, 'pct_clients' AS metrique, round(pct_clients, 6) AS valeur FROM shares
UNION ALL SELECT segment, 'pct_solde', round(pct_solde, 6) FROM shares""", recap=_RECAP, shares=_SHARES)
for _name, _cut in {"rpt10_high_band_list": 5, "rpt10_high_band_list_cut1": 1}.items():
    sql(_name, f"""SELECT customer_id, full_name, segment, city, solde_total_xof, recency_jours FROM c360
WHERE risk_band = 'High' AND (SELECT {_HIGH} FROM c360) > {_cut}""")

_DIGITAL = ("100.0 * CAST(count(*) FILTER (WHERE mobile_app_active OR internet_banking_active OR mobile_money_linked) "
            "AS DOUBLE) / count(*)")
_DORMANT = "100.0 * CAST(count(*) FILTER (WHERE score_digital <= 1) AS DOUBLE) / count(*)"
sql("rpt11_engagement_kpis", f"""
SELECT round({_DIGITAL}, 4) AS taux_digital,
  round(CAST(sum(avg_balance_90d_xof) AS DOUBLE) / count(*), 4) AS solde_moyen_90j,
  count(*) FILTER (WHERE score_digital <= 1) AS nb_dormants, round({_DORMANT}, 4) AS part_dormants,
  CASE WHEN {_DIGITAL} > 80 THEN 'success' WHEN {_DIGITAL} >= 60 THEN 'warning' ELSE 'danger' END AS statut_digital,
  CASE WHEN {_DORMANT} > 30 THEN 'danger' WHEN {_DORMANT} > 15 THEN 'warning' ELSE 'success' END AS statut_dormants
FROM c360""")
sql("rpt12_latest_month_txn", """
SELECT CAST(date_trunc('month', max(d)) AS DATE) AS mois, count(*) AS nb_txn FROM stg_transactions, ref_date
WHERE date_trunc('month', txn_datetime) = date_trunc('month', d)""")
_RATES = """
SELECT c.segment, ch.channel_name,
  100.0 * CAST(count(DISTINCT c.customer_id) AS DOUBLE) / (SELECT count(*) FROM c360 x WHERE x.segment = c.segment) AS taux
FROM c360 c JOIN stg_transactions t ON t.customer_id = c.customer_id JOIN stg_channels ch ON ch.channel_id = t.channel_id
WHERE ch.channel_name IN ('Mobile App', 'Internet Banking', 'ATM', 'Agent / Mobile Money') GROUP BY 1, 2"""
sql("rpt13_channel_rates", "SELECT segment, channel_name, round(taux, 6) AS taux FROM rates", rates=_RATES)
sql("rpt13_channel_adoption", """
SELECT segment, round(max(taux) FILTER (WHERE channel_name = 'Mobile App'), 6) AS app_mobile,
  round(max(taux) FILTER (WHERE channel_name = 'Internet Banking'), 6) AS internet_banking,
  round(max(taux) FILTER (WHERE channel_name = 'ATM'), 6) AS agence_dab,
  round(max(taux) FILTER (WHERE channel_name = 'Agent / Mobile Money'), 6) AS mobile_money
FROM rates GROUP BY segment""", rates=_RATES)
sql("rpt13_weakest_channel", """
SELECT segment, CASE channel_name WHEN 'Mobile App' THEN 'app_mobile' WHEN 'Internet Banking' THEN 'internet_banking'
  WHEN 'ATM' THEN 'agence_dab' ELSE 'mobile_money' END AS canal, round(taux, 6) AS taux FROM rates
ORDER BY taux, CASE segment WHEN 'Mass' THEN 1 WHEN 'Affluent' THEN 2 WHEN 'Premier' THEN 3 ELSE 4 END,
  CASE channel_name WHEN 'Mobile App' THEN 1 WHEN 'Internet Banking' THEN 2 WHEN 'ATM' THEN 3 ELSE 4 END LIMIT 1""",
    rates=_RATES)
sql("rpt14_digital_by_segment", """
SELECT segment, round(CAST(sum(score_digital) AS DOUBLE) / count(*), 6) AS score_digital FROM c360 GROUP BY 1""")
_MONTHS = """
SELECT *, CAST(volume AS DOUBLE) / 1000000 AS volume_m, row_number() OVER (ORDER BY mois) - 1 AS i FROM (
  SELECT CAST(date_trunc('month', txn_datetime) AS DATE) AS mois, CAST(sum(amount_xof) AS DECIMAL(25,2)) AS volume
  FROM stg_transactions, ref_date WHERE txn_datetime >= d - INTERVAL 12 MONTH GROUP BY 1) m"""
sql("rpt15_monthly_volume", """
SELECT mois, volume, round(volume_m, 4) AS volume_m,
  round((SELECT regr_slope(volume_m, i) FROM months) * i + (SELECT regr_intercept(volume_m, i) FROM months), 4) AS tendance_m,
  mois = (SELECT mois FROM months ORDER BY volume_m, mois LIMIT 1) AS est_creux
FROM months""", months=_MONTHS)
sql("rpt15_monthly_trend", """
SELECT round(v, 4) AS variation_pct, CASE WHEN v > 5 THEN 'hausse' WHEN v < -5 THEN 'baisse' ELSE 'stable' END AS tendance
FROM (SELECT 100.0 * (arg_max(volume_m, mois) - arg_min(volume_m, mois)) / arg_min(volume_m, mois) AS v FROM months) q""",
    months=_MONTHS)
sql("rpt16_top_txn_types", """
SELECT txn_type, CAST(sum(amount_xof) AS DECIMAL(25,2)) AS volume,
  round(CAST(sum(amount_xof) AS DOUBLE) / count(*), 4) AS montant_moyen
FROM stg_transactions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")


def _scaled(x: str) -> str:
    return f"coalesce(100.0 * ({x} - min({x}) OVER ()) / nullif(max({x}) OVER () - min({x}) OVER (), 0), 50)"


sql("rpt17_segment_profile", f"""
SELECT p.segment, round({_scaled("p.a")}, 6) AS activite, round(p.dg / 3 * 100, 6) AS digital,
  round({_scaled("p.t")}, 6) AS fidelite, round({_scaled("p.v")}, 6) AS valeur, round(coalesce(s.rate, 50), 6) AS satisfaction
FROM (SELECT segment, CAST(sum(nb_txn_90j) AS DOUBLE) / count(*) AS a, CAST(sum(score_digital) AS DOUBLE) / count(*) AS dg,
        CAST(sum(anciennete_jours) AS DOUBLE) / count(*) AS t, CAST(sum(solde_total_xof) AS DOUBLE) / count(*) AS v
      FROM c360 GROUP BY 1) p
LEFT JOIN (SELECT c.segment, 100.0 * count(*) FILTER (WHERE sentiment = 'Positive') / nullif(count(*), 0) AS rate
      FROM stg_interactions i JOIN c360 c ON c.customer_id = i.customer_id
      WHERE sentiment IN ('Positive', 'Negative') GROUP BY 1) s ON s.segment = p.segment""")


def _zone(red: str, amber: int) -> str:
    return f"CASE WHEN risque_composite {red} THEN 'rouge' WHEN risque_composite >= {amber} THEN 'ambre' ELSE 'vert' END"


for _name, _red, _amber in (("rpt18_risk_zones", "> 70", 40), ("rpt18_risk_zones_cut45", "> 45", 20)):
    sql(_name, f"""SELECT {_zone(_red, _amber)} AS zone, count(*) AS nb_clients, {_money("solde_total_xof")} AS solde,
  count(*) FILTER (WHERE nb_reclamations_ouvertes > 0) AS nb_avec_reclamation FROM c360 GROUP BY 1""")
sql("rpt18b_risk_histogram", """
SELECT CAST(least(floor(risque_composite / (100.0 / 30)) + 1, 30) AS BIGINT) AS classe, count(*) AS nb_clients FROM c360 GROUP BY 1""")
sql("rpt18c_open_complaints_by_category", """
SELECT category, severity, count(*) AS n FROM stg_complaints WHERE status = 'Open' GROUP BY 1, 2""")
_POINTS = """
SELECT c.customer_id, c.segment, c.risque_composite, count(k.complaint_id) AS n_reclamations_ouvertes
FROM c360 c LEFT JOIN stg_complaints k ON k.customer_id = c.customer_id AND k.status = 'Open' GROUP BY 1, 2, 3"""
sql("rpt18d_complaint_points", "SELECT * FROM points", points=_POINTS)
sql("rpt18d_complaints_vs_risk", """
SELECT round(s, 6) AS pente, round(b, 6) AS ordonnee, round(s * lo + b, 6) AS y_debut, round(s * hi + b, 6) AS y_fin
FROM (SELECT regr_slope(risque_composite, n_reclamations_ouvertes) AS s,
  regr_intercept(risque_composite, n_reclamations_ouvertes) AS b,
  min(n_reclamations_ouvertes) AS lo, max(n_reclamations_ouvertes) AS hi FROM points) q""", points=_POINTS)
sql("rpt19_call_list", f"SELECT customer_id, {CALL_COLUMNS} FROM calls", **OFFERS)
sql("rpt19_call_list_filtered",
    f"SELECT customer_id, {CALL_COLUMNS} FROM calls WHERE u AND segment IN ('Premier', 'Affluent')", **OFFERS)
sql("rpt19_call_list_totals", """
SELECT count(*) AS nb_clients, round(CAST(sum(CAST(valeur_potentielle AS DECIMAL(25,6))) AS DOUBLE), 2) AS montant_total
FROM calls""", **OFFERS)
sql("rpt20_offer_stats", """
SELECT offer_type, n, round(taux, 6) AS taux_acceptation, round(valeur, 6) AS valeur_moyenne FROM offer_base""", **OFFERS)
sql("rpt20_offer_summary", """
SELECT round(avg(taux), 6) AS taux_moyen, (SELECT offer_type FROM offer_base ORDER BY taux DESC, offer_type DESC LIMIT 1)
  AS meilleure_offre, round(max(taux), 6) AS meilleur_taux FROM offer_base""", **OFFERS)
sql("rpt21_cross_sell_potential", """
SELECT x AS nb_cross_sell, u AS nb_upsell, round(x * card_value * card_rate + u * val * rate, 2) AS potentiel_total
FROM (SELECT count(*) FILTER (WHERE is_cross_sell_target) AS x, count(*) FILTER (WHERE is_salary_upsell_opportunity) AS u
      FROM c360) q, offer_marks""", **OFFERS)
sql("rpt22_offer_matrix", """
SELECT offer_type, n, round(100.0 * taux, 6) AS taux_pct, round(valeur / 1000000, 6) AS valeur_m,
  CASE WHEN taux >= (SELECT avg(taux) FROM offer_base) THEN
    CASE WHEN valeur >= (SELECT avg(valeur) FROM offer_base) THEN 'priorite_absolue' ELSE 'volume_facile' END
  ELSE CASE WHEN valeur >= (SELECT avg(valeur) FROM offer_base) THEN 'valeur_elevee' ELSE 'non_prioritaire' END END AS quadrant
FROM offer_base""", **OFFERS)
_TOP3 = "SELECT * FROM offer_base ORDER BY n DESC, offer_type LIMIT 3"
sql("rpt23_offer_funnel", """
SELECT offer_type, n AS nb_cibles, CAST(round(n * taux) AS BIGINT) AS nb_acceptes, round(taux, 6) AS taux_acceptation
FROM top3""", top3=_TOP3, **OFFERS)
sql("rpt23_best_to_second", """
SELECT offer_type AS meilleure, nxt AS seconde, round(taux / nxt_taux, 6) AS ratio
FROM (SELECT *, row_number() OVER w AS rn, lead(offer_type) OVER w AS nxt, lead(taux) OVER w AS nxt_taux FROM top3
      WINDOW w AS (ORDER BY taux DESC, offer_type DESC)) q WHERE rn = 1""", top3=_TOP3, **OFFERS)
_RESULT = "SELECT customer_id, full_name, segment, city, risque_composite FROM c360"
sql("rpt24_search", f"{_RESULT} WHERE " + " OR ".join(
    f"contains(strip_accents(lower({c})), strip_accents(lower('nÂtion_7')))" for c in ("customer_id", "full_name", "city", "segment")))
sql("rpt24_search_suggestions", f"{_RESULT} ORDER BY risque_composite DESC, customer_id LIMIT 10")


def _first(table: str, order: str, columns: str, where: str = "TRUE") -> str:
    return f"""(SELECT customer_id, {columns} FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {order}) AS rn
  FROM {table} WHERE {where}) z WHERE rn = 1)"""


sql("rpt25_product_snapshot", f"""
SELECT c.customer_id, k.card_tier AS carte_niveau, k.status AS carte_statut, a.account_type AS compte_type,
  a.current_balance_xof AS compte_solde, l.outstanding_balance_xof AS pret_encours, l.status_corrige AS pret_statut,
  s.current_balance_xof AS epargne_solde
FROM stg_customers c
LEFT JOIN {_first("stg_cards", "issue_date DESC NULLS LAST, card_id DESC", "card_tier, status")} k ON k.customer_id = c.customer_id
LEFT JOIN {_first("stg_accounts", "current_balance_xof DESC NULLS LAST, account_id DESC", "account_type, current_balance_xof")} a
  ON a.customer_id = c.customer_id
LEFT JOIN {_first("stg_loans", "origination_date DESC NULLS LAST, loan_id DESC", "outstanding_balance_xof, status_corrige")} l
  ON l.customer_id = c.customer_id
LEFT JOIN {_first("stg_accounts", "account_id DESC", "current_balance_xof", "account_type = 'Savings'")} s
  ON s.customer_id = c.customer_id""")
sql("rpt26_monthly_activity", """
SELECT customer_id, mois, nb_txn,
  first_value(nb_txn) OVER (PARTITION BY customer_id ORDER BY mois DESC)
    >= first_value(nb_txn) OVER (PARTITION BY customer_id ORDER BY mois) AS en_hausse
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY mois DESC) AS rn FROM (
  SELECT customer_id, CAST(date_trunc('month', txn_datetime) AS DATE) AS mois, count(*) AS nb_txn FROM stg_transactions
  GROUP BY 1, 2) m) r WHERE rn <= 6""")
sql("rpt27_recent_txns", """
SELECT t.customer_id, t.rang, t.txn_id, t.txn_datetime, t.txn_type, t.amount_xof, ch.channel_name
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY txn_datetime DESC, txn_id DESC) AS rang
      FROM stg_transactions) t LEFT JOIN stg_channels ch ON ch.channel_id = t.channel_id WHERE t.rang <= 5""")
sql("rpt28_recent_interactions", """
SELECT customer_id, interaction_id, interaction_datetime, interaction_type, sentiment, rang
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY interaction_datetime DESC, interaction_id DESC) AS rang
      FROM stg_interactions) t WHERE rang <= 5""")
sql("rpt28_open_complaints", """
SELECT customer_id, complaint_id, category, severity, opened_date, status FROM stg_complaints WHERE status = 'Open'""")
sql("rpt29_advisor_action", """
SELECT customer_id, risque_composite, CASE WHEN risque_composite >= 70 THEN 'appel_urgent'
  WHEN risque_composite >= 40 THEN 'offre_fidelisation' WHEN nb_cartes = 0 THEN 'offre_carte'
  WHEN NOT salaire_domicilie THEN 'offre_domiciliation_salaire' ELSE 'offre_epargne' END AS action_conseiller FROM c360""")
sql("rpt30_client_detail", """
SELECT c.*, n.next_best_action, s.occupation FROM c360 c LEFT JOIN nba n ON n.customer_id = c.customer_id
LEFT JOIN stg_customers s ON s.customer_id = c.customer_id""")
sql("rpt31_ai_zones", f"""
SELECT {_zone(">= 70", 40)} AS zone, count(*) AS nb_clients, {_money("solde_total_xof")} AS solde,
  {_money("nbi_estime_xof")} AS nbi, count(*) FILTER (WHERE is_synthetic) AS nb_synthetiques,
  round(100.0 * CAST(count(*) FILTER (WHERE is_synthetic) AS DOUBLE) / count(*), 6) AS part_synthetique_pct
FROM c360 GROUP BY 1""")
sql("rpt32_real_high_band", """
SELECT customer_id, full_name, segment, solde_total_xof, risque_composite, count(*) OVER () AS nb_clients,
  CAST(sum(solde_total_xof) OVER () AS DECIMAL(25,2)) AS solde_cumule
FROM c360 WHERE NOT is_synthetic AND segment = 'Premier' AND risk_band = 'High'""")

for _one, _all in {
    "rpt25_one_client_products": "rpt25_product_snapshot", "rpt26_one_client_activity": "rpt26_monthly_activity",
    "rpt27_one_client_txns": "rpt27_recent_txns", "rpt28_one_client_interactions": "rpt28_recent_interactions",
    "rpt28_one_client_complaints": "rpt28_open_complaints", "rpt29_one_client_action": "rpt29_advisor_action",
    "rpt30_one_client_detail": "rpt30_client_detail",
}.items():
    sql(_one, f"SELECT * FROM ({_TEXTS[_all]}) one WHERE customer_id = 'C00000007'")
sql("srv2_profile_clustered", """
SELECT c.*, n.next_best_action FROM c360 c LEFT JOIN nba n ON n.customer_id = c.customer_id
WHERE c.customer_id = 'C00000007'""")
