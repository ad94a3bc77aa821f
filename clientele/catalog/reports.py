"""Queries behind the report pages."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from clientele.catalog.core import Query
from clientele.functions.columns import round_doubles
from clientele.operators.reports import client, engagement, home, opportunities, portfolio, retention
from clientele.operators.reports.common import composition
from clientele.plans.clients import ClientPages
from clientele.plans.warehouse import Warehouse, warehouse

QUERIES: dict[str, Query] = {}


def over(name, digits=6):
    """Register a report; double columns are rounded for comparison."""

    def register(build):
        QUERIES[name] = lambda spark, source_dir: round_doubles(build(warehouse(spark, source_dir)), digits)
        return build

    return register


over("rpt1_home_kpis")(lambda w: home.home_kpis(w.customer_360))
over("rpt2_vip_alert")(lambda w: home.vip_alert(w.customer_360))
over("rpt2_vip_alert_cut45")(lambda w: home.vip_alert(w.customer_360, 45))
over("rpt3_opportunity_alert")(lambda w: home.opportunity_alert(w.customer_360))
over("rpt4_priority_actions")(lambda w: home.priority_actions(w.customer_360))
over("rpt5_composition_segment")(lambda w: composition(w.customer_360, "segment"))
over("rpt5_composition_risk_band")(lambda w: composition(w.customer_360, "risk_band"))
over("rpt6_portfolio_kpis")(lambda w: portfolio.portfolio_kpis_page(w.customer_360))
over("rpt6_portfolio_kpis_affluent")(lambda w: portfolio.portfolio_kpis_page(w.customer_360, "Affluent"))
over("rpt7_balance_at_risk")(lambda w: portfolio.balance_at_risk(w.customer_360))
over("rpt7b_value_engagement")(lambda w: portfolio.value_engagement(w.customer_360))
over("rpt8_segment_recap", 4)(lambda w: portfolio.segment_recap(w.customer_360))
over("rpt9_contribution_long")(lambda w: portfolio.contribution_long(portfolio.segment_recap(w.customer_360)))
over("rpt10_high_band_list")(lambda w: portfolio.high_band_list(w.customer_360))
over("rpt10_high_band_list_cut1")(lambda w: portfolio.high_band_list(w.customer_360, 1.0))
over("rpt11_engagement_kpis", 4)(lambda w: engagement.engagement_kpis(w.customer_360))
over("rpt12_latest_month_txn")(lambda w: engagement.latest_month_txn(w.monthly_transactions, w.as_of()))
over("rpt13_channel_rates")(
    lambda w: engagement.channel_rates(w.customer_360, w.activity, w.table("channels"))
)
over("rpt13_channel_adoption")(
    lambda w: engagement.channel_adoption(w.customer_360, w.activity, w.table("channels"))
)
over("rpt13_weakest_channel")(
    lambda w: engagement.weakest_channel(
        engagement.channel_adoption(w.customer_360, w.activity, w.table("channels"))
    )
)
over("rpt14_digital_by_segment")(lambda w: engagement.digital_by_segment(w.customer_360))
over("rpt15_monthly_volume", 4)(lambda w: engagement.monthly_volume(w.monthly_transactions, w.as_of()))
over("rpt15_monthly_trend", 4)(lambda w: engagement.monthly_trend(engagement.monthly_volume(w.monthly_transactions, w.as_of())))
over("rpt16_top_txn_types", 4)(lambda w: engagement.top_txn_types(w.table("transactions")))
over("rpt17_segment_profile")(lambda w: engagement.segment_profile(w.customer_360, w.table("interactions")))
over("rpt18_risk_zones")(lambda w: retention.risk_zones(w.customer_360))
over("rpt18_risk_zones_cut45")(lambda w: retention.risk_zones(w.customer_360, red=45, amber=20))
over("rpt18b_risk_histogram")(lambda w: retention.risk_histogram(w.customer_360))
over("rpt18c_open_complaints_by_category")(lambda w: retention.open_complaints_by_category(w.table("complaints")))
over("rpt18d_complaint_points")(lambda w: retention.complaint_points(w.customer_360, w.table("complaints")))
over("rpt18d_complaints_vs_risk")(
    lambda w: retention.complaints_vs_risk(retention.complaint_points(w.customer_360, w.table("complaints")))
)
over("rpt19_call_list", 4)(lambda w: opportunities.call_list(w.customer_360, w.offer_stats))
over("rpt19_call_list_filtered", 4)(
    lambda w: opportunities.call_list(w.customer_360, w.offer_stats, ["Premier", "Affluent"], "salary_upsell")
)
over("rpt19_call_list_totals", 2)(
    lambda w: opportunities.call_list_totals(opportunities.call_list(w.customer_360, w.offer_stats))
)
over("rpt20_offer_stats")(lambda w: opportunities.offer_stats(w.table("offers")))
over("rpt20_offer_summary")(lambda w: opportunities.offer_summary(w.offer_stats))
over("rpt21_cross_sell_potential", 2)(lambda w: opportunities.cross_sell_potential(w.customer_360, w.offer_stats))
over("rpt22_offer_matrix")(lambda w: opportunities.offer_matrix(w.offer_stats))
over("rpt23_offer_funnel")(lambda w: opportunities.offer_funnel(w.offer_stats))
over("rpt23_best_to_second")(lambda w: opportunities.best_to_second(w.offer_stats))
over("rpt24_search")(lambda w: client.search(w.customer_360, "nÂtion_7"))
over("rpt24_search_suggestions")(lambda w: client.search(w.customer_360))
over("rpt25_product_snapshot")(
    lambda w: client.product_snapshot(w.table("customers"), w.table("cards"), w.bronze("accounts"), w.table("loans"))
)
over("rpt26_monthly_activity")(lambda w: client.monthly_activity(w.table("transactions")))
over("rpt27_recent_txns")(lambda w: client.recent_txns(w.table("transactions"), w.table("channels")))
over("rpt28_recent_interactions")(lambda w: client.recent_interactions(w.table("interactions")))
over("rpt28_open_complaints")(lambda w: client.open_complaints(w.table("complaints")))
over("rpt29_advisor_action")(lambda w: client.advisor_action(w.customer_360))
over("rpt30_client_detail")(lambda w: client.client_detail(w.customer_360, w.nba, w.table("customers")))
over("rpt31_ai_zones")(lambda w: retention.ai_zones(w.customer_360))
over("rpt32_real_high_band")(lambda w: portfolio.real_high_band(w.customer_360))

# One client, from tables laid out by client.
ONE_CLIENT = "C00000007"
_pages: WeakKeyDictionary[Warehouse, ClientPages] = WeakKeyDictionary()


def _pages_of(w: Warehouse) -> ClientPages:
    if w not in _pages:
        _pages[w] = ClientPages(w)
    return _pages[w]


over("srv2_profile_clustered")(lambda w: _pages_of(w).profile(ONE_CLIENT))
over("rpt25_one_client_products")(lambda w: _pages_of(w).product_snapshot(ONE_CLIENT))
over("rpt26_one_client_activity")(lambda w: _pages_of(w).monthly_activity(ONE_CLIENT))
over("rpt27_one_client_txns")(lambda w: _pages_of(w).recent_txns(ONE_CLIENT))
over("rpt28_one_client_interactions")(lambda w: _pages_of(w).recent_interactions(ONE_CLIENT))
over("rpt28_one_client_complaints")(lambda w: _pages_of(w).open_complaints(ONE_CLIENT))
over("rpt29_one_client_action")(lambda w: _pages_of(w).advisor_action(ONE_CLIENT))
over("rpt30_one_client_detail")(lambda w: _pages_of(w).detail(ONE_CLIENT))
