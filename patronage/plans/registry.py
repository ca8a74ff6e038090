"""Named queries: ``name -> fn(Tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from patronage.plans import campaign, cleaning, explore, rollup, scores, serving
from patronage.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "snapshot_date": scores.snapshot_date,
    "rfm_scores": scores.rfm_scores,
    "rfm_scores_notebook": scores.rfm_scores_notebook,
    "clv_scores": scores.clv_scores,
    "clv_scores_notebook": scores.clv_scores_notebook,
    "dataset_span_months": scores.dataset_span_months,
    "rfm_segment_validation": serving.rfm_segment_validation,
    "rfm_score_distribution": serving.rfm_score_distribution,
    "clv_segment_validation": serving.clv_segment_validation,
    "clv_overall": serving.clv_overall,
    "segment_matrix": serving.segment_matrix,
    "monthly_revenue": serving.monthly_revenue,
    "category_revenue": serving.category_revenue,
    "country_revenue_line_grain": serving.country_revenue_line_grain,
    "country_revenue": serving.country_revenue,
    "cohort_retention": serving.cohort_retention,
    "top_customers_clv": serving.top_customers_clv,
    "campaign_preview": serving.campaign_preview,
    "customer_master": serving.customer_master,
    "order_details": serving.order_details,
    "monthly_kpi": serving.monthly_kpi,
    "segment_kpi": serving.segment_kpi,
    "quality_audit": cleaning.quality_audit,
    "cleaning_waterfall": cleaning.cleaning_waterfall,
    "clean_lines": cleaning.clean_lines,
    "category_distribution": cleaning.category_distribution,
    "customers_dim": cleaning.customers_dim,
    "products_dim": cleaning.products_dim,
    "orders_dim": cleaning.orders_dim,
    "order_items": cleaning.order_items_clean,
    "table_counts": cleaning.table_counts,
    "staging_counts": cleaning.staging_counts,
    "constraint_violations": cleaning.constraint_violations,
    "raw_staging": cleaning.raw_staging,
    "monthly_net_revenue": explore.monthly_net_revenue,
    "category_net_revenue_top9": explore.category_net_revenue_top9,
    "country_customers_top10": explore.country_customers_top10,
    "top_products": explore.top_products,
    "order_heatmap": explore.order_heatmap,
    "order_items_enriched": explore.order_items_enriched,
    "avg_clv_by_segment": explore.avg_clv_by_segment,
    "clv_histogram": explore.clv_histogram,
    "clv_stats": explore.clv_stats,
    "rfm_describe": explore.rfm_describe,
    "rfm_clv_points": explore.rfm_clv_points,
    "campaign_targets": campaign.campaign_targets,
    "campaign_roi": campaign.campaign_roi,
    "cac_reduction": campaign.cac_reduction,
    "campaign_cost_by_segment": campaign.campaign_cost_by_segment,
    "segment_counts": campaign.segment_counts,
    "analysis_footer": campaign.analysis_footer,
    "score_upsert": scores.score_upsert,
    "customer_reach": rollup.customer_reach,
    "customer_clv_master": scores.customer_clv_master,
}
