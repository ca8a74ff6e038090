"""Row order of the named reports, and the CSV exports.

A DataFrame has no order until it is asked for one; :func:`ordered` gives a
report its display order (always ending in a unique key, so the order is
total). Only small reports are ordered; fact-sized outputs are not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.plans import campaign, cleaning, explore, scores
from patronage.sources.io import export_csv
from patronage.sources.tables import Tables

#: Sort columns per report; "-" is descending (NULL last).
REPORT_ORDER: dict[str, tuple[str, ...]] = {
    "rfm_segment_validation": ("-total_revenue", "rfm_segment"),
    "rfm_score_distribution": ("score_type", "score"),
    "clv_segment_validation": ("-avg_clv_12m", "clv_segment"),
    "segment_matrix": ("-avg_clv_12m", "rfm_segment", "clv_segment"),
    "monthly_revenue": ("year_month",),
    "category_revenue": ("-gross_revenue", "category"),
    "country_revenue_line_grain": ("-gross_revenue", "country"),
    "country_revenue": ("-gross_revenue", "country"),
    "cohort_retention": ("cohort_month", "month_number"),
    "top_customers_clv": ("-projected_clv_12m", "customer_id"),
    "monthly_kpi": ("year_month",),
    "segment_kpi": ("-avg_clv_12m", "rfm_segment", "clv_segment"),
    "cleaning_waterfall": ("step_no",),
    "category_distribution": ("-line_count", "category"),
    "monthly_net_revenue": ("order_date",),
    "category_net_revenue_top9": ("-net_revenue", "category"),
    "country_customers_top10": ("-customer_count", "country"),
    "top_products": ("-net_revenue", "product_name", "category"),
    "order_heatmap": ("dow_position",),
    "clv_histogram": ("bin",),
    "campaign_roi": ("-roi_pct", "rfm_segment", "campaign_name"),
    "campaign_cost_by_segment": ("-blanket_cost", "rfm_segment"),
    "segment_counts": ("kind", "position", "label"),
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """The report in its display order; as it is if it has none."""
    keys = [F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c) for c in REPORT_ORDER.get(name, ())]
    return df.orderBy(*keys) if keys else df


def _renamed(fn: Callable[[Tables], DataFrame], **names: str) -> Callable[[Tables], DataFrame]:
    return lambda t: fn(t).withColumnsRenamed(names)


#: File -> (report name for its order, builder, columns in file order).
EXPORTS: dict[str, tuple[str, Callable[[Tables], DataFrame], list[str]]] = {
    "processed/customers": ("", cleaning.customers_dim,
                            ["customer_id", "country", "first_purchase_date", "last_purchase_date", "is_active"]),
    "processed/products": ("", _renamed(cleaning.products_dim, avg_unit_price="unit_price"),
                           ["stock_code", "description", "category", "unit_price"]),
    "processed/orders": ("", _renamed(cleaning.orders_dim, invoice_date="order_date"),
                         ["invoice_no", "customer_id", "order_date", "country", "order_status"]),
    "processed/order_items": ("", cleaning.clean_lines, ["invoice_no", "stock_code", "quantity", "unit_price"]),
    "exports/monthly_revenue": ("monthly_net_revenue", explore.monthly_net_revenue,
                                ["order_date", "net_revenue", "order_count", "customers", "aov", "mom_growth"]),
    "exports/category_revenue": ("category_net_revenue_top9", explore.category_net_revenue_top9,
                                 ["category", "net_revenue", "units_sold", "orders", "margin_pct"]),
    "exports/country_acquisition": ("country_customers_top10", explore.country_customers_top10, ["country", "customer_count", "pct"]),
    "exports/top_products": ("top_products", explore.top_products, ["product_name", "category", "net_revenue", "units"]),
    "exports/order_items_enriched": ("", explore.order_items_enriched,
                                     ["item_id", "order_id", "stock_code", "quantity", "unit_price", "line_total", "order_date", "customer_id",
                                      "product_name", "category", "order_status", "net_line_total", "line_profit"]),
    "exports/rfm_scores": ("", scores.rfm_scores_notebook, scores.RFM_COLUMNS),
    "exports/clv_scores": ("", scores.clv_scores_notebook, scores.CLV_COLUMNS),
    "exports/customer_clv_master": ("", scores.customer_clv_master, scores.NOTEBOOK_MASTER_COLUMNS),
    "exports/campaign_roi": ("campaign_roi", campaign.campaign_roi,
                             ["rfm_segment", "campaign_name", "customers", "total_cost", "avg_clv", "total_expected", "roi_pct"]),
    "exports/campaign_targets": ("", campaign.campaign_targets, campaign.TARGET_COLUMNS),
}


def export_all(t: Tables, root: str, names=None) -> dict[str, str]:
    """S-07: write the CSV exports under ``root``; one folder each. Ordered
    reports are a few rows and one file, the others as many files as tasks."""
    paths = {}
    for name in names or EXPORTS:
        report, build, columns = EXPORTS[name]
        paths[name] = f"{root.rstrip('/')}/{name}.csv"
        export_csv(ordered(report, build(t)), paths[name], columns, single_file=bool(report))
    return paths


def report(t: Tables, name: str) -> DataFrame:
    """A registered report in its display order."""
    from patronage.plans.registry import QUERIES

    return ordered(name, QUERIES[name](t))
