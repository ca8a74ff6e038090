"""S-11: the analytical views as temporary views (definitions stay
DataFrame functions; Catalyst inlines them into each reading query)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from patronage.plans import serving
from patronage.plans.reports import ordered
from patronage.sources.tables import Tables

VIEWS = {
    "vw_customer_master": serving.customer_master,
    "vw_order_details": serving.order_details,
    "vw_monthly_kpi": serving.monthly_kpi,
    "vw_segment_kpi": serving.segment_kpi,
}


def register_views(t: Tables, names=None) -> dict[str, DataFrame]:
    """Register the star schema tables and the analytical views."""
    frames = {
        "orders": t.orders(with_country=True), "order_items": t.order_items(),
        "products": t.products(), "customers": t.customers(),
        "category_margin_assumptions": t.margins(),
    }
    for name in names or VIEWS:
        frames[name] = ordered(name.removeprefix("vw_"), VIEWS[name](t))
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
