"""Serving queries: score validations, BI summaries and the analytical views.

All aggregates over money sum exact decimals and convert to double once
(``avg`` = sum / count), so results do not depend on summation order.
Line-level facts are pre-aggregated to invoice grain before joining the
order header, which turns ``COUNT(DISTINCT invoice_no)`` into ``count(*)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.money import sum_money, sum_money_times_rate
from patronage.functions.rounding import round_half_up, round_money
from patronage.functions.rules import lookup_col
from patronage.plans import scores
from patronage.sources.tables import Tables


def _avg(col: str):
    """Average as exact sum / non-null count, in double."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


# ---------------------------------------------------------------------------
# score validations
# ---------------------------------------------------------------------------

def rfm_segment_validation(t: Tables) -> DataFrame:
    """Q-03: per RFM segment — customers, average R/F/M, revenue."""
    return scores.rfm_scores(t).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        round_half_up(_avg("recency_days"), 1).alias("avg_recency_days"),
        round_half_up(_avg("frequency"), 1).alias("avg_frequency"),
        round_half_up(_avg("monetary"), 2).alias("avg_monetary"),
        round_money(F.sum("monetary")).alias("total_revenue"))


def rfm_score_distribution(t: Tables) -> DataFrame:
    """Q-04: customers per score value for each of r/f/m (long form)."""
    rfm = scores.rfm_scores(t)
    long = rfm.select(F.expr(
        "stack(3, 'r_score', r_score, 'f_score', f_score, 'm_score', m_score) AS (score_type, score)"))
    return long.groupBy("score_type", "score").agg(F.count(F.lit(1)).alias("cnt"))


def clv_segment_validation(t: Tables) -> DataFrame:
    """Q-06: per CLV tier — customers and average value drivers."""
    return scores.clv_scores(t).groupBy("clv_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(_avg("avg_order_value"), 2).alias("avg_aov"),
        round_half_up(_avg("purchase_freq_monthly"), 4).alias("avg_freq_monthly"),
        round_half_up(_avg("gross_margin_pct") * 100, 1).alias("avg_margin_pct"),
        round_half_up(_avg("clv_12m"), 2).alias("avg_clv_12m"),
        round_half_up(_avg("clv_36m"), 2).alias("avg_clv_36m"),
        round_money(F.sum("clv_12m")).alias("total_projected_12m"))


def clv_overall(t: Tables) -> DataFrame:
    """Q-07: one row — customers, average/total/min/max 12-month CLV."""
    return scores.clv_values(t).agg(
        F.count(F.lit(1)).alias("total_customers"),
        round_half_up(_avg("clv_12m"), 2).alias("overall_avg_clv_12m"),
        round_money(F.sum("clv_12m")).alias("total_projected_12m"),
        round_money(F.min("clv_12m")).alias("min_clv_12m"),
        round_money(F.max("clv_12m")).alias("max_clv_12m"))


# ---------------------------------------------------------------------------
# BI summaries
# ---------------------------------------------------------------------------

def segment_matrix(t: Tables) -> DataFrame:
    """Q-09: RFM segment x CLV tier."""
    return scores.scored_customers(t).groupBy("rfm_segment", "clv_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        round_half_up(_avg("recency_days"), 1).alias("avg_recency_days"),
        round_half_up(_avg("frequency"), 1).alias("avg_orders"),
        round_half_up(_avg("monetary"), 2).alias("avg_historical_revenue"),
        round_half_up(_avg("avg_order_value"), 2).alias("avg_order_value"),
        round_half_up(_avg("clv_12m"), 2).alias("avg_clv_12m"),
        round_half_up(_avg("clv_36m"), 2).alias("avg_clv_36m"),
        round_money(F.sum("clv_12m")).alias("total_projected_12m"),
        round_half_up(_avg("gross_margin_pct") * 100, 1).alias("avg_margin_pct"))


def _month_of(col: str = "invoice_date"):
    return F.date_format(col, "yyyy-MM")


def monthly_revenue(t: Tables) -> DataFrame:
    """Q-10: gross revenue trend by month with month-over-month growth."""
    return _revenue_trend(_months_of_lines(t) if t.rollup is None else t.rollup.groups("all", ["year_month"]).select(
        "year_month", F.col("orders").alias("order_count"), F.col("customers").alias("unique_customers"), "gross", "price_sum", "lines"))


def _months_of_lines(t: Tables) -> DataFrame:
    inv = t.order_items().groupBy("invoice_no").agg(
        sum_money("line_total").alias("inv_total"), sum_money("unit_price").alias("price_sum"),
        F.count(F.lit(1)).alias("lines"))
    return (t.completed_orders().join(inv, "invoice_no")
            .groupBy(_month_of().alias("year_month"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.count_distinct("customer_id").alias("unique_customers"),
                 F.sum("inv_total").alias("gross"),
                 F.sum("price_sum").alias("price_sum"), F.sum("lines").alias("lines")))


def _revenue_trend(monthly: DataFrame) -> DataFrame:
    # one row per month: a single-partition window over a bounded input
    prev = F.lag("gross").over(Window.orderBy("year_month"))
    growth = F.try_divide((F.col("gross") - prev).cast("double"),
                          F.nullif(prev.cast("double"), F.lit(0.0))) * 100
    return monthly.select(
        "year_month", "order_count", "unique_customers",
        round_money(F.col("gross")).alias("gross_revenue"),
        round_half_up(F.col("price_sum").cast("double") / F.col("lines"), 2).alias("avg_unit_price"),
        round_half_up(F.col("gross").cast("double") / F.col("order_count"), 2).alias("avg_order_value"),
        round_half_up(growth, 2).alias("mom_growth_pct"))


def category_revenue(t: Tables) -> DataFrame:
    """Q-11: revenue by product category (completed orders, 4-way star)."""
    agg = _categories_of_lines(t) if t.rollup is None else (
        t.rollup.sums("category", ["category"]).join(t.margins().select("category", "gross_margin_pct"), "category")
        .withColumnsRenamed({"orders": "order_count", "units": "units_sold"}))
    return agg.select(
        "category", F.col("gross_margin_pct").alias("blended_margin_pct"), "order_count",
        F.col("units_sold").cast("bigint").alias("units_sold"),
        round_money(F.col("gross")).alias("gross_revenue"),
        round_money(F.col("gross") * F.col("gross_margin_pct")).alias("net_revenue"),
        round_half_up(F.col("price_sum").cast("double") / F.col("lines"), 2).alias("avg_unit_price"))


def _categories_of_lines(t: Tables) -> DataFrame:
    per_invoice = (scores.line_margins(t)
                   .groupBy("invoice_no", "category", "gross_margin_pct")
                   .agg(sum_money("line_total").alias("lt"), F.sum("quantity").alias("qty"),
                        sum_money("unit_price").alias("price_sum"), F.count(F.lit(1)).alias("lines")))
    done = t.completed_orders().select("invoice_no")
    return (per_invoice.join(done, "invoice_no")
            .groupBy("category", "gross_margin_pct")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum("qty").alias("units_sold"),
                 F.sum("lt").alias("gross"), F.sum("price_sum").alias("price_sum"),
                 F.sum("lines").alias("lines")))


def _country_revenue(t: Tables, line_grain: bool) -> DataFrame:
    """Per country: customers, share, gross revenue and CLV totals.

    One pass over the fact: per invoice the all-line totals (gross revenue,
    line count) and the product/margin-matched totals (CLV inputs); per
    customer the CLV value (no tiers needed) and the number of rows the
    source's line-grain LEFT JOIN would produce, so "line grain" is a
    weight, not a fan-out."""
    lines = scores.line_margins(t, default_margin=None, left=True)
    matched = F.col("gross_margin_pct").isNotNull()
    inv = lines.groupBy("invoice_no").agg(
        sum_money("line_total").alias("inv_total"), F.count(F.lit(1)).alias("lines"),
        sum_money(F.when(matched, F.col("line_total"))).alias("clv_total"),
        sum_money_times_rate("line_total", "gross_margin_pct").alias("clv_margin"),
        F.count_if(matched).alias("clv_lines"))
    per_order = t.completed_orders().select("invoice_no", "customer_id").join(inv, "invoice_no", "left")
    per_customer = per_order.groupBy("customer_id").agg(
        F.sum("inv_total").alias("gross"),
        F.sum(F.coalesce(F.col("lines"), F.lit(1))).alias("fan_rows"),
        F.count_if(F.col("clv_lines") > 0).alias("order_count"),
        F.sum("clv_total").alias("total_revenue"),
        F.sum("clv_margin").alias("margin_total"))
    clv = scores.clv_value(per_customer.crossJoin(F.broadcast(scores.dataset_span_months(t))))
    customers = t.customers().select("customer_id", "country")
    total = t.customers().agg(F.count(F.lit(1)).alias("_all"))
    joined = (customers.join(clv, "customer_id", "left")
              .withColumn("w", F.coalesce(F.col("fan_rows"), F.lit(1)) if line_grain else F.lit(1)))
    weighted = F.col("clv_12m") * F.col("w")
    agg = joined.groupBy("country").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("gross").alias("gross"),
        F.sum(weighted).alias("clv_sum"),
        F.sum(F.when(F.col("clv_12m").isNotNull(), F.col("w"))).alias("clv_rows"))
    return agg.crossJoin(F.broadcast(total)).select(
        "country", "total_customers",
        round_half_up(F.col("total_customers") / F.col("_all") * 100, 1).alias("customer_pct"),
        round_money(F.col("gross")).alias("gross_revenue"),
        round_half_up(F.try_divide(F.col("clv_sum").cast("double"), F.col("clv_rows")), 2)
        .alias("avg_clv_12m"),
        round_money(F.col("clv_sum")).alias("total_clv_12m"))


def _top15(df: DataFrame) -> DataFrame:
    # top-15 report (the limit is the feature)
    return df.orderBy(F.col("gross_revenue").desc_nulls_last(), "country").limit(15)


def country_revenue_line_grain(t: Tables) -> DataFrame:
    """Q-12: top 15 countries; CLV averaged/summed at line grain, as written
    in the source query (each customer's CLV counts once per joined line)."""
    return _top15(_country_revenue(t, line_grain=True))


def country_revenue(t: Tables) -> DataFrame:
    """Q-12b: top 15 countries; CLV counted once per customer."""
    return _top15(_country_revenue(t, line_grain=False))


def cohort_retention(t: Tables) -> DataFrame:
    """Q-13: cohort (first completed month) x order month -> active customers,
    cohort size, retention %, month number."""
    month = F.date_trunc("month", "invoice_date")
    # distinct (customer, month) pairs; partial aggregation spreads a heavy
    # customer over its months before the shuffle.
    pairs = t.completed_orders().select("customer_id", month.alias("m")).distinct()
    with_cohort = pairs.withColumn("c", F.min("m").over(Window.partitionBy("customer_id")))
    cells = with_cohort.groupBy("c", "m").agg(F.count(F.lit(1)).alias("active_customers"))
    sized = cells.withColumn("cohort_size", F.max("active_customers").over(Window.partitionBy("c")))
    months = (F.year("m") * 12 + F.month("m")) - (F.year("c") * 12 + F.month("c"))
    return sized.select(
        F.date_format("c", "yyyy-MM").alias("cohort_month"),
        F.date_format("m", "yyyy-MM").alias("order_month"),
        "active_customers", "cohort_size",
        round_half_up(F.col("active_customers") / F.col("cohort_size") * 100, 1)
        .alias("retention_rate_pct"),
        months.cast("int").alias("month_number"))


def _customer_scores(t: Tables) -> DataFrame:
    customers = t.customers().select("customer_id", "country", "first_purchase_date",
                                     "last_purchase_date")
    return customers.join(scores.scored_customers(t), "customer_id")


def top_customers_clv(t: Tables) -> DataFrame:
    """Q-14: top 20 customers by 12-month CLV (a top-k report)."""
    return (_customer_scores(t)
            .orderBy(F.col("clv_12m").desc_nulls_last(), "customer_id").limit(20)
            .select("customer_id", "country", "rfm_segment", "clv_segment",
                    F.col("frequency").alias("total_orders"),
                    round_money(F.col("monetary")).alias("total_revenue"),
                    round_money(F.col("avg_order_value")).alias("avg_order_value"),
                    round_money(F.col("clv_12m")).alias("projected_clv_12m"),
                    round_money(F.col("clv_36m")).alias("projected_clv_36m")))


def campaign_preview(t: Tables) -> DataFrame:
    """Q-15: recommended campaign and priority tier per customer (SQL preview)."""
    tier = lookup_col("clv_segment", config.PRIORITY_TIERS, config.PRIORITY_FALLBACK)
    return _customer_scores(t).select(
        "customer_id", "country", "rfm_segment", "clv_segment",
        round_money(F.col("clv_12m")).alias("projected_clv_12m"),
        lookup_col("rfm_segment", config.PREVIEW_CAMPAIGNS, config.PREVIEW_FALLBACK)
        .alias("recommended_campaign"),
        tier.cast("int").alias("priority_tier"))


def customer_master(t: Tables) -> DataFrame:
    """Q-16 (view ``vw_customer_master``): customer profile with RFM and CLV."""
    return _customer_scores(t).select(
        "customer_id", "country", "first_purchase_date", "last_purchase_date", "rfm_segment",
        "r_score", "f_score", "m_score", "rfm_score", "recency_days",
        F.col("frequency").alias("total_orders"),
        round_money(F.col("monetary")).alias("historical_revenue"),
        "clv_segment",
        round_money(F.col("avg_order_value")).alias("avg_order_value"),
        round_money(F.col("purchase_freq_monthly"), 12, 4).alias("monthly_purchase_freq"),
        round_money(F.col("gross_margin_pct") * 100, 6, 1).alias("gross_margin_pct"),
        round_money(F.col("churn_rate"), 5, 4).alias("churn_rate"),
        round_money(F.col("clv_12m")).alias("clv_12m"),
        round_money(F.col("clv_36m")).alias("clv_36m"))


def order_details(t: Tables) -> DataFrame:
    """Q-17 (view ``vw_order_details``): one row per order line with every
    dimension; scores joined LEFT on the order header first (header grain is
    smaller than line grain), so the line fact is shuffled once. Each score is
    NULL for customers without it."""
    segs = scores.rfm_clv(t).select("customer_id", "rfm_segment", "clv_segment")
    headers = t.orders(with_country=True).join(segs, "customer_id", "left")
    lines = scores.line_margins(t, with_description=True)
    ts = F.col("invoice_date")
    return headers.join(lines, "invoice_no").select(
        F.col("invoice_no").alias("order_id"),
        F.to_date(ts).alias("order_date"),
        F.date_format(ts, "yyyy-MM").alias("year_month"),
        F.year(ts).alias("order_year"), F.month(ts).alias("order_month"),
        F.dayofweek(ts).alias("day_of_week"),
        "customer_id", "country", "rfm_segment", "clv_segment", "stock_code",
        F.col("description").alias("product_name"),
        "category", "quantity", "unit_price",
        round_money(F.col("line_total")).alias("line_total"),
        round_money(F.col("line_total") * F.col("gross_margin_pct")).alias("line_profit"),
        "order_status")


def monthly_kpi(t: Tables) -> DataFrame:
    """Q-18 (view ``vw_monthly_kpi``): monthly gross and margin-adjusted revenue."""
    if t.rollup is None:
        inv = scores.invoice_margin_totals(t)
        monthly = (t.completed_orders().join(inv, "invoice_no")
                   .groupBy(_month_of().alias("year_month"))
                   .agg(F.count(F.lit(1)).alias("total_orders"),
                        F.count_distinct("customer_id").alias("unique_customers"),
                        F.sum("inv_total").alias("gross"), F.sum("inv_margin").alias("net")))
    else:
        monthly = t.rollup.groups("matched", ["year_month"]).withColumnsRenamed({"orders": "total_orders", "customers": "unique_customers"})
    return monthly.select(
        "year_month", "total_orders", "unique_customers",
        round_money(F.col("gross")).alias("gross_revenue"),
        round_money(F.col("net")).alias("net_revenue"),
        round_half_up(F.col("gross").cast("double") / F.col("total_orders"), 2).alias("avg_order_value"),
        round_money(F.col("net")).alias("total_profit"))


def segment_kpi(t: Tables) -> DataFrame:
    """Q-19 (view ``vw_segment_kpi``): KPIs per RFM segment x CLV tier, over
    the customer master view."""
    return customer_master(t).groupBy("rfm_segment", "clv_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        round_half_up(_avg("recency_days"), 0).alias("avg_recency_days"),
        round_half_up(_avg("total_orders"), 1).alias("avg_orders"),
        round_half_up(_avg("historical_revenue"), 2).alias("avg_revenue"),
        round_half_up(_avg("avg_order_value"), 2).alias("avg_aov"),
        round_half_up(_avg("clv_12m"), 2).alias("avg_clv_12m"),
        round_money(F.sum("clv_12m")).alias("total_projected_clv_12m"),
        round_half_up(_avg("gross_margin_pct"), 1).alias("avg_margin_pct"))
