"""Exploration queries (the data behind the notebook charts).

They follow the notebook semantics: order lines of completed orders with a
LEFT lookup of product and category margin (default 0.48), money summed
exactly, and pandas-style rounding where the notebook rounds.
Exact quantiles are two rows of the customer table, found by their rank in a
distributed sort, never by collecting a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.money import sum_money_times_rate
from patronage.functions.rounding import round_half_up
from patronage.functions.rules import lookup_col
from patronage.operators.rank import checkpointed, number_rows, quantiles
from patronage.plans import scores
from patronage.plans.scores import np_round
from patronage.sources.tables import RAW_ORDER, Tables


def _completed_invoices(t: Tables) -> DataFrame:
    return t.completed_orders().select("invoice_no", "customer_id", "invoice_date")


def _month_start(col: str = "invoice_date") -> Column:
    return F.trunc(F.to_date(col), "month").cast("timestamp_ntz")


def monthly_net_revenue(t: Tables) -> DataFrame:
    """Q-10n: margin-adjusted revenue per month, AOV and month-over-month %."""
    if t.rollup is None:
        inv = scores.invoice_margin_totals(t, config.DEFAULT_MARGIN)
        monthly = (_completed_invoices(t).join(inv, "invoice_no")
                   .groupBy(_month_start().alias("order_date"))
                   .agg(F.sum("inv_margin").alias("net"),
                        F.count(F.lit(1)).alias("order_count"),
                        F.count_distinct("customer_id").alias("customers")))
    else:
        monthly = t.rollup.groups("all", ["year_month"]).select(
            F.to_date("year_month", "yyyy-MM").cast("timestamp_ntz").alias("order_date"), F.col("net_default").alias("net"),
            F.col("orders").alias("order_count"), "customers")
    # one row per month: bounded single-partition window
    prev = F.lag("net").over(Window.orderBy("order_date")).cast("double")
    net = F.col("net").cast("double")
    return monthly.select(
        "order_date", F.col("net").cast("decimal(24,6)").alias("net_revenue"), "order_count",
        "customers", np_round(net / F.col("order_count"), 2).alias("aov"),
        round_half_up(F.try_divide(net, F.nullif(prev, F.lit(0.0))) * 100 - 100, 6)
        .alias("mom_growth"))


def category_net_revenue_top9(t: Tables) -> DataFrame:
    """Q-11n: top 9 categories by margin-adjusted revenue (top-k report)."""
    lines = scores.line_margins(t, config.DEFAULT_MARGIN)
    per_invoice = (lines.where(F.col("category").isNotNull())
                   .groupBy("invoice_no", "category")
                   .agg(sum_money_times_rate("line_total", "gross_margin_pct").alias("net"),
                        F.sum("quantity").alias("qty")))
    agg = (per_invoice.join(_completed_invoices(t).select("invoice_no"), "invoice_no")
           .groupBy("category")
           .agg(F.sum("net").alias("net"), F.sum("qty").alias("units_sold"),
                F.count(F.lit(1)).alias("orders")))
    margin = t.margins().select("category", F.col("gross_margin_pct").alias("margin_pct"))
    top = agg.orderBy(F.col("net").desc(), "category").limit(9)
    return (top.join(margin, "category", "left")
            .select("category", F.col("net").cast("decimal(24,6)").alias("net_revenue"),
                    F.col("units_sold").cast("bigint").alias("units_sold"), "orders",
                    F.coalesce(F.col("margin_pct"),
                               F.lit(config.DEFAULT_MARGIN).cast("decimal(5,4)")).alias("margin_pct")))


def country_customers_top10(t: Tables) -> DataFrame:
    """Q-12n: top 10 countries by distinct customers with completed lines;
    pct = share of the top-10 total (as the notebook computes it)."""
    with_lines = t.order_items().select("invoice_no").distinct()
    if t.country_is_customer_attribute:
        buyers = (t.completed_orders().select("invoice_no", "customer_id")
                  .join(with_lines, "invoice_no", "left_semi").select("customer_id").distinct())
        pairs = buyers.join(t.customer_countries(), "customer_id").where(F.col("country").isNotNull())
    else:
        pairs = (t.completed_orders(with_country=True).select("invoice_no", "customer_id", "country")
                 .join(with_lines, "invoice_no", "left_semi")
                 .where(F.col("country").isNotNull())
                 .select("country", "customer_id").distinct())
    top = (pairs.groupBy("country").agg(F.count(F.lit(1)).alias("customer_count"))
           .orderBy(F.col("customer_count").desc(), "country").limit(10))
    # at most 10 rows: bounded single-partition window
    share = F.col("customer_count") / F.sum("customer_count").over(Window.partitionBy()) * 100
    return top.select("country", "customer_count", np_round(share, 1).alias("pct"))


def top_products(t: Tables) -> DataFrame:
    """Q-28: top 20 (product name, category) by margin-adjusted revenue. Lines
    are summed per invoice and product in 64 bits first, then in decimals, so a
    product's total can't overflow."""
    lines = scores.line_margins(t, config.DEFAULT_MARGIN, with_description=True).where(
        F.col("description").isNotNull() & F.col("category").isNotNull())
    per_invoice = lines.groupBy("invoice_no", F.col("description").alias("product_name"), "category").agg(
        sum_money_times_rate("line_total", "gross_margin_pct").alias("net"), F.sum("quantity").alias("units"))
    agg = (per_invoice.join(_completed_invoices(t).select("invoice_no"), "invoice_no", "left_semi")
           .groupBy("product_name", "category").agg(F.sum("net").alias("net"), F.sum("units").alias("units")))
    return (agg.orderBy(F.col("net").desc(), "product_name", "category").limit(20)
            .select("product_name", "category",
                    F.col("net").cast("decimal(24,6)").alias("net_revenue"),
                    F.col("units").cast("bigint").alias("units")))


def order_heatmap(t: Tables) -> DataFrame:
    """Q-29: distinct invoices by day-of-week (rows) x month name (columns).
    An invoice has one date, so distinct invoices per cell = invoices per cell
    at invoice grain. All seven days are rows and all twelve months columns,
    cells without orders are NULL."""
    with_lines = t.order_items().select("invoice_no").distinct()
    inv = _completed_invoices(t).join(with_lines, "invoice_no", "left_semi")
    cells = inv.select(F.date_format("invoice_date", "EEEE").alias("dow"),
                       F.date_format("invoice_date", "MMMM").alias("month"))
    counts = (cells.groupBy("dow").pivot("month", list(config.MONTH_NAMES)).agg(F.count(F.lit(1))))
    days = t.spark.createDataFrame([(d, i + 1) for i, d in enumerate(config.DAY_NAMES)], "dow string, dow_position int")
    return days.join(counts, "dow", "left").select("dow", "dow_position", *config.MONTH_NAMES)


def order_items_with_ids(t: Tables) -> DataFrame:
    """order_items with ``item_id``. A loaded star schema stores it; for the
    driver's lines consecutive ids in line-load order are given here."""
    items = t.order_items()
    if "item_id" in items.columns:
        return items
    return number_rows(t.order_items_in_order(), [F.col(f"_o{i}") for i in range(len(RAW_ORDER))], "item_id").select(
        "item_id", *items.columns)


def order_items_enriched(t: Tables) -> DataFrame:
    """Q-30: completed order lines with product, category and margin-adjusted
    values (the enriched fact export)."""
    items = order_items_with_ids(t)
    products = t.products().select("stock_code", F.col("description").alias("product_name"),
                                   "category")
    margins = t.margins().select("category", "gross_margin_pct")
    headers = t.completed_orders().select("invoice_no", "invoice_date", "customer_id",
                                          "order_status")
    lines = (items.join(headers, "invoice_no")
             .join(products, "stock_code", "left")
             .join(margins, "category", "left"))
    margin = F.coalesce(F.col("gross_margin_pct"), F.lit(config.DEFAULT_MARGIN).cast("decimal(5,4)"))
    net = (F.col("line_total") * margin).cast("decimal(20,6)")
    return lines.select(
        "item_id", F.col("invoice_no").alias("order_id"), "stock_code", "quantity", "unit_price",
        "line_total", F.col("invoice_date").alias("order_date"), "customer_id", "product_name",
        "category", "order_status", net.alias("net_line_total"), net.alias("line_profit"))


# ---------------------------------------------------------------------------
# customer-master statistics
# ---------------------------------------------------------------------------

def avg_clv_by_segment(t: Tables) -> DataFrame:
    """Q-31: mean 12-month CLV per RFM segment (notebook rules)."""
    m = scores.notebook_master(t, tiers=False)
    return m.groupBy("rfm_segment").agg(
        round_half_up(F.sum(F.col("clv_12m").cast("decimal(18,2)")).cast("double") / F.count("clv_12m"),
                      6).alias("avg_clv_12m"))


def clv_stats(t: Tables) -> DataFrame:
    """Q-32b: mean, median and 99th percentile of the 12-month CLV."""
    m = checkpointed(scores.notebook_base(t).select("customer_id", "clv_12m"))
    q = quantiles(m, "customer_id", {"clv_12m": [0.5, 0.99]})
    return m.agg(F.count(F.lit(1)).alias("customers"),
                 round_half_up(F.sum(F.col("clv_12m").cast("decimal(18,2)")).cast("double") / F.count("clv_12m"), 6)
                 .alias("mean_clv_12m"),
                 round_half_up(F.lit(q["clv_12m", 0.5]).cast("double"), 6).alias("median_clv_12m"),
                 round_half_up(F.lit(q["clv_12m", 0.99]).cast("double"), 6).alias("p99_clv_12m"))


N_BINS = 30


def clv_histogram(t: Tables) -> DataFrame:
    """Q-32: 30 equal-width bins of the 12-month CLV clipped at its 99th
    percentile, with numpy's bin assignment (last bin closed)."""
    # read twice (statistics, then binning): the customer table is materialised once
    m = checkpointed(scores.notebook_base(t).select("customer_id", "clv_12m"))
    p99 = F.lit(quantiles(m, "customer_id", {"clv_12m": [0.99]})["clv_12m", 0.99]).cast("double")
    stats = m.agg(F.min("clv_12m").alias("_min")).select(F.least(F.col("_min"), p99).alias("lo"), p99.alias("hi"))
    # degenerate range: numpy widens it by 0.5 on each side
    stats = stats.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                         F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    step = (F.col("hi") - F.col("lo")) / N_BINS

    def edge(i: Column) -> Column:
        return F.when(i >= N_BINS, F.col("hi")).otherwise(i * step + F.col("lo"))

    x = F.least(F.col("clv_12m"), F.col("hi"))
    f = F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * N_BINS)
    idx0 = F.when(f >= N_BINS, F.lit(N_BINS - 1)).otherwise(f)
    idx1 = F.when(x < edge(idx0), idx0 - 1).otherwise(idx0)
    idx2 = F.when((x >= edge(idx1 + 1)) & (idx1 != N_BINS - 1), idx1 + 1).otherwise(idx1)
    # one-row stats: broadcast, bounded at one row
    binned = (m.where(F.col("clv_12m").isNotNull()).crossJoin(F.broadcast(stats))
              .select((idx2 + 1).cast("int").alias("bin")))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("customers"))
    bins = (t.spark.range(1, N_BINS + 1).select(F.col("id").cast("int").alias("bin"))
            .crossJoin(F.broadcast(stats)))
    return (bins.join(counts, "bin", "left")
            .select("bin", round_half_up(edge(F.col("bin") - 1), 6).alias("bin_start"),
                    round_half_up(edge(F.col("bin")), 6).alias("bin_end"),
                    F.coalesce(F.col("customers"), F.lit(0)).alias("customers")))


def rfm_describe(t: Tables) -> DataFrame:
    """Q-33: ``describe()`` of recency, frequency and monetary: count, mean,
    sample std, min, quartiles, max; rounded to 2 places."""
    m = checkpointed(scores.notebook_base(t, with_clv=False))
    metrics, quartiles = ("recency_days", "frequency", "monetary"), (0.25, 0.5, 0.75)
    q = quantiles(m, "customer_id", {c: quartiles for c in metrics})
    aggs = []
    for c in metrics:
        v = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"{c}_count"),
                 (F.sum(F.col(c).cast("decimal(28,2)")).cast("double") / F.count(c)).alias(f"{c}_mean"),
                 F.stddev_samp(v).alias(f"{c}_std"), F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
    rows = F.array(*[F.struct(
        F.lit(c).alias("metric"), F.col(f"{c}_count").alias("count"),
        *[np_round(F.col(f"{c}_{x}"), 2).alias(x) for x in ("mean", "std", "min")],
        *[np_round(F.lit(q[c, p]).cast("double"), 2).alias(f"p{int(p * 100)}") for p in quartiles],
        np_round(F.col(f"{c}_max"), 2).alias("max")) for c in metrics])
    return m.agg(*aggs).select(F.inline(rows))


def rfm_clv_points(t: Tables) -> DataFrame:
    """Q-39: scatter data — recency vs monetary per customer, point size
    = max(clv_12m, 5) / 5 (NULL stays NULL)."""
    m = scores.notebook_master(t, tiers=False)
    clv = F.col("clv_12m")
    size = F.when(clv.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(clv, F.lit(5.0)) / 5)
    return m.select("customer_id", "recency_days", "monetary", "rfm_segment", "clv_12m",
                    round_half_up(size, 6).alias("point_size"))
