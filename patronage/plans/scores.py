"""Customer scoring: RFM quintiles and CLV, under both reference rule sets.

Plan shape (both rule sets):

* order_items are pre-aggregated to invoice grain first (partial aggregation
  map-side, one shuffle on invoice_no), so the join with the order header is
  invoice x invoice and "COUNT(DISTINCT invoice_no)" becomes ``count(*)``;
* the join with completed orders is a sort-merge join on invoice_no (the
  aggregated side is already hash-partitioned on it);
* one shuffle on customer_id builds the customer base;
* tile scores use :func:`patronage.operators.rank.add_tiles`: the rows at the
  tile borders are found in a distributed sort of (metric, customer_id) and
  each customer is compared with them (exact, no single-partition sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.money import sum_money, sum_money_times_rate
from patronage.functions.rounding import round_half_up, round_money
from patronage.functions.rules import segment_col
from patronage.operators.rank import Metric, add_tiles, checkpointed, qcut_border
from patronage.sources.tables import Tables

RFM_COLUMNS = ["customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score",
               "m_score", "rfm_score", "rfm_segment"]
CLV_COLUMNS = ["customer_id", "avg_order_value", "purchase_freq_monthly", "churn_rate",
               "gross_margin_pct", "clv_12m", "clv_36m", "clv_segment"]


def np_round(col, digits: int):
    """pandas/numpy ``round``: half-to-even on the scaled binary value."""
    scale = float(10 ** digits)
    return F.rint(col * scale) / scale


def days_between(later, earlier):
    """Whole 24-hour periods from ``earlier`` to ``later`` (timedelta ``.days``)."""
    return F.timestamp_diff("DAY", earlier, later)


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------

def invoice_totals(t: Tables) -> DataFrame:
    """invoice_no -> inv_total (sum of line_total); invoice grain."""
    return t.order_items().groupBy("invoice_no").agg(sum_money("line_total").alias("inv_total"))


def line_margins(t: Tables, default_margin: str | None = None,
                 with_description: bool = False, left: bool = False) -> DataFrame:
    """order_items with the category margin of each line.

    ``default_margin=None`` keeps only lines whose product and category margin
    exist (inner joins) unless ``left``, which keeps them with a NULL margin;
    otherwise missing ones get the default.
    """
    items = t.order_items()
    pcols = ["stock_code", "category"] + (["description"] if with_description else [])
    products = t.products().select(*pcols)
    margins = t.margins().select("category", "gross_margin_pct")
    if default_margin is None and left:
        return (items.join(products, "stock_code", "left")
                .join(margins, "category", "left"))
    if default_margin is None:
        return (items.join(products, "stock_code")
                .join(margins, "category"))
    return (items.join(products, "stock_code", "left")
            .join(margins, "category", "left")
            .withColumn("gross_margin_pct",
                        F.coalesce(F.col("gross_margin_pct"),
                                   F.lit(default_margin).cast("decimal(5,4)"))))


def invoice_margin_totals(t: Tables, default_margin: str | None = None) -> DataFrame:
    """invoice_no -> inv_total, inv_margin (sum of line_total x margin)."""
    return (line_margins(t, default_margin).groupBy("invoice_no")
            .agg(sum_money("line_total").alias("inv_total"),
                 sum_money_times_rate("line_total", "gross_margin_pct").alias("inv_margin")))


def snapshot_date(t: Tables) -> DataFrame:
    """Q-01: day after the last completed invoice (one row)."""
    return t.completed_orders().agg(
        F.date_add(F.to_date(F.max("invoice_date")), 1).alias("snapshot_date"))


def dataset_span_months(t: Tables) -> DataFrame:
    """Q-08: span of completed orders in 30.5-day months, rounded to 2 places."""
    o = t.completed_orders()
    days = F.datediff(F.max("invoice_date"), F.min("invoice_date"))
    return o.agg(round_half_up(days / config.DAYS_PER_MONTH, 2).alias("dataset_span_months"))


def _segment_and_sum(df: DataFrame, rules) -> DataFrame:
    return (df.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .withColumn("rfm_segment", segment_col("r_score", "f_score", "m_score", rules)))


# ---------------------------------------------------------------------------
# RFM — SQL rules
# ---------------------------------------------------------------------------

def rfm_base(t: Tables) -> DataFrame:
    """customer -> recency_days, frequency, monetary (completed orders with lines)."""
    orders = t.completed_orders().select("invoice_no", "customer_id", "invoice_date")
    per_customer = (orders.join(invoice_totals(t), "invoice_no")
                    .groupBy("customer_id")
                    .agg(F.max(F.to_date("invoice_date")).alias("last_date"),
                         F.count(F.lit(1)).alias("frequency"),
                         F.sum("inv_total").alias("monetary")))
    # one-row scalar (the snapshot date), broadcast: bounded at one row
    snap = snapshot_date(t)
    return (per_customer.crossJoin(F.broadcast(snap))
            .select("customer_id",
                    F.datediff("snapshot_date", "last_date").cast("int").alias("recency_days"),
                    F.col("frequency").cast("int").alias("frequency"),
                    F.col("monetary").cast("decimal(18,2)").alias("monetary")))


def _rfm_tiles() -> dict:
    k = config.RFM_TILES
    return {"_r": (Metric("recency_days"), k), "f_score": (Metric("frequency"), k), "m_score": (Metric("monetary"), k)}


def _recency_score() -> Column:
    """Recent customers score high: the recency tile, inverted."""
    return (F.lit(config.RFM_TILES + 1) - F.col("_r")).cast("int").alias("r_score")


def rfm_scores(t: Tables) -> DataFrame:
    """Q-02: NTILE(5) quintiles (recency inverted), SQL segment rules.
    Ties break on ascending customer_id. The stored table, if there is one."""
    if t.stored("rfm_scores") is not None:
        return t.stored("rfm_scores").select(*RFM_COLUMNS)
    return rfm_of(rfm_base(t))


def rfm_of(base: DataFrame) -> DataFrame:
    """RFM scores from recency_days, frequency and monetary per customer."""
    return _rfm_segments(add_tiles(base, "customer_id", _rfm_tiles()))


def _rfm_segments(tiled: DataFrame) -> DataFrame:
    return _segment_and_sum(tiled.select("*", _recency_score()), config.SQL_SEGMENT_RULES).select(*RFM_COLUMNS)


# ---------------------------------------------------------------------------
# CLV — SQL rules
# ---------------------------------------------------------------------------

def clv_base(t: Tables) -> DataFrame:
    orders = t.completed_orders().select("invoice_no", "customer_id")
    per_customer = (orders.join(invoice_margin_totals(t), "invoice_no")
                    .groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("order_count"),
                         F.sum("inv_total").alias("total_revenue"),
                         F.sum("inv_margin").alias("margin_total")))
    return per_customer.crossJoin(F.broadcast(dataset_span_months(t)))


CLV_VALUE_COLUMNS = CLV_COLUMNS[:-1]


def _clv_columns() -> list[Column]:
    """The value columns of the CLV table from per-customer inputs (order_count,
    total_revenue, margin_total, dataset_span_months)."""
    rev = F.col("total_revenue").cast("double")
    cnt = F.col("order_count").cast("double")
    months = F.col("dataset_span_months")
    blended = round_half_up(F.try_divide(F.col("margin_total").cast("double"),
                                         F.nullif(rev, F.lit(0.0))), 4)
    per_month = F.try_divide(cnt, months)
    value = F.try_divide(rev, cnt) * per_month
    return [round_money(F.try_divide(rev, cnt)).alias("avg_order_value"),
            round_money(per_month, 12, 4).alias("purchase_freq_monthly"),
            round_money(F.lit(1.0) - F.try_divide(F.lit(1.0), cnt), 5, 4).alias("churn_rate"),
            blended.cast("decimal(5,4)").alias("gross_margin_pct"),
            round_money(value * 12 * blended).alias("clv_12m"),
            round_money(value * 36 * blended).alias("clv_36m")]


def clv_values(t: Tables) -> DataFrame:
    """The CLV table without tiers (nothing is ranked)."""
    if t.stored("clv_scores") is not None:
        return t.stored("clv_scores").select(*CLV_VALUE_COLUMNS)
    return clv_base(t).select("customer_id", *_clv_columns())


def _tier(tile: str) -> Column:
    return F.when(F.col(tile) == 3, "High").when(F.col(tile) == 2, "Medium").otherwise("Low")


def clv_scores(t: Tables) -> DataFrame:
    """Q-05: AOV x monthly frequency x 12 (36) x blended margin; NTILE(3)
    tiers. The stored table, if there is one."""
    if t.stored("clv_scores") is not None:
        return t.stored("clv_scores").select(*CLV_COLUMNS)
    return _clv_tiers(clv_values(t))


def clv_of(base: DataFrame) -> DataFrame:
    """CLV scores from per-customer inputs (those of :func:`clv_base`)."""
    return _clv_tiers(base.select("customer_id", *_clv_columns()))


def _clv_tiers(values: DataFrame) -> DataFrame:
    tiled = add_tiles(values, "customer_id", {"_c": (Metric("clv_12m"), config.CLV_TILES)})
    return tiled.select(*CLV_VALUE_COLUMNS, _tier("_c").alias("clv_segment"))


def clv_value(base: DataFrame) -> DataFrame:
    """customer_id -> clv_12m from per-customer CLV inputs (order_count,
    total_revenue, margin_total, dataset_span_months); NULL for customers
    without a product/margin-matched order. No tiers, so no ranks."""
    rev = F.col("total_revenue").cast("double")
    cnt = F.col("order_count").cast("double")
    blended = round_half_up(F.try_divide(F.col("margin_total").cast("double"),
                                         F.nullif(rev, F.lit(0.0))), 4)
    value = F.try_divide(rev, cnt) * F.try_divide(cnt, F.col("dataset_span_months"))
    return base.select("customer_id", "gross", "fan_rows",
                       F.when(F.col("order_count") > 0, round_money(value * 12 * blended))
                       .alias("clv_12m"))


def rfm_clv(t: Tables) -> DataFrame:
    """Both SQL-rule score tables LEFT-joined 1:1 on customer_id: every customer
    with RFM scores; CLV columns are NULL for those without a product/margin-
    matched order. Stored tables are joined; otherwise ONE pass over the fact
    feeds both: lines LEFT-join product and margin once; per invoice the all-lines
    totals feed RFM and the matched-lines totals feed CLV."""
    if t.stored("rfm_scores") is not None and t.stored("clv_scores") is not None:
        return rfm_scores(t).join(clv_scores(t), "customer_id", "left")
    lines = line_margins(t, default_margin=None, left=True)
    matched = F.col("gross_margin_pct").isNotNull()
    inv = lines.groupBy("invoice_no").agg(
        sum_money("line_total").alias("inv_total"),
        sum_money(F.when(matched, F.col("line_total"))).alias("clv_total"),
        sum_money_times_rate("line_total", "gross_margin_pct").alias("clv_margin"),
        F.count_if(matched).alias("clv_lines"))
    orders = t.completed_orders().select("invoice_no", "customer_id", "invoice_date")
    per_customer = (orders.join(inv, "invoice_no").groupBy("customer_id").agg(
        F.max(F.to_date("invoice_date")).alias("last_date"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("inv_total").alias("monetary"),
        F.count_if(F.col("clv_lines") > 0).alias("order_count"),
        F.sum("clv_total").alias("total_revenue"),
        F.sum("clv_margin").alias("margin_total")))
    base = (per_customer.crossJoin(F.broadcast(snapshot_date(t)))
            .crossJoin(F.broadcast(dataset_span_months(t))))
    scored = base.select(
        "customer_id",
        F.datediff("snapshot_date", "last_date").cast("int").alias("recency_days"),
        F.col("frequency").cast("int").alias("frequency"),
        F.col("monetary").cast("decimal(18,2)").alias("monetary"),
        (F.col("order_count") > 0).alias("_has_clv"), *_clv_columns())
    tiled = add_tiles(scored, "customer_id", {
        **_rfm_tiles(), "_c": (Metric("clv_12m", only="_has_clv"), config.CLV_TILES)})
    has = F.col("_has_clv")
    out = tiled.select(
        "customer_id", "recency_days", "frequency", "monetary", _recency_score(), "f_score", "m_score",
        *[F.when(has, F.col(c)).alias(c) for c in CLV_VALUE_COLUMNS[1:]],
        F.when(has, _tier("_c")).alias("clv_segment"))
    return _segment_and_sum(out, config.SQL_SEGMENT_RULES).select(*RFM_COLUMNS, *CLV_COLUMNS[1:])


def scored_customers(t: Tables) -> DataFrame:
    """Customers with both scores (the inner join of the two tables)."""
    return rfm_clv(t).where(F.col("clv_segment").isNotNull())


# ---------------------------------------------------------------------------
# Notebook rules: RFM + CLV in one customer table ("customer_clv_master")
# ---------------------------------------------------------------------------

NOTEBOOK_MASTER_COLUMNS = [
    "customer_id", "country", "first_purchase_date", "last_purchase_date", "rfm_segment",
    "r_score", "f_score", "m_score", "rfm_score", "recency_days", "frequency", "monetary",
    "avg_order_value", "purchase_freq_monthly", "gross_margin_pct", "churn_rate", "clv_12m",
    "clv_36m", "clv_segment"]


def notebook_base(t: Tables, *, default_margin: str = config.DEFAULT_MARGIN, with_clv: bool = True) -> DataFrame:
    """The customer table of the notebook rules before any ranking: 24-hour
    recency from the last line + 1 day, unrounded span, 0.48 default margin,
    AOV/frequency rounded before the CLV product. Without ``with_clv`` only the
    RFM inputs, and neither products nor margins are read."""
    by_customer = t.country_is_customer_attribute
    orders = t.completed_orders(with_country=with_clv and not by_customer)
    aggs = [F.max("invoice_date").alias("last_purchase"),
            F.min("invoice_date").alias("first_purchase"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("inv_total").alias("monetary")]
    if with_clv:
        aggs.append(F.sum("inv_margin").alias("margin_total"))
        if not by_customer:
            # first country over the customer's invoices
            aggs.append(F.min_by("country", F.struct("invoice_date", "invoice_no")).alias("country"))
    totals = invoice_margin_totals(t, default_margin) if with_clv else invoice_totals(t)
    per_customer = orders.join(totals, "invoice_no").groupBy("customer_id").agg(*aggs)
    if with_clv and by_customer:
        per_customer = per_customer.join(t.customer_countries(), "customer_id", "left")
    # whole-table scalars: analysis date (last line + 1 day) and span in months; one row
    per_customer = checkpointed(per_customer)
    span = per_customer.agg(F.max("last_purchase").alias("_max"), F.min("first_purchase").alias("_min"))
    base = per_customer.crossJoin(F.broadcast(span))
    snap = F.timestamp_add("DAY", F.lit(1), F.col("_max"))
    rfm = [days_between(snap, F.col("last_purchase")).cast("int").alias("recency_days"),
           F.col("frequency").cast("int").alias("frequency"),
           F.col("monetary").cast("decimal(18,2)").alias("monetary")]
    if not with_clv:
        return base.select("customer_id", *rfm)
    months = days_between(F.col("_max"), F.col("_min")) / config.DAYS_PER_MONTH
    monetary = F.col("monetary").cast("double")
    freq = F.col("frequency").cast("double")
    margin = F.when(monetary > 0, F.col("margin_total").cast("double") / monetary) \
        .otherwise(F.lit(float(default_margin)))
    aov = np_round(F.try_divide(monetary, freq), 2)
    pfm = np_round(F.try_divide(freq, months), 6)
    clv12 = np_round(aov * pfm * 12 * margin, 2)
    return base.select(
        "customer_id", "country",
        F.to_date("first_purchase").alias("first_purchase_date"),
        F.to_date("last_purchase").alias("last_purchase_date"), *rfm,
        aov.alias("avg_order_value"), pfm.alias("purchase_freq_monthly"),
        margin.alias("gross_margin_pct"),
        np_round(F.lit(1.0) - F.lit(1.0) / F.greatest(freq, F.lit(1.0)), 6).alias("churn_rate"),
        clv12.alias("clv_12m"), np_round(clv12 * 3, 2).alias("clv_36m"))


def notebook_master(t: Tables, *, rfm: bool = True, tiers: bool = True, with_clv: bool = True) -> DataFrame:
    """Notebook rules: qcut on first-rank; 36-month CLV = 3 x the rounded
    12-month value. One row per customer with a completed line. ``rfm`` and
    ``tiers`` say which scores are wanted; only those are ranked."""
    k = config.RFM_TILES
    tiles = {"_r": (Metric("recency_days"), k), "f_score": (Metric("frequency"), k), "m_score": (Metric("monetary"), k)} if rfm else {}
    if tiers:
        tiles["_c"] = (Metric("clv_12m"), config.CLV_TILES)
    out = add_tiles(notebook_base(t, with_clv=with_clv), "customer_id", tiles, qcut_border)
    if tiers:
        out = out.withColumn("clv_segment", F.when(F.col("_c") == 1, "Low").when(F.col("_c") == 2, "Medium").otherwise("High")).drop("_c")
    if rfm:
        out = _segment_and_sum(out.select("*", _recency_score()), config.NOTEBOOK_SEGMENT_RULES).drop("_r")
    return out


def rfm_scores_notebook(t: Tables) -> DataFrame:
    """Q-02n."""
    return notebook_master(t, tiers=False, with_clv=False).select(*RFM_COLUMNS)


def clv_scores_notebook(t: Tables) -> DataFrame:
    """Q-05n."""
    m = notebook_master(t, rfm=False)
    return m.select(*CLV_COLUMNS[:4], round_half_up(F.col("gross_margin_pct"), 6)
                    .alias("gross_margin_pct"), *CLV_COLUMNS[5:])


def customer_clv_master(t: Tables) -> DataFrame:
    """The customer master of the notebook rules (the exported table)."""
    m = notebook_master(t)
    return m.select(*[round_half_up(F.col(c), 6).alias(c) if c == "gross_margin_pct" else c
                      for c in NOTEBOOK_MASTER_COLUMNS])


# ---------------------------------------------------------------------------
# Incremental refresh of a score table (upsert by customer_id)
# ---------------------------------------------------------------------------

def _midpoint_cutoff(t: Tables) -> DataFrame:
    """One row: the calendar midpoint of the completed-order span."""
    first = F.to_date(F.min("invoice_date"))
    days = F.datediff(F.max("invoice_date"), F.min("invoice_date"))
    return t.completed_orders().agg(
        F.date_add(first, F.floor(days / 2).cast("int")).alias("_cutoff"))


def score_upsert(t: Tables) -> DataFrame:
    """Q-42: the RFM score table as of the span midpoint, refreshed by an
    upsert: scores over the full history, for the customers active after the
    midpoint; the others keep their old row."""
    from patronage.operators.upsert import upsert
    from patronage.plans import state

    # the fact is read once: partials up to the midpoint, and after it; both add up to the full
    # history, so one row per customer holds both states, and one selection finds the borders of both
    cut = F.broadcast(_midpoint_cutoff(t))  # one row
    invoices = state.invoice_state(t, clv=False).crossJoin(cut)
    parts = state.partials(invoices, F.to_date("invoice_date") > F.col("_cutoff"))
    tiled = checkpointed(add_tiles(state.rfm_base_of_two(checkpointed(parts)), "customer_id", {
        f"{era}{tile}": (Metric(era + metric.value, only), k) for era, only in (("new_", None), ("old_", "old"))
        for tile, (metric, k) in _rfm_tiles().items()}))

    def scored(era: str, rows: str) -> DataFrame:
        own = [F.col(f"{era}{c}").alias(c) for c in ("recency_days", "frequency", "monetary", *_rfm_tiles())]
        return _rfm_segments(tiled.where(rows).select("customer_id", *own))

    return upsert(scored("old_", "old"), scored("new_", "active"), ["customer_id"])
