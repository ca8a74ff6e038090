"""DuckDB twins of the exploration and campaign queries."""

from __future__ import annotations

from patronage import config
from patronage.functions.rounding import sql_round as R
from patronage.plans.oracle import case_of, notebook_ctes, np_round_sql, with_adapter
from patronage.sources.tables import RAW_ORDER

NB = notebook_ctes()


def quantile_sql(value: str, q: float) -> str:
    return f"(SELECT quantile_cont(CAST({value} AS DOUBLE), {q}) FROM x_master)"


def _campaign_ctes() -> str:
    name, cost, uplift = config.CAMPAIGN_FALLBACK
    m = config.CAMPAIGN_MATRIX
    name_sql = case_of("rfm_segment", [(r[0], r[1]) for r in m], name)
    cost_sql = case_of("rfm_segment", [(r[0], r[2]) for r in m], cost)
    uplift_sql = case_of("rfm_segment", [(r[0], r[3]) for r in m], uplift)
    tier = case_of("clv_segment", [(x, x) for x in config.TIER_ORDER], "Low")
    return NB + f""",
x_t AS (
  SELECT customer_id, rfm_segment, clv_segment, {name_sql} AS campaign_name,
         CAST({cost_sql} AS INTEGER) AS campaign_cost, clv_12m,
         {np_round_sql(f'clv_12m * CAST({uplift_sql} AS DOUBLE)', 2)} AS expected_revenue,
         {tier} AS priority_tier
  FROM x_master)"""


def _hist_sql() -> str:
    def edge(i: str) -> str:
        return f"(CASE WHEN {i} >= 30 THEN hi ELSE {i} * ((hi - lo) / 30) + lo END)"
    f = "floor((x - lo) / (hi - lo) * 30)"
    return NB + f""",
x_st0 AS (SELECT min(clv_12m) AS mn, {quantile_sql('clv_12m', 0.99)} AS p99 FROM x_master),
x_st1 AS (SELECT LEAST(mn, p99) AS lo, p99 AS hi FROM x_st0),
x_st AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
                CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM x_st1),
x_b0 AS (SELECT LEAST(clv_12m, hi) AS x, lo, hi FROM x_master, x_st WHERE clv_12m IS NOT NULL),
x_b1 AS (SELECT *, CASE WHEN {f} >= 30 THEN 29 ELSE {f} END AS i0 FROM x_b0),
x_b2 AS (SELECT *, CASE WHEN x < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM x_b1),
x_b3 AS (SELECT *, CASE WHEN x >= {edge('(i1 + 1)')} AND i1 <> 29 THEN i1 + 1 ELSE i1 END AS i2
         FROM x_b2),
x_cnt AS (SELECT CAST(i2 + 1 AS INTEGER) AS bin, count(*) AS customers FROM x_b3 GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, {R(edge('(r.bin - 1)'), 6)} AS bin_start,
       {R(edge('r.bin'), 6)} AS bin_end, COALESCE(c.customers, 0) AS customers
FROM range(1, 31) AS r(bin) CROSS JOIN x_st LEFT JOIN x_cnt c ON CAST(r.bin AS INTEGER) = c.bin"""


def _describe_sql() -> str:
    parts = []
    for col in ("recency_days", "frequency", "monetary"):
        qs = {q: quantile_sql(col, q) for q in (0.25, 0.5, 0.75)}
        parts.append(f"""
SELECT '{col}' AS metric, count({col}) AS count,
  {np_round_sql(f'CAST(sum(CAST({col} AS DECIMAL(28,2))) AS DOUBLE) / count({col})', 2)} AS mean,
  {np_round_sql(f'stddev_samp(CAST({col} AS DOUBLE))', 2)} AS std,
  {np_round_sql(f'min(CAST({col} AS DOUBLE))', 2)} AS min,
  {np_round_sql(qs[0.25], 2)} AS p25, {np_round_sql(qs[0.5], 2)} AS p50,
  {np_round_sql(qs[0.75], 2)} AS p75,
  {np_round_sql(f'max(CAST({col} AS DOUBLE))', 2)} AS max
FROM x_master""")
    return NB + "\n" + " UNION ALL ".join(parts)


def explore_sql() -> dict[str, str]:
    tier_pos = case_of("label", [(x, i + 1) for i, x in enumerate(config.TIER_ORDER)], None)
    days = ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(config.DAY_NAMES))
    months = ", ".join(
        f"NULLIF(count(*) FILTER (WHERE monthname(invoice_date) = '{m}'), 0) AS \"{m}\""
        for m in config.MONTH_NAMES)
    seq = ", ".join(RAW_ORDER)
    camp = _campaign_ctes()
    mean = "CAST(sum(CAST(clv_12m AS DECIMAL(18,2))) AS DOUBLE) / count(clv_12m)"
    return {
        "monthly_net_revenue": with_adapter(NB + f""",
x_mn AS (SELECT CAST(date_trunc('month', invoice_date) AS TIMESTAMP) AS order_date,
                sum(line_total * margin_pct) AS net, count(DISTINCT invoice_no) AS order_count,
                count(DISTINCT customer_id) AS customers
         FROM x_nb_lines GROUP BY 1),
x_ml AS (SELECT *, CAST(lag(net) OVER (ORDER BY order_date) AS DOUBLE) AS prev FROM x_mn)
SELECT order_date, CAST(net AS DECIMAL(24,6)) AS net_revenue, order_count, customers,
       {np_round_sql('CAST(net AS DOUBLE) / order_count', 2)} AS aov,
       {R('CAST(net AS DOUBLE) / NULLIF(prev, 0) * 100 - 100', 6)} AS mom_growth
FROM x_ml"""),
        "category_net_revenue_top9": with_adapter(NB + """,
x_c AS (SELECT category, sum(line_total * margin_pct) AS net, sum(quantity) AS units,
               count(DISTINCT invoice_no) AS orders
        FROM x_nb_lines WHERE category IS NOT NULL GROUP BY category
        ORDER BY net DESC, category LIMIT 9)
SELECT c.category, CAST(c.net AS DECIMAL(24,6)) AS net_revenue,
       CAST(c.units AS BIGINT) AS units_sold, c.orders,
       COALESCE(m.gross_margin_pct, CAST(0.48 AS DECIMAL(5,4))) AS margin_pct
FROM x_c c LEFT JOIN x_margins m ON c.category = m.category"""),
        "country_customers_top10": with_adapter(NB + f""",
x_cc AS (SELECT country, count(DISTINCT customer_id) AS customer_count FROM x_nb_lines
         WHERE country IS NOT NULL GROUP BY country ORDER BY customer_count DESC, country LIMIT 10)
SELECT country, customer_count,
       {np_round_sql('customer_count / sum(customer_count) OVER () * 100', 1)} AS pct
FROM x_cc"""),
        "top_products": with_adapter(NB + """
SELECT product_name, category, CAST(sum(line_total * margin_pct) AS DECIMAL(24,6)) AS net_revenue,
       CAST(sum(quantity) AS BIGINT) AS units
FROM x_nb_lines WHERE product_name IS NOT NULL AND category IS NOT NULL
GROUP BY product_name, category
ORDER BY sum(line_total * margin_pct) DESC, product_name, category LIMIT 20"""),
        "order_heatmap": with_adapter(NB + f""",
x_inv AS (SELECT DISTINCT invoice_no, invoice_date FROM x_nb_lines)
SELECT d.dow, CAST(d.pos AS INTEGER) AS dow_position, {months}
FROM (VALUES {days}) AS d(dow, pos) LEFT JOIN x_inv ON dayname(invoice_date) = d.dow GROUP BY 1, 2"""),
        "order_items_enriched": with_adapter(f"""
x_ii AS (SELECT row_number() OVER (ORDER BY {seq}) AS item_id, l_orderkey AS invoice_no,
                l_partkey AS stock_code, CAST(l_quantity AS INTEGER) AS quantity,
                CAST(ROUND(CAST(l_extendedprice / l_quantity AS DECIMAL(28,6)), 2) AS DECIMAL(10,2)) AS unit_price,
                CAST(l_extendedprice AS DECIMAL(14,2)) AS line_total
         FROM lineitem)
SELECT i.item_id, i.invoice_no AS order_id, i.stock_code, i.quantity, i.unit_price, i.line_total,
       o.invoice_date AS order_date, o.customer_id, p.description AS product_name, p.category,
       o.order_status,
       CAST(i.line_total * COALESCE(m.gross_margin_pct, CAST(0.48 AS DECIMAL(5,4))) AS DECIMAL(20,6)) AS net_line_total,
       CAST(i.line_total * COALESCE(m.gross_margin_pct, CAST(0.48 AS DECIMAL(5,4))) AS DECIMAL(20,6)) AS line_profit
FROM x_ii i JOIN x_completed o ON i.invoice_no = o.invoice_no
LEFT JOIN x_products p ON i.stock_code = p.stock_code
LEFT JOIN x_margins m ON p.category = m.category"""),
        "avg_clv_by_segment": with_adapter(NB + f"""
SELECT rfm_segment, {R(mean, 6)} AS avg_clv_12m FROM x_master GROUP BY rfm_segment"""),
        "clv_stats": with_adapter(NB + f"""
SELECT count(*) AS customers, {R(mean, 6)} AS mean_clv_12m,
       {R(quantile_sql('clv_12m', 0.5), 6)} AS median_clv_12m,
       {R(quantile_sql('clv_12m', 0.99), 6)} AS p99_clv_12m
FROM x_master"""),
        "clv_histogram": with_adapter(_hist_sql()),
        "rfm_describe": with_adapter(_describe_sql()),
        "rfm_clv_points": with_adapter(NB + f"""
SELECT customer_id, recency_days, monetary, rfm_segment, clv_12m,
       {R('CASE WHEN clv_12m IS NULL THEN NULL ELSE GREATEST(clv_12m, 5.0) / 5 END', 6)} AS point_size
FROM x_master"""),
        "campaign_targets": with_adapter(camp + """
SELECT customer_id, rfm_segment, clv_segment, campaign_name, campaign_cost, clv_12m,
       expected_revenue, priority_tier FROM x_t"""),
        "campaign_roi": with_adapter(camp + f""",
x_r AS (SELECT rfm_segment, campaign_name, count(*) AS customers,
               CAST(sum(campaign_cost) AS BIGINT) AS total_cost,
               {mean} AS avg_clv,
               CAST(sum(CAST(expected_revenue AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_expected
        FROM x_t GROUP BY 1, 2),
x_r2 AS (SELECT *, {np_round_sql('(CAST(total_expected AS DOUBLE) - total_cost) / total_cost * 100', 1)} AS roi_pct
         FROM x_r)
SELECT rfm_segment, campaign_name, customers, total_cost, {R('avg_clv', 6)} AS avg_clv,
       total_expected, roi_pct, CASE WHEN roi_pct >= 200 THEN 'green' WHEN roi_pct >= 100 THEN 'amber' ELSE 'red' END AS roi_band
FROM x_r2"""),
        "cac_reduction": with_adapter(camp + f""",
x_a AS (SELECT count(*) AS customers, CAST(sum(campaign_cost) AS BIGINT) AS targeted_total,
               sum(CAST(expected_revenue AS DECIMAL(18,2))) AS incremental FROM x_t)
SELECT customers, CAST(customers * {config.BLANKET_COST_PER_CUSTOMER} AS BIGINT) AS blanket_total,
       targeted_total,
       {np_round_sql(f'(customers * {config.BLANKET_COST_PER_CUSTOMER} - targeted_total) / (customers * {config.BLANKET_COST_PER_CUSTOMER}) * 100', 1)} AS cac_reduction_pct,
       CAST(incremental AS DECIMAL(18,2)) AS total_incremental_revenue
FROM x_a"""),
        "campaign_cost_by_segment": with_adapter(camp + f"""
SELECT rfm_segment, count(*) AS customers, CAST(sum(campaign_cost) AS BIGINT) AS total_cost,
       CAST(count(*) * {config.BLANKET_COST_PER_CUSTOMER} AS BIGINT) AS blanket_cost,
       {np_round_sql('sum(campaign_cost) / count(*)', 2)} AS avg_cost
FROM x_t GROUP BY rfm_segment"""),
        "segment_counts": with_adapter(camp + f""",
x_sc AS (SELECT 'rfm_segment' AS kind, rfm_segment AS label, count(*) AS customers FROM x_t GROUP BY 2
  UNION ALL SELECT 'clv_segment', clv_segment, count(*) FROM x_t GROUP BY 2
  UNION ALL SELECT 'priority_tier', priority_tier, count(*) FROM x_t GROUP BY 2)
SELECT kind, label, customers,
       CAST(CASE WHEN kind = 'priority_tier' THEN {tier_pos}
            ELSE row_number() OVER (PARTITION BY kind ORDER BY customers DESC, label) END AS INTEGER) AS position
FROM x_sc"""),
        "analysis_footer": with_adapter(NB + f"""
SELECT count(*) AS customers, {np_round_sql(mean, 2)} AS avg_clv_12m,
       {np_round_sql('CAST(sum(CAST(avg_order_value AS DECIMAL(18,2))) AS DOUBLE) / count(avg_order_value)', 2)} AS avg_aov,
       {np_round_sql('avg(gross_margin_pct) * 100', 1)} AS avg_margin_pct,
       count(*) FILTER (WHERE rfm_segment = 'Champions') AS champions,
       count(*) FILTER (WHERE rfm_segment = 'Lost') AS lost
FROM x_master"""),
    }
