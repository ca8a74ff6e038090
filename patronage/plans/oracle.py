"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver's tables. The retail star schema is
rebuilt by the CTEs of :func:`adapter_ctes`, rendered from the same constants
as :class:`patronage.sources.tables.Tables`. CTE names carry an ``x_`` prefix
so they never shadow the driver's own views.
"""

from __future__ import annotations

from patronage import config
from patronage.functions.rounding import sql_round, sql_round_money
from patronage.sources.tables import RAW_ORDER

# The twins share constants with the engine, never its operators or rule
# compiler: tiles, quantiles, segments and fan-outs are DuckDB's own.

# The two segment rule tables, first match wins.
SQL_SEGMENT = """CASE
    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
    WHEN r_score >= 3 AND f_score >= 4 AND m_score >= 3 THEN 'Loyal Customers'
    WHEN r_score >= 4 AND f_score <= 2 AND m_score <= 2 THEN 'New Customers'
    WHEN r_score >= 3 AND f_score >= 2 AND m_score >= 3 THEN 'Potential Loyalists'
    WHEN r_score >= 3 AND f_score >= 3 THEN 'Promising'
    WHEN r_score = 2 AND f_score >= 2 AND m_score >= 2 THEN 'Need Attention'
    WHEN r_score = 2 AND (f_score <= 2 OR m_score <= 2) THEN 'At Risk'
    WHEN r_score = 1 AND f_score >= 3 AND m_score >= 3 THEN 'Cannot Lose Them'
    WHEN r_score = 1 THEN 'Lost'
    ELSE 'Hibernating' END"""
NOTEBOOK_SEGMENT = """CASE
    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
    WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
    WHEN r_score >= 3 AND f_score >= 2 AND m_score <= 3 THEN 'Potential Loyalists'
    WHEN r_score >= 4 AND f_score >= 2 AND m_score >= 3 THEN 'Promising'
    WHEN r_score = 3 AND f_score <= 3 THEN 'Need Attention'
    WHEN r_score <= 2 AND f_score >= 4 THEN 'At Risk'
    WHEN r_score <= 2 AND f_score >= 2 AND m_score >= 3 THEN 'Cannot Lose Them'
    WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
    ELSE 'Hibernating' END"""


def _text(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def case_of(key: str, pairs, default) -> str:
    """A literal CASE over constants."""
    return f"CASE {key} " + " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in pairs) + f" ELSE {_text(default)} END"


def category_case(description: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({description}, {_text(p)}) THEN {_text(label)}" for label, p in rules) + \
        f" ELSE {_text(config.FALLBACK_CATEGORY)} END"


def qcut_bins(rank: str, n: str, k: int) -> str:
    """pandas ``qcut`` of the ranks 1..n from its definition: one bin more for
    each inner edge 1 + j(n-1)/k that lies below the rank (and, for k = 3 and
    n = 1 mod 3, where numpy's edge falls just short of the integer, at it)."""
    at = f"({k} = 3 AND {n} % 3 = 1 AND {n} > 1)"
    edges = " + ".join(f"CASE WHEN {k} * ({rank} - 1) > {j} * ({n} - 1) OR ({at} AND {k} * ({rank} - 1) = {j} * ({n} - 1)) "
                       f"THEN 1 ELSE 0 END" for j in range(1, k))
    return f"CAST(1 + {edges} AS INTEGER)"


def _margins_values() -> str:
    rows = ", ".join(f"('{c}', CAST({m} AS DECIMAL(5,4)))" for c, m, _ in config.CATEGORY_MARGINS)
    return f"SELECT * FROM (VALUES {rows}) AS v(category, gross_margin_pct)"


def adapter_ctes(rules=config.ADAPTER_CATEGORY_RULES) -> str:
    status = case_of("o.o_orderstatus", config.ADAPTER_STATUS, None)
    seq = ", ".join(f"l.{c}" for c in RAW_ORDER)
    return f"""
x_geo AS (
  SELECT c.c_custkey AS customer_id, n.n_name AS country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
x_orders AS (
  SELECT o.o_orderkey AS invoice_no, o.o_custkey AS customer_id, o.o_orderdate AS invoice_date,
         {status} AS order_status, g.country
  FROM orders o LEFT JOIN x_geo g ON o.o_custkey = g.customer_id),
x_completed AS (SELECT * FROM x_orders WHERE order_status = 'Completed'),
x_items AS (
  SELECT l_orderkey AS invoice_no, l_partkey AS stock_code,
         CAST(l_quantity AS INTEGER) AS quantity,
         {sql_round_money('l_extendedprice / l_quantity', 10, 2)} AS unit_price,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS line_total
  FROM lineitem),
x_products AS (
  SELECT p_partkey AS stock_code, upper(p_name) AS description,
         {category_case('upper(p_name)', rules)} AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS avg_unit_price
  FROM part),
x_margins AS ({_margins_values()}),
x_customers AS (
  SELECT g.customer_id, g.country, s.first_purchase_date, s.last_purchase_date, TRUE AS is_active
  FROM x_geo g LEFT JOIN (
    SELECT customer_id, CAST(min(invoice_date) AS DATE) AS first_purchase_date,
           CAST(max(invoice_date) AS DATE) AS last_purchase_date
    FROM x_completed GROUP BY customer_id) s ON g.customer_id = s.customer_id),
x_raw AS (
  SELECT row_number() OVER (ORDER BY {seq}) AS id,
    CASE WHEN o.o_orderstatus = 'P' THEN 'C' || CAST(o.o_orderkey AS VARCHAR)
         ELSE CAST(o.o_orderkey AS VARCHAR) END AS "InvoiceNo",
    CASE WHEN l.l_partkey % 50 = 0 THEN 'POST'
         WHEN l.l_partkey % 50 = 1 THEN 'gift_' || CAST(l.l_partkey AS VARCHAR)
         WHEN l.l_partkey % 50 = 2 THEN 'DCGS' || CAST(l.l_partkey AS VARCHAR)
         ELSE CAST(l.l_partkey AS VARCHAR) END AS "StockCode",
    CASE WHEN l.l_partkey % 41 = 0 THEN NULL ELSE ' ' || p.p_name || ' ' END AS "Description",
    CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS INTEGER)
         ELSE CAST(l.l_quantity AS INTEGER) END AS "Quantity",
    o.o_orderdate + to_minutes(CAST(l.l_linenumber * 37 AS BIGINT)) AS "InvoiceDate",
    CASE WHEN l.l_tax = 0 THEN CAST(0 AS DECIMAL(10,4))
         ELSE {sql_round_money('l.l_extendedprice / l.l_quantity', 10, 4)} END AS "UnitPrice",
    CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS "CustomerID",
    g.country AS "Country"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN x_geo g ON o.o_custkey = g.customer_id)"""


def with_adapter(body: str) -> str:
    """Prefix a query body (which may start with its own ``name AS (...)``
    CTEs followed by a final SELECT) with the adapter CTEs."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return "WITH " + adapter_ctes() + "\n" + body
    return "WITH " + adapter_ctes() + ",\n" + body


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

SNAPSHOT = """
x_snapshot AS (
  SELECT CAST(CAST(max(invoice_date) AS DATE) + 1 AS DATE) AS snapshot_date FROM x_completed)"""

SPAN = f"""
x_span AS (
  SELECT {sql_round('date_diff(' + "'day'" + ', CAST(min(invoice_date) AS DATE), CAST(max(invoice_date) AS DATE)) / 30.5', 2)}
         AS dataset_span_months
  FROM x_completed)"""


def _rfm_ctes() -> str:
    return SNAPSHOT + f""",
x_rfm_base AS (
  SELECT o.customer_id,
         CAST(date_diff('day', max(CAST(o.invoice_date AS DATE)), (SELECT snapshot_date FROM x_snapshot)) AS INTEGER) AS recency_days,
         CAST(count(DISTINCT o.invoice_no) AS INTEGER) AS frequency,
         CAST(sum(i.line_total) AS DECIMAL(18,2)) AS monetary
  FROM x_completed o JOIN x_items i ON o.invoice_no = i.invoice_no
  GROUP BY o.customer_id),
x_rfm_scored AS (
  SELECT customer_id, recency_days, frequency, monetary,
         CAST(6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS INTEGER) AS r_score,
         CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
         CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
  FROM x_rfm_base),
x_rfm AS (
  SELECT *, CAST(r_score + f_score + m_score AS INTEGER) AS rfm_score, {SQL_SEGMENT} AS rfm_segment
  FROM x_rfm_scored)"""


def _clv_ctes() -> str:
    rev = "CAST(total_revenue AS DOUBLE)"
    cnt = "CAST(order_count AS DOUBLE)"
    blended = sql_round(f"CAST(margin_total AS DOUBLE) / NULLIF({rev}, 0)", 4)
    value = f"({rev} / {cnt}) * ({cnt} / dataset_span_months)"
    return SPAN + f""",
x_clv_base AS (
  SELECT o.customer_id, count(DISTINCT o.invoice_no) AS order_count,
         sum(i.line_total) AS total_revenue,
         sum(i.line_total * m.gross_margin_pct) AS margin_total
  FROM x_completed o JOIN x_items i ON o.invoice_no = i.invoice_no
  JOIN x_products p ON i.stock_code = p.stock_code
  JOIN x_margins m ON p.category = m.category
  GROUP BY o.customer_id),
x_clv_scored AS (
  SELECT customer_id,
    {sql_round_money(f'{rev} / {cnt}')} AS avg_order_value,
    {sql_round_money(f'{cnt} / dataset_span_months', 12, 4)} AS purchase_freq_monthly,
    {sql_round_money(f'1.0 - 1.0 / {cnt}', 5, 4)} AS churn_rate,
    CAST({blended} AS DECIMAL(5,4)) AS gross_margin_pct,
    {sql_round_money(f'{value} * 12 * {blended}')} AS clv_12m,
    {sql_round_money(f'{value} * 36 * {blended}')} AS clv_36m
  FROM x_clv_base, x_span),
x_clv_tiled AS (
  SELECT *, ntile(3) OVER (ORDER BY clv_12m ASC NULLS FIRST, customer_id) AS tile FROM x_clv_scored),
x_clv AS (
  SELECT customer_id, avg_order_value, purchase_freq_monthly, churn_rate, gross_margin_pct,
         clv_12m, clv_36m, CASE tile WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END AS clv_segment
  FROM x_clv_tiled)"""


def np_round_sql(expr: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def days_between_sql(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def _notebook_ctes() -> str:
    k = 5
    aov = np_round_sql("CAST(monetary AS DOUBLE) / frequency", 2)
    pfm = np_round_sql("frequency / months", 6)
    margin = ("CASE WHEN CAST(monetary AS DOUBLE) > 0 THEN CAST(margin_total AS DOUBLE) / "
              "CAST(monetary AS DOUBLE) ELSE 0.48 END")
    tier = qcut_bins("cr", "n", 3)
    return f"""
x_nb_lines AS (
  SELECT o.invoice_no, o.customer_id, o.invoice_date, o.country, i.line_total, i.quantity,
         i.unit_price, i.stock_code, p.description AS product_name, p.category,
         COALESCE(m.gross_margin_pct, CAST(0.48 AS DECIMAL(5,4))) AS margin_pct
  FROM x_items i JOIN x_completed o ON i.invoice_no = o.invoice_no
  LEFT JOIN x_products p ON i.stock_code = p.stock_code
  LEFT JOIN x_margins m ON p.category = m.category),
x_nb_cust AS (
  SELECT customer_id, max(invoice_date) AS last_purchase, min(invoice_date) AS first_purchase,
         count(DISTINCT invoice_no) AS frequency, sum(line_total) AS monetary,
         sum(line_total * margin_pct) AS margin_total,
         arg_min(country, invoice_date) AS country
  FROM x_nb_lines GROUP BY customer_id),
x_nb_span AS (
  SELECT max(last_purchase) + INTERVAL 1 DAY AS snap,
         {days_between_sql('max(last_purchase)', 'min(first_purchase)')} / 30.5 AS months
  FROM x_nb_cust),
x_nb_scored AS (
  SELECT customer_id, country,
    CAST(first_purchase AS DATE) AS first_purchase_date,
    CAST(last_purchase AS DATE) AS last_purchase_date,
    CAST({days_between_sql('snap', 'last_purchase')} AS INTEGER) AS recency_days,
    CAST(frequency AS INTEGER) AS frequency,
    CAST(monetary AS DECIMAL(18,2)) AS monetary,
    {aov} AS avg_order_value, {pfm} AS purchase_freq_monthly,
    {margin} AS gross_margin_pct,
    {np_round_sql('1.0 - 1.0 / GREATEST(CAST(frequency AS DOUBLE), 1.0)', 6)} AS churn_rate,
    {np_round_sql(f'{aov} * {pfm} * 12 * ({margin})', 2)} AS clv_12m
  FROM x_nb_cust, x_nb_span),
x_nb_ranked AS (
  SELECT *,
    row_number() OVER (ORDER BY recency_days, customer_id) AS rr,
    row_number() OVER (ORDER BY frequency, customer_id) AS fr,
    row_number() OVER (ORDER BY monetary, customer_id) AS mr,
    row_number() OVER (ORDER BY clv_12m, customer_id) AS cr,
    count(*) OVER () AS n
  FROM x_nb_scored),
x_nb_tiles AS (
  SELECT *,
    CAST({k + 1} - {qcut_bins('rr', 'n', k)} AS INTEGER) AS r_score,
    {qcut_bins('fr', 'n', k)} AS f_score,
    {qcut_bins('mr', 'n', k)} AS m_score,
    {np_round_sql('clv_12m * 3', 2)} AS clv_36m,
    CASE WHEN {tier} = 1 THEN 'Low' WHEN {tier} = 2 THEN 'Medium' ELSE 'High' END AS clv_segment
  FROM x_nb_ranked),
x_master AS (
  SELECT *, CAST(r_score + f_score + m_score AS INTEGER) AS rfm_score,
         {NOTEBOOK_SEGMENT} AS rfm_segment
  FROM x_nb_tiles)"""


RFM_COLS = ("customer_id, recency_days, frequency, monetary, r_score, f_score, m_score, "
            "rfm_score, rfm_segment")
CLV_COLS = ("customer_id, avg_order_value, purchase_freq_monthly, churn_rate, gross_margin_pct, "
            "clv_12m, clv_36m, clv_segment")


def score_sql() -> dict[str, str]:
    rfm = _rfm_ctes()
    clv = _clv_ctes()
    nb = _notebook_ctes()
    return {
        "snapshot_date": with_adapter(SNAPSHOT.strip() + "\nSELECT snapshot_date FROM x_snapshot"),
        "dataset_span_months": with_adapter(SPAN.strip() + "\nSELECT dataset_span_months FROM x_span"),
        "rfm_scores": with_adapter(rfm + f"\nSELECT {RFM_COLS} FROM x_rfm"),
        "clv_scores": with_adapter(clv + f"\nSELECT {CLV_COLS} FROM x_clv"),
        "rfm_scores_notebook": with_adapter(nb + f"\nSELECT {RFM_COLS} FROM x_master"),
        "customer_clv_master": with_adapter(
            nb + "\nSELECT customer_id, country, first_purchase_date, last_purchase_date, rfm_segment, "
            "r_score, f_score, m_score, rfm_score, recency_days, frequency, monetary, avg_order_value, "
            f"purchase_freq_monthly, {sql_round('gross_margin_pct', 6)} AS gross_margin_pct, churn_rate, "
            "clv_12m, clv_36m, clv_segment FROM x_master"),
        "clv_scores_notebook": with_adapter(
            nb + "\nSELECT customer_id, avg_order_value, purchase_freq_monthly, churn_rate, "
            f"{sql_round('gross_margin_pct', 6)} AS gross_margin_pct, clv_12m, clv_36m, clv_segment "
            "FROM x_master"),
    }


def rfm_ctes() -> str:
    return _rfm_ctes()


def upsert_sql() -> str:
    old = (_rfm_ctes().replace("x_completed", "x_old_o").replace("x_rfm", "x_rfm_old")
           .replace("x_snapshot", "x_snapshot_old"))
    cut = ("CAST(CAST(min(invoice_date) AS DATE) + CAST(floor(date_diff('day', CAST(min(invoice_date) AS DATE), "
           "CAST(max(invoice_date) AS DATE)) / 2) AS INTEGER) AS DATE)")
    return with_adapter(f"""
x_cut AS (SELECT {cut} AS cutoff FROM x_completed),
x_old_o AS (SELECT * FROM x_completed WHERE CAST(invoice_date AS DATE) <= (SELECT cutoff FROM x_cut)),
x_later AS (SELECT DISTINCT customer_id FROM x_completed WHERE CAST(invoice_date AS DATE) > (SELECT cutoff FROM x_cut)),
{old.strip()},
{_rfm_ctes().strip()},
x_new AS (SELECT * FROM x_rfm WHERE customer_id IN (SELECT customer_id FROM x_later))
SELECT {RFM_COLS} FROM x_new
UNION ALL
SELECT {RFM_COLS} FROM x_rfm_old WHERE customer_id NOT IN (SELECT customer_id FROM x_new)""")


def clv_ctes() -> str:
    return _clv_ctes()


def notebook_ctes() -> str:
    return _notebook_ctes()


def all_oracle_sql() -> dict[str, str]:
    from patronage.plans import oracle_cleaning, oracle_explore, oracle_serving
    out = score_sql()
    out["score_upsert"] = upsert_sql()
    out.update(oracle_explore.explore_sql())
    out.update(oracle_serving.serving_sql())
    out.update(oracle_cleaning.cleaning_sql())
    return out


__all__ = ["adapter_ctes", "with_adapter", "score_sql", "all_oracle_sql", "np_round_sql",
           "days_between_sql"]
