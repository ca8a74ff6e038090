"""DuckDB twins of the ingest audit, cleaning and normalisation queries."""

from __future__ import annotations

from patronage import config
from patronage.plans.cleaning import AUDIT_RULES, WATERFALL_STEPS
from patronage.plans.oracle import category_case, np_round_sql, with_adapter

STRIP = r"'^\s+|\s+$'"


def _flags() -> dict[str, str]:
    codes = ", ".join(f"'{c}'" for c in config.NON_MERCH_CODES)
    heads = " OR ".join(f"substr(\"StockCode\", 1, {len(p)}) = '{p}'" for p in config.NON_MERCH_PREFIXES)
    return {
        "non_merch": f"COALESCE(\"StockCode\" IN ({codes}) OR {heads}, FALSE)",
        "cancelled": "COALESCE(starts_with(\"InvoiceNo\", 'C'), FALSE)",
        "no_customer": "\"CustomerID\" IS NULL",
        "bad_price": "NOT COALESCE(\"UnitPrice\" > 0, FALSE)",
        "bad_quantity": "NOT COALESCE(\"Quantity\" > 0, FALSE)",
    }


def clean_ctes(rules=config.ADAPTER_CATEGORY_RULES) -> str:
    f = _flags()
    drop = " OR ".join(f.values())
    desc = f"upper(regexp_replace(\"Description\", {STRIP}, '', 'g'))"
    return f"""
x_clean AS (
  SELECT id, "InvoiceNo" AS invoice_no, "StockCode" AS stock_code, {desc} AS description,
         "Quantity" AS quantity, "InvoiceDate" AS invoice_date, "UnitPrice" AS unit_price,
         regexp_replace("CustomerID", {STRIP}, '', 'g') AS customer_id, "Country" AS country,
         {category_case(desc, rules)} AS category
  FROM x_raw WHERE NOT ({drop}))"""


def _constraints() -> str:
    not_null = {  # fixed values: the source schema's NOT NULL columns
        ("raw_transactions", "x_raw"): ('"InvoiceNo"', '"StockCode"', '"Quantity"', '"InvoiceDate"', '"UnitPrice"', '"Country"'),
        ("category_margin_assumptions", "x_margins"): ("category", "gross_margin_pct"),
        ("customers", "x_customers"): ("customer_id", "country", "first_purchase_date", "last_purchase_date", "is_active"),
        ("products", "x_products"): ("stock_code", "description", "category", "avg_unit_price"),
        ("orders", "x_orders"): ("invoice_no", "customer_id", "invoice_date", "country", "order_status"),
        ("order_items", "x_items"): ("invoice_no", "stock_code", "quantity", "unit_price"),
    }
    keys = {("orders", "x_orders"): "invoice_no", ("customers", "x_customers"): "customer_id", ("products", "x_products"): "stock_code",
            ("category_margin_assumptions", "x_margins"): "category"}
    foreign = [("order_items", "x_items", "invoice_no", "x_orders"), ("order_items", "x_items", "stock_code", "x_products"),
               ("orders", "x_orders", "customer_id", "x_customers"), ("products", "x_products", "category", "x_margins")]
    rows = [f"SELECT '{t}.nn_{c.strip(chr(34)).lower()}' AS constraint_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {x}"
            for (t, x), columns in not_null.items() for c in columns]
    rows += [f"SELECT '{t}.pk_{k}', CAST(COALESCE(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {x} GROUP BY {k} HAVING count(*) > 1)"
             for (t, x), k in keys.items()]
    rows += [f"SELECT '{t}.fk_{k}', count(*) FROM {x} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{k} = c.{k})"
             for t, x, k, parent in foreign]
    return " UNION ALL ".join(rows)


def cleaning_sql() -> dict[str, str]:
    f = _flags()
    clean = clean_ctes()
    cat = category_case("description", config.ADAPTER_CATEGORY_RULES)
    audit_exprs = [
        "count(*)", f"count(*) FILTER (WHERE {f['no_customer']})",
        "count(*) FILTER (WHERE starts_with(\"InvoiceNo\", 'C'))",
        "count(*) FILTER (WHERE \"UnitPrice\" <= 0)",
        f"count(*) FILTER (WHERE {f['non_merch']})",
        "count(*) FILTER (WHERE \"Quantity\" <= 0)"]
    audit = " UNION ALL ".join(
        f"SELECT '{label}' AS exclusion_rule, (SELECT {e} FROM x_raw) AS row_count"
        for label, e in zip(AUDIT_RULES, audit_exprs))
    first_fail = "CASE " + " ".join(
        f"WHEN {cond} THEN {i}" for i, cond in enumerate(f.values(), start=1)) + " ELSE 0 END"
    steps = []
    for i, label in enumerate(WATERFALL_STEPS):
        removed = "0" if i == 0 else f"count(*) FILTER (WHERE step = {i})"
        remaining = f"count(*) FILTER (WHERE step = 0 OR step > {i})"
        steps.append(f"SELECT {i} AS step_no, '{label}' AS step, CAST({removed} AS BIGINT) AS rows_removed, "
                     f"CAST({remaining} AS BIGINT) AS rows_remaining FROM x_steps")
    mode = ("SELECT stock_code, {v} FROM (SELECT stock_code, {v}, row_number() OVER "
            "(PARTITION BY stock_code ORDER BY n DESC, {v}) AS rn FROM {src}) WHERE rn = 1")
    return {
        "quality_audit": with_adapter(audit),
        "cleaning_waterfall": with_adapter(
            f"x_steps AS (SELECT {first_fail} AS step FROM x_raw)\n" + " UNION ALL ".join(steps)),
        "clean_lines": with_adapter(clean + """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, category FROM x_clean"""),
        "category_distribution": with_adapter(
            clean + "\nSELECT category, count(*) AS line_count FROM x_clean GROUP BY category"),
        "customers_dim": with_adapter(clean + """
SELECT customer_id, arg_min(country, id) FILTER (WHERE country IS NOT NULL) AS country,
       CAST(min(invoice_date) AS DATE) AS first_purchase_date,
       CAST(max(invoice_date) AS DATE) AS last_purchase_date, TRUE AS is_active
FROM x_clean GROUP BY customer_id"""),
        "products_dim": with_adapter(clean + f""",
x_pd AS (SELECT stock_code, description, count(*) AS n, sum(unit_price) AS price_sum
         FROM x_clean GROUP BY 1, 2),
x_dm AS ({mode.format(v='description', src='x_pd WHERE description IS NOT NULL')}),
x_cc AS (SELECT stock_code, category, sum(n) AS n
         FROM (SELECT stock_code, {cat} AS category, n FROM x_pd) GROUP BY 1, 2),
x_cm AS ({mode.format(v='category', src='x_cc')}),
x_pp AS (SELECT stock_code, CAST(sum(price_sum) AS DOUBLE) / sum(n) AS mean_price
         FROM x_pd GROUP BY 1)
SELECT p.stock_code, d.description, c.category,
       CAST({np_round_sql('p.mean_price', 2)} AS DECIMAL(10,2)) AS avg_unit_price
FROM x_pp p LEFT JOIN x_dm d ON p.stock_code = d.stock_code
JOIN x_cm c ON p.stock_code = c.stock_code"""),
        "orders_dim": with_adapter(clean + """
SELECT invoice_no, customer_id, invoice_date, country, 'Completed' AS order_status
FROM (SELECT *, row_number() OVER (PARTITION BY invoice_no ORDER BY id) AS rn FROM x_clean)
WHERE rn = 1"""),
        "order_items": with_adapter(clean + """
SELECT row_number() OVER (ORDER BY id) AS item_id, invoice_no, stock_code, quantity, CAST(round(unit_price, 2) AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(quantity AS DECIMAL(10,0)) * CAST(round(unit_price, 2) AS DECIMAL(10,2))
            AS DECIMAL(14,2)) AS line_total
FROM x_clean"""),
        "table_counts": with_adapter(clean + """
SELECT 'customers' AS table_name, count(DISTINCT customer_id) AS row_count FROM x_clean
UNION ALL SELECT 'products', count(DISTINCT stock_code) FROM x_clean
UNION ALL SELECT 'orders', count(DISTINCT invoice_no) FROM x_clean
UNION ALL SELECT 'order_items', count(*) FROM x_clean"""),
        "staging_counts": with_adapter("""
SELECT 'raw_transactions' AS stage, count(*) AS row_count,
       count(DISTINCT "CustomerID") AS customers, count(DISTINCT "InvoiceNo") AS invoices
FROM x_raw
UNION ALL
SELECT 'completed_lines', count(*), count(DISTINCT o.customer_id), count(DISTINCT o.invoice_no)
FROM x_completed o JOIN x_items i ON o.invoice_no = i.invoice_no"""),
        "constraint_violations": with_adapter(_constraints()),
        "raw_staging": with_adapter("""
SELECT id, "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
       "CustomerID", "Country" FROM x_raw"""),
    }
