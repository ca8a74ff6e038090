"""Ingest audit, cleaning and normalisation of raw invoice lines.

Everything here is single-pass over the raw lines: the audit and the
cleaning waterfall are one global aggregate each (partial per task, one
tiny final merge). "First row by staging order" keeps one row per key and
task before the shuffle, and the modal description/category are derived from
one (stock_code, description) count table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.rules import category_col, non_merch_col
from patronage.operators.rank import checkpointed, number_rows
from patronage.plans.scores import np_round
from patronage.sources.tables import Tables

# FIXED VALUES: audit rule labels and waterfall step labels.
AUDIT_RULES = (
    "Total raw rows",
    "Null CustomerID",
    "Cancelled invoices (InvoiceNo starts C)",
    "Zero or negative UnitPrice",
    "Non-merchandise StockCodes",
    "Zero or negative Quantity",
)
WATERFALL_STEPS = (
    "Starting rows",
    "After removing non-merchandise",
    "After removing cancellations",
    "After removing null CustomerID",
    "After removing bad UnitPrice",
    "After removing bad Quantity",
)

CLEAN_COLUMNS = ["invoice_no", "stock_code", "description", "quantity", "invoice_date",
                 "unit_price", "customer_id", "country", "category"]


def _strip(col: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def _rule_flags(raw: DataFrame) -> dict[str, Column]:
    """The five exclusion rules, in waterfall order, as NULL-safe booleans."""
    return {
        "non_merch": F.coalesce(non_merch_col(F.col("StockCode")), F.lit(False)),
        "cancelled": F.coalesce(F.col("InvoiceNo").startswith(config.CANCEL_PREFIX), F.lit(False)),
        "no_customer": F.col("CustomerID").isNull(),
        "bad_price": ~F.coalesce(F.col("UnitPrice") > 0, F.lit(False)),
        "bad_quantity": ~F.coalesce(F.col("Quantity") > 0, F.lit(False)),
    }


def quality_audit(t: Tables) -> DataFrame:
    """Q-20: independent count of raw rows failing each rule (one pass)."""
    raw = t.raw_transactions()
    f = _rule_flags(raw)
    counts = raw.agg(
        F.count(F.lit(1)).alias("c0"),
        F.count_if(f["no_customer"]).alias("c1"),
        F.count_if(F.col("InvoiceNo").startswith(config.CANCEL_PREFIX)).alias("c2"),
        F.count_if(F.col("UnitPrice") <= 0).alias("c3"),
        F.count_if(f["non_merch"]).alias("c4"),
        F.count_if(F.col("Quantity") <= 0).alias("c5"))
    pairs = ", ".join(f"'{label}', c{i}" for i, label in enumerate(AUDIT_RULES))
    return counts.select(F.expr(f"stack({len(AUDIT_RULES)}, {pairs}) AS (exclusion_rule, row_count)"))


def cleaning_waterfall(t: Tables) -> DataFrame:
    """Q-21: rows remaining after each ordered cleaning step (one pass: each
    row is charged to the first rule it fails)."""
    raw = t.raw_transactions()
    flags = list(_rule_flags(raw).values())
    first_fail = F.lit(0)
    for i in range(len(flags), 0, -1):
        first_fail = F.when(flags[i - 1], F.lit(i)).otherwise(first_fail)
    tagged = raw.select(first_fail.alias("step"))
    counts = tagged.agg(F.count(F.lit(1)).alias("total"),
                        *[F.count_if(F.col("step") == i).alias(f"r{i}") for i in range(1, 6)])
    rows = []
    for i, label in enumerate(WATERFALL_STEPS):
        removed = "0" if i == 0 else f"r{i}"
        remaining = "total" + "".join(f" - r{j}" for j in range(1, i + 1))
        rows.append(f"{i}, '{label}', CAST({removed} AS BIGINT), CAST({remaining} AS BIGINT)")
    return counts.select(F.expr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (step_no, step, rows_removed, rows_remaining)"))


def clean_lines_with_seq(t: Tables) -> DataFrame:
    """Cleaned, renamed, categorised lines, keeping the staging key ``_seq``."""
    raw = t.raw_transactions()
    f = _rule_flags(raw)
    keep = ~(f["non_merch"] | f["cancelled"] | f["no_customer"] | f["bad_price"] | f["bad_quantity"])
    desc = F.upper(_strip(F.col("Description")))
    return raw.where(keep).select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        desc.alias("description"),
        F.col("Quantity").alias("quantity"),
        F.col("InvoiceDate").alias("invoice_date"),
        F.col("UnitPrice").alias("unit_price"),
        _strip(F.col("CustomerID")).alias("customer_id"),
        F.col("Country").alias("country"),
        category_col(desc, t.category_rules).alias("category"),
        "_seq")


def clean_lines(t: Tables) -> DataFrame:
    """Q-22."""
    return clean_lines_with_seq(t).select(*CLEAN_COLUMNS)


def category_distribution(t: Tables) -> DataFrame:
    """Q-23: lines per derived category."""
    return clean_lines_with_seq(t).groupBy("category").agg(F.count(F.lit(1)).alias("line_count"))


def _first_lines(lines: DataFrame, key: str, columns: list[str], keep=None) -> DataFrame:
    """Per ``key`` the ``columns`` of its first line in staging order. Spark
    keeps only a key's first line in each task before the shuffle (window group
    limit), so a key with very many lines doesn't meet in one task."""
    if keep is not None:
        lines = lines.where(keep)
    parts = [f.name for f in lines.schema["_seq"].dataType.fields]
    flat = lines.select(key, *columns, *[F.col(f"_seq.{p}").alias(f"_p{i}") for i, p in enumerate(parts)])
    ordered = F.row_number().over(Window.partitionBy(key).orderBy(*[f"_p{i}" for i in range(len(parts))]))
    return flat.withColumn("_nth", ordered).where("_nth = 1").select(key, *columns)


def customers_from(lines: DataFrame) -> DataFrame:
    span = lines.groupBy("customer_id").agg(
        F.to_date(F.min("invoice_date")).alias("first_purchase_date"),
        F.to_date(F.max("invoice_date")).alias("last_purchase_date"))
    first = _first_lines(lines, "customer_id", ["country"], F.col("country").isNotNull())
    return span.join(first, "customer_id", "left").select(
        "customer_id", "country", "first_purchase_date", "last_purchase_date", F.lit(True).alias("is_active"))


def customers_dim(t: Tables) -> DataFrame:
    """Q-24: one row per customer — first country (staging order), first and
    last purchase date, active flag."""
    return customers_from(clean_lines_with_seq(t))


def _modal(counts: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """Most frequent ``value`` per ``key`` from a (key, value, weight) table;
    ties go to the smallest value. Two-phase, so a heavy key is never
    collected: the count table has one row per distinct (key, value)."""
    return counts.groupBy(key).agg(
        F.min_by(value, F.struct(-F.col(weight), F.col(value))).alias(value))


def products_dim(t: Tables) -> DataFrame:
    """Q-25: one row per stock code — modal description, modal category,
    mean unit price rounded to 2 places."""
    return products_from(clean_lines_with_seq(t), t.category_rules)


def products_from(lines: DataFrame, category_rules) -> DataFrame:
    return products_of(product_parts(lines), category_rules)


def product_parts(lines: DataFrame) -> DataFrame:
    """What products are made of, additive over loads: lines and price sum of
    each (stock code, description)."""
    return lines.groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("n"), F.sum("unit_price").alias("price_sum"))


def products_of(parts: DataFrame, category_rules) -> DataFrame:
    # one row per distinct (stock_code, description): far smaller than the lines,
    # read by three aggregates below, so it is materialised once
    per_desc = checkpointed(parts.select("stock_code", "description", "n", "price_sum"))
    per_desc = per_desc.withColumn("category", category_col("description", category_rules))
    desc_mode = _modal(per_desc.where(F.col("description").isNotNull()), "stock_code",
                       "description", "n")
    cat_counts = per_desc.groupBy("stock_code", "category").agg(F.sum("n").alias("n"))
    cat_mode = _modal(cat_counts, "stock_code", "category", "n")
    price = per_desc.groupBy("stock_code").agg(
        (F.sum("price_sum").cast("double") / F.sum("n")).alias("mean_price"))
    return (price.join(desc_mode, "stock_code", "left").join(cat_mode, "stock_code")
            .select("stock_code", "description", "category",
                    np_round(F.col("mean_price"), 2).cast("decimal(10,2)").alias("avg_unit_price")))


def orders_from(lines: DataFrame) -> DataFrame:
    return _first_lines(lines, "invoice_no", ["customer_id", "invoice_date", "country"]).withColumn(
        "order_status", F.lit("Completed"))


def orders_dim(t: Tables) -> DataFrame:
    """Q-26: one row per invoice, taken from its first line in staging order."""
    return orders_from(clean_lines_with_seq(t))


def order_items_clean(t: Tables) -> DataFrame:
    """Q-27: order lines with a consecutive ``item_id`` in staging order and the
    unit price narrowed to 2 places (half-up) before the stored line_total =
    quantity x unit_price is generated."""
    return order_items_from(clean_lines_with_seq(t))


def order_items_from(lines: DataFrame) -> DataFrame:
    price = F.round(F.col("unit_price"), 2).cast("decimal(10,2)")
    lines = lines.select(
        "invoice_no", "stock_code", "quantity", price.alias("unit_price"),
        (F.col("quantity").cast("decimal(10,0)") * price).cast("decimal(14,2)").alias("line_total"), "_seq")
    return number_rows(lines, [F.col("_seq")], "item_id").select(
        "item_id", "invoice_no", "stock_code", "quantity", "unit_price", "line_total")


def table_counts(t: Tables) -> DataFrame:
    """Q-40: row count of each normalised table built from the clean lines:
    invoices and customers from the (invoice, customer) pairs, products from
    their distinct codes. Keys are reduced in the tasks that read the lines."""
    lines = clean_lines_with_seq(t)
    pairs = checkpointed(lines.groupBy("invoice_no", "customer_id").agg(F.count(F.lit(1)).alias("n")))

    def distinct(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(key).distinct().agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")

    items = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(F.lit("order_items").alias("table_name"), "row_count")
    return (items.unionByName(distinct(pairs, "customer_id", "customers")).unionByName(distinct(pairs, "invoice_no", "orders"))
            .unionByName(distinct(lines, "stock_code", "products")))


def staging_counts(t: Tables) -> DataFrame:
    """Q-44: rows / distinct customers / distinct invoices for the staging
    table and for the completed order lines used by the analyses."""
    keys = checkpointed(t.raw_transactions().groupBy("CustomerID", "InvoiceNo").agg(F.count(F.lit(1)).alias("n")))
    count = lambda c: keys.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1)).alias(c))
    # one-row frames
    raw = (keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).crossJoin(count("CustomerID")).crossJoin(count("InvoiceNo"))
           .select(F.lit("raw_transactions").alias("stage"), "row_count", F.col("CustomerID").alias("customers"),
                   F.col("InvoiceNo").alias("invoices")))
    inv = t.order_items().groupBy("invoice_no").agg(F.count(F.lit(1)).alias("lines"))
    done = t.completed_orders().select("invoice_no", "customer_id").join(inv, "invoice_no")
    lines = done.agg(
        F.lit("completed_lines").alias("stage"), F.sum("lines").alias("row_count"),
        F.count_distinct("customer_id").alias("customers"),
        F.count(F.lit(1)).alias("invoices"))
    return raw.unionByName(lines)


#: NOT NULL columns of each table, as the source schema declares them.
NOT_NULL = {
    "raw_transactions": ("InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice", "Country"),
    "category_margin_assumptions": ("category", "gross_margin_pct"),
    "customers": ("customer_id", "country", "first_purchase_date", "last_purchase_date", "is_active"),
    "products": ("stock_code", "description", "category", "avg_unit_price"),
    "orders": ("invoice_no", "customer_id", "invoice_date", "country", "order_status"),
    "order_items": ("invoice_no", "stock_code", "quantity", "unit_price"),
    "rfm_scores": ("customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score", "rfm_segment"),
    "clv_scores": ("customer_id", "avg_order_value", "purchase_freq_monthly", "churn_rate", "gross_margin_pct", "clv_12m",
                   "clv_36m", "clv_segment"),
}


def _null_counts(table: str, df: DataFrame) -> DataFrame:
    """One row per NOT NULL column, from one pass over the table."""
    columns = NOT_NULL[table]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f"{table}.nn_{c.lower()}").alias("constraint_name"), F.col(c).alias("violations")) for c in columns])))


def _duplicate_rows(name: str, counts: DataFrame) -> DataFrame:
    """Rows whose key has several; ``counts``: n per key."""
    return counts.where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("constraint_name"), "violations")


def _orphans(name: str, counts: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose key isn't in the parent (NULL keys included); ``counts``: n per key."""
    parent = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return counts.join(parent, key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("constraint_name"), "violations")


def _per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def constraint_violations(t: Tables) -> DataFrame:
    """Q-41: primary-key, foreign-key and NOT NULL violations of the whole
    schema as a report (Spark does not enforce constraints). NULLs are counted
    in one pass per table; keys are reduced to one row each before they meet
    their parents, so the lines are read twice."""
    orders, products, customers, margins = t.orders(with_country=True), t.products(), t.customers(), t.margins()
    items = t.order_items()
    item_nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL["order_items"][1:]]
    per_invoice = checkpointed(items.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("n"), *item_nulls))
    sums = per_invoice.agg(F.coalesce(F.sum(F.when(F.col("invoice_no").isNull(), F.col("n"))), F.lit(0)).alias("invoice_no"),
                           *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in NOT_NULL["order_items"][1:]])
    parts = [
        sums.select(F.inline(F.array(*[F.struct(F.lit(f"order_items.nn_{c}").alias("constraint_name"), F.col(c).alias("violations"))
                                       for c in NOT_NULL["order_items"]]))),
        _orphans("order_items.fk_invoice_no", per_invoice.select("invoice_no", "n"), "invoice_no", orders),
        _orphans("order_items.fk_stock_code", _per_key(items, "stock_code"), "stock_code", products),
        _duplicate_rows("orders.pk_invoice_no", _per_key(orders, "invoice_no")),
        _duplicate_rows("customers.pk_customer_id", _per_key(customers, "customer_id")),
        _duplicate_rows("products.pk_stock_code", _per_key(products, "stock_code")),
        _duplicate_rows("category_margin_assumptions.pk_category", _per_key(margins, "category")),
        _orphans("orders.fk_customer_id", _per_key(orders, "customer_id"), "customer_id", customers),
        _orphans("products.fk_category", _per_key(products, "category"), "category", margins),
        _null_counts("raw_transactions", t.raw_transactions()),
        *[_null_counts(n, df) for n, df in (("orders", orders), ("products", products), ("customers", customers),
                                            ("category_margin_assumptions", margins))],
    ]
    if "item_id" in items.columns:
        parts.append(_duplicate_rows("order_items.pk_item_id", _per_key(items, "item_id")))
    for name in ("rfm_scores", "clv_scores"):
        stored = t.stored(name)
        if stored is not None:
            per_customer = _per_key(stored, "customer_id")
            parts += [_null_counts(name, stored), _duplicate_rows(f"{name}.pk_customer_id", per_customer),
                      _orphans(f"{name}.fk_customer_id", per_customer, "customer_id", customers)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_staging(t: Tables) -> DataFrame:
    """S-02: the staging table with a consecutive surrogate ``id`` from 1 in
    staging order."""
    return number_rows(t.raw_transactions(), [F.col("_seq")], "id").select(
        "id", "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
        "UnitPrice", "CustomerID", "Country")
