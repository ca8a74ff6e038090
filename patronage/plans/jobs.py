"""Load jobs: normalise cleaned lines into the star schema, persist the
score tables. Output folders come from the caller (a shared filesystem)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.keyed_table import KeyedTable
from patronage.operators.rank import checkpointed
from patronage.plans import cleaning, rollup, scores
from patronage.sources.star import StarStore
from patronage.sources.tables import Tables

SCORES = ("rfm_scores", "clv_scores")
ROLLUP = "revenue_rollup"
BUCKETS = 16  # of invoices; about as many as the lines have GB, at least the cluster's cores


def _month(date: str) -> F.Column:
    return F.date_format(date, "yyyy-MM").alias("invoice_month")


def _customers(parts: DataFrame) -> DataFrame:
    """Customers of all loads: first country, first and last date over them."""
    return parts.groupBy("customer_id").agg(
        F.min_by("country", F.when(F.col("country").isNotNull(), F.col("load"))).alias("country"),
        F.min("first_purchase_date").alias("first_purchase_date"), F.max("last_purchase_date").alias("last_purchase_date"),
        F.lit(True).alias("is_active"), F.min("created_at").alias("created_at"))


def build_star_schema(t: Tables, root: str, mode: str = "overwrite", buckets: int = BUCKETS, load_id: str | None = None) -> dict[str, str]:
    """S-05: load the cleaned lines into customers, products, orders,
    order_items (with ``item_id``) and the margin table under ``root``.

    ``mode="append"`` adds to what earlier loads stored, as if all lines had come in
    one load, the earlier ones first: item ids go on after the last one, an
    invoice keeps its first header, customers and products are those of all
    lines. ``overwrite`` starts anew; readers see the old tables until it is done. A ``load_id``
    that is stored already isn't loaded again. Two loads at once: the later one raises
    :class:`~patronage.operators.manifest.Conflict` and stores nothing.

    Returns the folders that hold this load's facts and the new small tables."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode is overwrite or append")
    store = StarStore(t.spark, root)
    number, manifest = store.manifest()
    done = next((x for x in manifest["loads"] if load_id is not None and x["id"] == load_id), None)
    if done:
        return _paths(store, manifest, done["folder"])
    earlier = manifest["loads"] if mode == "append" else []
    first_item = manifest["items"] if earlier else 0
    buckets = manifest["buckets"] if earlier else buckets
    load = f"{number + 1:06d}-{uuid.uuid4().hex[:8]}"
    folders = [x["folder"] for x in earlier] + [load]

    store.write_parts("clean_lines", cleaning.clean_lines_with_seq(t), load)
    lines = t.spark.read.parquet(f"{store.root}/clean_lines/load={load}")
    headers = cleaning.orders_from(lines)
    dates = headers.select("invoice_no", "invoice_date")
    if earlier:  # an invoice that is stored keeps its header, and its new lines its month
        stored = store.headers_of(dates).select("invoice_no", F.col("invoice_date").alias("stored_date"))
        dates = dates.join(stored, "invoice_no", "left").select("invoice_no", F.coalesce("stored_date", "invoice_date").alias("invoice_date"))
        headers = headers.join(stored, "invoice_no", "left_anti")
    schemas = {"orders": store.write_fact("orders", headers.select("*", _month("invoice_date")), load, buckets)}
    store.write_index(load, buckets)
    items = (cleaning.order_items_from(lines).join(dates.select("invoice_no", _month("invoice_date")), "invoice_no")
             .withColumn("item_id", F.col("item_id") + first_item))
    schemas["order_items"] = store.write_fact("order_items", items, load, buckets)

    store.write_parts("customer_parts", cleaning.customers_from(lines).withColumn("created_at", F.current_timestamp()), load)
    store.write_parts("product_parts", cleaning.product_parts(lines), load)
    products = store.parts("product_parts", folders).groupBy("stock_code", "description").agg(
        F.sum("n").alias("n"), F.sum("price_sum").alias("price_sum"))
    tables = {"customers": store.write_table("customers", _customers(store.parts("customer_parts", folders))),
              "products": store.write_table("products", cleaning.products_of(products, t.category_rules)),
              "category_margin_assumptions": store.write_table("category_margin_assumptions", t.margins())}
    new = {"loads": [*earlier, {"id": load_id or load, "folder": load, "indexed": True}], "buckets": buckets, "items": first_item + lines.count(), "tables": tables,
           "schemas": schemas}
    store.manifests.commit(number + 1, new)
    return _paths(store, new, load)


def _paths(store: StarStore, manifest: dict, load: str) -> dict[str, str]:
    facts = {name: f"{store.root}/{name}/load={load}" for name in ("clean_lines", "orders", "order_items")}
    return {**facts, **{name: f"{store.root}/{folder}" for name, folder in manifest["tables"].items()}}


def load_star_schema(spark, root: str, **options) -> Tables:
    """The tables that :func:`build_star_schema` stored, and the newest stored
    scores and rollup if :func:`persist_scores` and :func:`persist_rollup` wrote them under the same root. Facts are
    scans of invoice buckets: lines are summed per invoice and join their headers without a shuffle."""
    store = StarStore(spark, root)
    stored = {name: KeyedTable(spark, f"{store.root}/{name}") for name in SCORES}
    place = f"{store.root}/{ROLLUP}"
    if rollup.facts_of(spark, place) == store.manifest()[0]:  # one of earlier loads is left unread
        options = {"rollup": rollup.read(spark, place), **options}
    return Tables.from_star(
        spark, orders=store.fact("orders"), order_items=store.fact("order_items"), products=store.table("products"),
        customers=store.table("customers"), margins=store.table("category_margin_assumptions"),
        **{name: table.read() for name, table in stored.items() if table.version}, **options)


def append_violations(spark, root: str, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """V-04 on load: the rows of ready-made headers and lines that would break a constraint of
    the star schema stored under ``root``, before they are appended.

    Returns constraint_name, key (the offending key; NULL for a missing one) and n, its rows:
    invoices that are stored already or come twice, lines without a stored or
    new header, customers and products that aren't stored, and NULLs in columns that
    have none. A NULL key is reported as NULL, not as a missing parent. Stored headers are met through
    their index: files that can't hold a new invoice aren't read. No rows: the batch may be appended."""
    store = StarStore(spark, root)

    def counted(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("constraint_name"), "key", "n")

    headers, lines = checkpointed(counted(orders, "invoice_no")), checkpointed(counted(order_items, "invoice_no"))
    asked = headers.select("key").union(lines.select("key")).distinct()
    stored = checkpointed(store.headers_of(asked.select(F.col("key").alias("invoice_no"))).select(F.col("invoice_no").alias("key")).distinct())
    again = headers.join(stored.withColumn("there", F.lit(True)), "key", "left").where("there OR n > 1")
    parents = stored.union(headers.select("key"))
    parts = [named(again, "orders.pk_invoice_no"), named(lines.join(parents, "key", "left_anti"), "order_items.fk_invoice_no")]
    for rows, key, parent, name in ((orders, "customer_id", "customers", "orders.fk_customer_id"),
                                    (order_items, "stock_code", "products", "order_items.fk_stock_code")):
        known = store.table(parent).select(F.col(key).alias("key"))
        parts.append(named(counted(rows, key).join(known, "key", "left_anti"), name))
    for table, rows in (("orders", orders), ("order_items", order_items)):
        columns = [c for c in cleaning.NOT_NULL[table] if c in rows.columns]
        nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        parts.append(nulls.select(F.inline(F.array(*[
            F.struct(F.lit(f"{table}.nn_{c}").alias("constraint_name"), F.lit(None).cast("string").alias("key"), F.col(c).alias("n"))
            for c in columns]))).where("n > 0"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def persist_rollup(spark, root: str) -> str:
    """Sum up the loaded star schema by month, country and category, for the reports
    that read these sums. After another load it isn't read until it is made anew. Returns its root."""
    number = StarStore(spark, root).manifest()[0]
    place = f"{root.rstrip('/')}/{ROLLUP}"
    rollup.write(rollup.build(load_star_schema(spark, root)), place, facts=number)
    return place


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_at", F.current_timestamp())


def persist_scores(t: Tables, root: str, mode: str = "upsert") -> dict[str, str]:
    """S-06 / S-08 / S-12: write ``rfm_scores`` and ``clv_scores`` with an
    ``updated_at`` stamp as keyed tables under ``root``, either replacing the whole table or
    upserting by customer_id; both are new versions that
    :func:`load_star_schema` finds. Returns the tables' roots."""
    if mode not in ("upsert", "replace"):
        raise ValueError("mode is upsert or replace")
    both = scores.rfm_clv(t)
    out = {"rfm_scores": _stamped(both.select(*scores.RFM_COLUMNS)),
           "clv_scores": _stamped(both.where(F.col("clv_segment").isNotNull()).select(*scores.CLV_COLUMNS))}
    paths = {}
    for name, df in out.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        table = KeyedTable(t.spark, paths[name])
        (table.merge if mode == "upsert" else table.replace)(df, ["customer_id"])
    return paths
