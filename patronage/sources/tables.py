"""Logical retail tables.

The engine works on a star schema: ``orders`` (invoice header),
``order_items`` (fact), ``products``, ``customers``, ``margins``, and the raw
staging table of invoice lines. :class:`Tables` is the one place these are
produced; every query takes a ``Tables``.

``Tables.from_tpch`` maps the driver's TPC-H-style parquet tables onto that
schema (the mapping is the test-data adapter; the DuckDB twin of it lives in
``patronage.plans.oracle``). ``Tables.from_star`` wraps already normalised
tables (e.g. written by the cleaning job).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage import config
from patronage.functions.rounding import round_money
from patronage.functions.rules import category_col, lookup_col

MARGIN_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("gross_margin_pct", T.DecimalType(5, 4), False),
    T.StructField("notes", T.StringType(), True),
])

# Order of the raw staging ids on the adapter: a total order over whole
# lineitem rows (pairs of order key and line number repeat in the data).
RAW_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate")


BROADCAST_ROWS = 10_000  # a caller's lookup table of more rows isn't broadcast

# Layout of the driver's TPC-H-style tables. Reading with the schema given
# skips the footer-reading job that schema inference runs on every read.
SOURCE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


def margins_frame(spark: SparkSession) -> DataFrame:
    rows = [(c, Decimal(m), n) for c, m, n in config.CATEGORY_MARGINS]
    return spark.createDataFrame(rows, MARGIN_SCHEMA)


class Tables:
    """Accessors for the logical tables. All reads are lazy; Catalyst prunes
    columns and pushes filters down to the parquet scans."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, *,
                 category_rules=config.ADAPTER_CATEGORY_RULES, star: dict | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/") if sf_dir else None
        self.category_rules = category_rules
        self._star = star or {}
        self._order_filter = None

    def restrict_orders(self, fn) -> "Tables":
        """A view of the same tables whose ``orders()`` passes through ``fn``
        (e.g. an as-of cutoff for incremental score refreshes)."""
        other = Tables(self.spark, self.sf_dir, category_rules=self.category_rules, star=self._star)
        prev = self._order_filter
        other._order_filter = fn if prev is None else (lambda o: fn(prev(o)))
        return other

    def between(self, start: str, stop: str) -> "Tables":
        """A view of the same tables limited to orders from ``start`` to before
        ``stop`` (dates as ``yyyy-MM-dd``). Where orders are stored by month, only the
        months of the period are read, of the lines too."""
        def period(o: DataFrame) -> DataFrame:
            o = o.where((F.col("invoice_date") >= F.lit(start).cast("timestamp_ntz")) & (F.col("invoice_date") < F.lit(stop).cast("timestamp_ntz")))
            return o.where(F.col("invoice_month").between(start[:7], stop[:7])) if "invoice_month" in o.columns else o
        return self.restrict_orders(period)

    # -- construction ------------------------------------------------------
    @classmethod
    def from_tpch(cls, spark: SparkSession, sf_dir: str, **kw) -> "Tables":
        return cls(spark, sf_dir, **kw)

    @classmethod
    def from_star(cls, spark: SparkSession, *, orders: DataFrame | None = None,
                  order_items: DataFrame | None = None,
                  products: DataFrame | None = None, customers: DataFrame | None = None,
                  margins: DataFrame | None = None, raw: DataFrame | None = None,
                  rfm_scores: DataFrame | None = None, clv_scores: DataFrame | None = None, rollup=None,
                  category_rules=config.CATEGORY_RULES) -> "Tables":
        """Tables of a star schema. With stored score tables, views and BI
        queries read them instead of scoring the fact again; with a stored rollup
        (:mod:`patronage.plans.rollup`) the monthly and category reports read that."""
        star = {"orders": orders, "order_items": order_items, "products": products,
                "customers": customers, "margins": margins, "raw": raw,
                "rfm_scores": rfm_scores, "clv_scores": clv_scores, "rollup": rollup}
        return cls(spark, None, category_rules=category_rules, star=star)

    def source(self, name: str) -> DataFrame:
        if not hasattr(self, "_sources"):
            self._sources = {}
        if name not in self._sources:
            reader = self.spark.read
            if name in SOURCE_SCHEMAS:
                reader = reader.schema(SOURCE_SCHEMAS[name])
            self._sources[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    def stored(self, name: str) -> DataFrame | None:
        """A stored score table (``rfm_scores`` or ``clv_scores``) given to
        :meth:`from_star`; None if the scores are to be computed."""
        return None if self._order_filter else self._star.get(name)

    @property
    def rollup(self):
        """The stored rollup given to :meth:`from_star`; None for restricted orders."""
        return None if self._order_filter else self._star.get("rollup")

    # -- logical tables ----------------------------------------------------
    def margins(self) -> DataFrame:
        """category, gross_margin_pct, notes: a small table, broadcast in joins.
        A caller's table is so only if its size allows."""
        given = self._star.get("margins")
        if given is None:
            return F.broadcast(margins_frame(self.spark))  # 9 rows
        if not hasattr(self, "_margins_are_few"):
            self._margins_are_few = given.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        return F.broadcast(given) if self._margins_are_few else given

    def _customer_country(self) -> DataFrame:
        nation = self.source("nation").select("n_nationkey", "n_name")
        # nation is a fixed 25-row dimension.
        return (self.source("customer").select("c_custkey", "c_nationkey")
                .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country")))

    def orders(self, with_country: bool = False, status: str | None = None) -> DataFrame:
        """invoice_no, customer_id, invoice_date, order_status [, country];
        optionally only orders with the given status."""
        o = self._orders(with_country, status)
        return self._order_filter(o) if self._order_filter else o

    def _orders(self, with_country: bool, status_filter: str | None) -> DataFrame:
        if self._star.get("orders") is not None:
            o = self._star["orders"]
            if status_filter is not None:
                o = o.where(F.col("order_status") == status_filter)
            cols = ["invoice_no", "customer_id", "invoice_date", "order_status"]
            cols += ["invoice_month"] if "invoice_month" in o.columns else []  # the month that the lines are stored under
            return o.select(*cols, "country") if with_country else o.select(*cols)
        status = lookup_col("o_orderstatus", config.ADAPTER_STATUS, None)
        src = self.source("orders")
        if status_filter is not None:
            # filter on the stored code so the predicate reaches the parquet scan
            codes = [code for code, label in config.ADAPTER_STATUS if label == status_filter]
            src = src.where(F.col("o_orderstatus").isin(codes))
        o = src.select(
            F.col("o_orderkey").alias("invoice_no"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("invoice_date"),
            status.alias("order_status"))
        if not with_country:
            return o
        return o.join(self._customer_country(), "customer_id", "left")

    @property
    def country_is_customer_attribute(self) -> bool:
        """True when an order's country is its customer's country (the TPC-H
        adapter), so country can be joined at customer grain."""
        return self.sf_dir is not None

    def customer_countries(self) -> DataFrame:
        """customer_id -> country at customer grain (adapter only)."""
        return self._customer_country()

    def completed_orders(self, with_country: bool = False) -> DataFrame:
        return self.orders(with_country, status="Completed")

    def order_items(self) -> DataFrame:
        """invoice_no, stock_code, quantity, unit_price decimal(10,2), line_total decimal(14,2);
        a loaded star schema also has item_id."""
        items = self._star.get("order_items")
        if items is None:
            return self._adapter_items()
        if self._order_filter and "invoice_month" in items.columns and "invoice_month" in self._star["orders"].columns:
            # one row per month: whatever restricts the orders, the scan of the lines skips all other months
            months = F.broadcast(self.orders().select("invoice_month").distinct())
            return items.join(months, "invoice_month", "left_semi")
        return items

    def _adapter_items(self, *more) -> DataFrame:
        return self.source("lineitem").select(
            F.col("l_orderkey").alias("invoice_no"),
            F.col("l_partkey").alias("stock_code"),
            F.col("l_quantity").cast("int").alias("quantity"),
            round_money(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 10, 2)
            .alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(14,2)").alias("line_total"), *more)

    def order_items_in_order(self) -> DataFrame:
        """The adapter's order items with their load order (columns _o0, _o1, ...)."""
        order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(RAW_ORDER)]
        return self._adapter_items(*order)

    def products(self) -> DataFrame:
        """stock_code, description, category, avg_unit_price."""
        if self._star.get("products") is not None:
            return self._star["products"]
        return self.source("part").select(
            F.col("p_partkey").alias("stock_code"),
            F.upper(F.col("p_name")).alias("description"),
            category_col("upper(p_name)", self.category_rules).alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("avg_unit_price"))

    def customers(self) -> DataFrame:
        """customer_id, country, first/last_purchase_date (completed orders), is_active."""
        if self._star.get("customers") is not None:
            return self._star["customers"]
        span = (self.completed_orders().groupBy("customer_id")
                .agg(F.to_date(F.min("invoice_date")).alias("first_purchase_date"),
                     F.to_date(F.max("invoice_date")).alias("last_purchase_date")))
        return (self._customer_country().join(span, "customer_id", "left")
                .select("customer_id", "country", "first_purchase_date", "last_purchase_date",
                        F.lit(True).alias("is_active")))

    def raw_transactions(self) -> DataFrame:
        """Dirty invoice lines in the staging layout, plus ``_seq``: a struct that
        orders rows like the staging id (first-by-id = min over ``_seq``)."""
        if self._star.get("raw") is not None:
            raw = self._star["raw"]
            return raw if "_seq" in raw.columns else raw.withColumn("_seq", F.struct(F.col("id")))
        li = self.source("lineitem")
        o = self.source("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        part = self.source("part").select("p_partkey", "p_name")
        # country joins the order header (order grain) before the lines, so the
        # line fact is shuffled for two joins (order key, part key), not three
        headers = o.join(self._customer_country(), F.col("o_custkey") == F.col("customer_id"), "left")
        lines = (li.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
                 .join(part, F.col("l_partkey") == F.col("p_partkey"), "left"))
        key = F.col("l_partkey")
        code = (F.when(key % 50 == 0, F.lit("POST"))
                .when(key % 50 == 1, F.concat(F.lit("gift_"), key.cast("string")))
                .when(key % 50 == 2, F.concat(F.lit("DCGS"), key.cast("string")))
                .otherwise(key.cast("string")))
        qty = F.col("l_quantity").cast("int")
        price = round_money(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 10, 4)
        return lines.select(
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), F.col("o_orderkey").cast("string")))
            .otherwise(F.col("o_orderkey").cast("string")).alias("InvoiceNo"),
            code.alias("StockCode"),
            F.when(key % 41 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("Description"),
            F.when(F.col("l_returnflag") == "R", -qty).otherwise(qty).alias("Quantity"),
            F.timestamp_add("MINUTE", F.col("l_linenumber") * 37, F.col("o_orderdate")).alias("InvoiceDate"),
            F.when(F.col("l_tax") == 0, F.lit(0).cast("decimal(10,4)")).otherwise(price).alias("UnitPrice"),
            F.when(F.col("o_custkey") % 4 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("o_custkey").cast("string")).alias("CustomerID"),
            F.col("country").alias("Country"),
            F.struct(*[F.col(c) for c in RAW_ORDER]).alias("_seq"))
