"""One stored rollup of completed orders by month, country and category, with exact
distinct customers for every coarser group.

Sums and order counts of cells add up; distinct customers don't. So customers get dense numbers
from 1, and a cell holds its customers as bitmaps of 32,768 numbers each: the customers of
any union of cells are the bits of their bitmaps or-ed, bucket by bucket, and nothing
is a (group, customer) pair any more. An invoice has one month and one country but several categories,
so cells come in three grains, each complete in itself:

* ``all``: all lines of an invoice, whatever their category;
* ``matched``: its lines whose product and category margin exist;
* ``category``: its lines of one category (NULL without a product).

Only ``category`` cells can't be added over categories to count orders; the other two are there for that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.money import sum_money, sum_money_times_rate
from patronage.operators.manifest import Manifests
from patronage.operators.rank import checkpointed, number_rows
from patronage.plans import scores
from patronage.sources.tables import Tables

GRAINS = ("all", "matched", "category")
CELL = ["grain", "year_month", "country", "category"]
SUMS = ["orders", "lines", "units", "gross", "price_sum", "net", "net_default"]


class Rollup(NamedTuple):
    """``cells``: grain, year_month, country, category, and their sums; ``members``: the same
    key, bucket, bitmap; ``numbers``: customer_id and its number."""

    cells: DataFrame
    members: DataFrame
    numbers: DataFrame

    def sums(self, grain: str, by: Sequence[str]) -> DataFrame:
        """Orders and sums of the ``grain``, by some of year_month, country, category."""
        _check(grain, by)
        return self.cells.where(F.col("grain") == grain).groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])

    def customers(self, grain: str, by: Sequence[str]) -> DataFrame:
        """Distinct customers of the ``grain``, by some of year_month, country, category."""
        _check(grain, by)
        merged = self.members.where(F.col("grain") == grain).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("customers"))

    def groups(self, grain: str, by: Sequence[str]) -> DataFrame:
        """Both, one row per group; NULL is a group of its own."""
        sums, mine = self.sums(grain, by), self.customers(grain, by)
        other = mine.select(*[F.col(c).alias(f"_{c}") for c in by], "customers")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return sums.join(other, same, "left").select(*by, *SUMS, F.coalesce("customers", F.lit(0)).alias("customers"))


def _check(grain: str, by: Sequence[str]) -> None:
    if grain not in GRAINS or not set(by) <= set(CELL[1:]) or ("category" in by) and grain != "category":
        raise ValueError(f"no groups of {grain} by {list(by)}")
    if not by:
        raise ValueError("group by at least one of the cells' columns")


def _by_invoice(t: Tables) -> DataFrame:
    """Completed orders' lines summed per (invoice, category)."""
    rate = F.coalesce("gross_margin_pct", F.lit(config.DEFAULT_MARGIN).cast("decimal(5,4)"))
    lines = scores.line_margins(t, left=True).groupBy("invoice_no", "category", F.col("gross_margin_pct").isNotNull().alias("matched")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"), sum_money("line_total").alias("gross"),
        sum_money("unit_price").alias("price_sum"), sum_money_times_rate("line_total", "gross_margin_pct").alias("net"),
        sum_money_times_rate("line_total", rate).alias("net_default"))
    orders = t.completed_orders(with_country=True).select(
        "invoice_no", "customer_id", "country", F.date_format("invoice_date", "yyyy-MM").alias("year_month"))
    return orders.join(lines, "invoice_no")


def build(t: Tables) -> Rollup:
    """The rollup of ``t``, from one pass over the lines."""
    lines = checkpointed(_by_invoice(t))
    customers = lines.select("customer_id").where("customer_id IS NOT NULL").distinct()
    numbers = number_rows(customers, [F.col("customer_id")], "number").select("customer_id", "number")

    def cell(grain: str, category: Column) -> Column:
        return F.struct(F.lit(grain).alias("grain"), category.alias("category"))

    none = F.lit(None).cast("string")
    grains = F.array_compact(F.array(cell("all", none), F.when(F.col("matched"), cell("matched", none)), cell("category", F.col("category"))))
    # an invoice's lines lie together, so this sums where they are; an invoice counts once a cell
    per_invoice = lines.withColumn("_cell", F.explode(grains)).groupBy(
        "invoice_no", "_cell.grain", "_cell.category", "year_month", "country", "customer_id").agg(*[F.sum(c).alias(c) for c in SUMS[1:]])
    per_customer = checkpointed(per_invoice.groupBy(*CELL, "customer_id").agg(F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in SUMS[1:]]))
    members = (per_customer.join(numbers, "customer_id").groupBy(*CELL, F.bitmap_bucket_number("number").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")))
    cells = per_customer.groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in SUMS])
    return Rollup(checkpointed(cells), checkpointed(members), numbers)


def write(rollup: Rollup, root: str, facts: int | None = None) -> None:
    """Store a rollup as a new version under ``root``; readers of older ones go on.
    ``facts``: the version of the facts that it sums up."""
    spark = rollup.cells.sparkSession
    versions = Manifests(spark, f"{root.rstrip('/')}/_versions")
    number = versions.latest()[0] + 1
    folder = f"{number:06d}-{uuid.uuid4().hex[:8]}"
    for name, frame in rollup._asdict().items():
        frame.write.parquet(f"{root.rstrip('/')}/{folder}/{name}")
    versions.commit(number, {"folder": folder, "facts": facts})


def read(spark: SparkSession, root: str) -> Rollup:
    """The newest stored rollup."""
    _, manifest = Manifests(spark, f"{root.rstrip('/')}/_versions").latest()
    if manifest is None:
        raise ValueError(f"no rollup at {root}")
    return Rollup(*[spark.read.parquet(f"{root.rstrip('/')}/{manifest['folder']}/{name}") for name in Rollup._fields])


def facts_of(spark: SparkSession, root: str) -> int | None:
    """Version of the facts that the newest stored rollup sums up; None without one."""
    _, manifest = Manifests(spark, f"{root.rstrip('/')}/_versions").latest()
    return manifest["facts"] if manifest else None


def customer_reach(t: Tables) -> DataFrame:
    """Distinct customers, orders and gross revenue by month, by country and by
    category, all from one rollup."""
    stored = t.rollup if t.rollup is not None else build(t)
    out = None
    for dimension, grain in (("year_month", "all"), ("country", "all"), ("category", "category")):
        rows = stored.groups(grain, [dimension]).select(
            F.lit(dimension).alias("dimension"), F.col(dimension).alias("value"), F.col("customers").alias("unique_customers"),
            F.col("orders").alias("order_count"), F.col("gross").cast("decimal(18,2)").alias("gross_revenue"))
        out = rows if out is None else out.unionByName(rows)
    return out
