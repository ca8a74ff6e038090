"""Additive customer state: what scores need of a customer's orders, summed by month.

A partial row holds counts, money and dates of a customer's completed orders in
one period. Partials of two sets of orders add up to those of both, so scores of any
union come from stored partials without reading the lines again.

:class:`CustomerState` keeps them: a batch of new orders and lines adds its partials. The
order of batches doesn't matter, and one that is sent twice counts once. An
invoice is counted once though its lines come in several batches: a register holds the
invoices (not their lines) and whether they had lines, with and without a margin.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.money import sum_money, sum_money_times_rate
from patronage.functions.rounding import round_half_up
from patronage.operators.manifest import Conflict, Manifests, delete, path_of
from patronage.operators.rank import checkpointed
from patronage.plans import scores
from patronage.sources.tables import Tables

ATTEMPTS = 10  # of a commit
FOLD = 16      # stored parts at which they are folded into one


def invoice_state(t: Tables, clv: bool = True) -> DataFrame:
    """Completed orders with the sums of their lines (NULL sums and 0 lines if
    there are none). ``clv=False`` leaves out what needs products and margins."""
    lines = scores.line_margins(t, left=True) if clv else t.order_items()
    matched = F.col("gross_margin_pct").isNotNull()
    inv = lines.groupBy("invoice_no").agg(
        sum_money("line_total").alias("inv_total"), F.count(F.lit(1)).alias("lines"),
        *([sum_money(F.when(matched, F.col("line_total"))).alias("clv_total"),
           sum_money_times_rate("line_total", "gross_margin_pct").alias("clv_sum"),
           F.count_if(matched).alias("clv_lines")] if clv else
          [F.lit(None).cast("decimal(38,2)").alias("clv_total"), F.lit(None).cast("decimal(38,6)").alias("clv_sum"),
           F.lit(0).cast("bigint").alias("clv_lines")]))
    orders = t.completed_orders().select("invoice_no", "customer_id", "invoice_date")
    return orders.join(inv, "invoice_no", "left").withColumns(
        {"lines": F.coalesce("lines", F.lit(0)), "clv_lines": F.coalesce("clv_lines", F.lit(0))})


def partials(invoices: DataFrame, period: Column, counts: Column | None = None, clv_counts: Column | None = None) -> DataFrame:
    """One row per (customer, ``period``). ``counts`` and ``clv_counts``: is the
    invoice to be counted (by default one with lines, and with lines that have a margin)."""
    counts = F.col("lines") > 0 if counts is None else counts
    clv_counts = F.col("clv_lines") > 0 if clv_counts is None else clv_counts
    return invoices.groupBy("customer_id", period.alias("period")).agg(
        F.count_if(counts).alias("orders"),
        F.max(F.when(F.col("lines") > 0, F.to_date("invoice_date"))).alias("last_date"),
        F.sum("inv_total").alias("monetary"),
        F.count_if(clv_counts).alias("clv_orders"),
        F.sum("clv_total").alias("clv_revenue"),
        F.sum("clv_sum").alias("clv_margin"),
        F.min("invoice_date").alias("first_seen"), F.max("invoice_date").alias("last_seen"))


def added_up(parts: DataFrame, *keys: str) -> DataFrame:
    """Partials of the same ``keys`` added up."""
    return parts.groupBy(*keys).agg(
        F.sum("orders").alias("orders"), F.max("last_date").alias("last_date"), F.sum("monetary").alias("monetary"),
        F.sum("clv_orders").alias("clv_orders"), F.sum("clv_revenue").alias("clv_revenue"), F.sum("clv_margin").alias("clv_margin"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def rfm_base(parts: DataFrame) -> DataFrame:
    """RFM inputs per customer; the day after the last order is the snapshot."""
    snap = parts.agg(F.date_add(F.to_date(F.max("last_seen")), 1).alias("snapshot_date"))  # one row
    return (added_up(parts, "customer_id").where("orders > 0").crossJoin(F.broadcast(snap))
            .select("customer_id", F.datediff("snapshot_date", "last_date").cast("int").alias("recency_days"),
                    F.col("orders").cast("int").alias("frequency"), F.col("monetary").cast("decimal(18,2)").alias("monetary")))


def rfm_base_of_two(parts: DataFrame) -> DataFrame:
    """RFM inputs of two states in one row per customer, from partials whose ``period``
    says whether they came later: ``old_*`` without those, for the rows that are ``old``, and ``new_*``
    with them. ``active``: the customer has later orders."""
    def snapshot(rows: Column, name: str) -> Column:
        return F.date_add(F.to_date(F.max(F.when(rows, F.col("last_seen")))), 1).alias(name)

    early, late = ~F.col("period"), F.col("period")
    snap = parts.agg(snapshot(early, "_old_snapshot"), snapshot(F.lit(True), "_new_snapshot"))  # one row
    both = parts.groupBy("customer_id").agg(
        *[agg for era, rows in (("old_", early), ("new_", F.lit(True))) for agg in (
            F.coalesce(F.sum(F.when(rows, F.col("orders"))), F.lit(0)).alias(f"{era}orders"),
            F.max(F.when(rows, F.col("last_date"))).alias(f"{era}last"),
            F.sum(F.when(rows, F.col("monetary"))).cast("decimal(18,2)").alias(f"{era}monetary"))],
        F.coalesce(F.bool_or(late), F.lit(False)).alias("active"))
    return both.where("new_orders > 0").crossJoin(F.broadcast(snap)).select(
        "customer_id", "active", (F.col("old_orders") > 0).alias("old"),
        *[c for era in ("old_", "new_") for c in (
            F.datediff(f"_{era}snapshot", f"{era}last").cast("int").alias(f"{era}recency_days"),
            F.col(f"{era}orders").cast("int").alias(f"{era}frequency"), F.col(f"{era}monetary"))])


def clv_base(parts: DataFrame) -> DataFrame:
    """CLV inputs per customer with orders of lines that have a margin."""
    days = F.datediff(F.max("last_seen"), F.min("first_seen"))
    span = parts.agg(round_half_up(days / config.DAYS_PER_MONTH, 2).alias("dataset_span_months"))  # one row
    return (added_up(parts, "customer_id").where("clv_orders > 0").crossJoin(F.broadcast(span))
            .select("customer_id", F.col("clv_orders").alias("order_count"), F.col("clv_revenue").alias("total_revenue"),
                    F.col("clv_margin").alias("margin_total"), "dataset_span_months"))


class CustomerState:
    """Stored partials under ``root`` (a folder that driver and executors share).
    A version is a manifest that names the batches added and the folders that hold
    their partials and invoices; folders aren't changed once written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, f"{self.root}/_versions")

    def add(self, t: Tables, batch: str) -> bool:
        """Add the completed orders of ``t`` and their lines; False if ``batch`` was
        added before. Lines come with the header of their invoice, which has the same customer
        and date in every batch (otherwise ValueError). Margins are those of ``t``."""
        invoices = None
        for _ in range(ATTEMPTS):
            number, base = self.manifests.latest()
            base = base or {"batches": [], "parts": [], "invoices": []}
            if batch in base["batches"]:
                return False
            if invoices is None:
                invoices = checkpointed(invoice_state(t))
            folder = uuid.uuid4().hex
            parts, register = self._delta(invoices, base)
            new = {"batches": [*base["batches"], batch],
                   "parts": self._stored("parts", folder, parts, base["parts"]),
                   "invoices": self._stored("invoices", folder, register, base["invoices"])}
            try:
                self.manifests.commit(number + 1, new)
                return True
            except Conflict:
                continue  # the other batch may hold some of the same invoices
        raise Conflict(f"{self.root}: other writers were faster {ATTEMPTS} times")

    def _delta(self, invoices: DataFrame, base: dict) -> tuple[DataFrame, DataFrame]:
        """The batch's partials, and its invoices for the register."""
        month = F.date_format("invoice_date", "yyyy-MM")
        had, clv_had = F.lit(False), F.lit(False)
        if base["invoices"]:
            mine = invoices.select("invoice_no")
            known = (self._read("invoices", base).join(mine, "invoice_no", "left_semi").groupBy("invoice_no").agg(
                F.min(F.struct("customer_id", "invoice_date")).alias("_header"),
                F.bool_or("has_lines").alias("_had"), F.bool_or("has_clv").alias("_clv_had")))
            invoices = checkpointed(invoices.join(known, "invoice_no", "left"))
            other = F.col("_header").isNotNull() & ~F.col("_header").eqNullSafe(F.struct("customer_id", "invoice_date"))
            wrong = invoices.where(other).select("invoice_no").limit(3).collect()
            if wrong:
                raise ValueError(f"invoices whose stored header is another: {[r[0] for r in wrong]}")
            had, clv_had = F.coalesce("_had", F.lit(False)), F.coalesce("_clv_had", F.lit(False))
        lines, clv = F.col("lines") > 0, F.col("clv_lines") > 0
        register = invoices.where((lines & ~had) | (clv & ~clv_had)).select(
            "invoice_no", "customer_id", "invoice_date", lines.alias("has_lines"), clv.alias("has_clv"))
        return partials(invoices, month, lines & ~had, clv & ~clv_had), register

    def _read(self, kind: str, manifest: dict) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in manifest[kind]])

    def _stored(self, kind: str, folder: str, rows: DataFrame, earlier: list[str]) -> list[str]:
        """Write a batch's rows; with the earlier ones in one folder, once there are many."""
        place = f"{kind}/{folder}"
        if len(earlier) + 1 >= FOLD:
            both = rows.unionByName(self.spark.read.parquet(*[f"{self.root}/{f}" for f in earlier]))
            rows, earlier = (added_up(both, "customer_id", "period") if kind == "parts" else
                             both.groupBy("invoice_no", "customer_id", "invoice_date").agg(
                                 F.bool_or("has_lines").alias("has_lines"), F.bool_or("has_clv").alias("has_clv"))), []
        if kind == "invoices":
            rows = rows.sortWithinPartitions("invoice_no")
        rows.write.parquet(f"{self.root}/{place}")
        return [*earlier, place]

    @property
    def batches(self) -> list[str]:
        return (self.manifests.latest()[1] or {"batches": []})["batches"]

    def partials(self) -> DataFrame:
        """All stored partials, one row per (customer, month)."""
        _, manifest = self.manifests.latest()
        if manifest is None:
            raise ValueError(f"no state at {self.root}")
        return added_up(self._read("parts", manifest), "customer_id", "period")

    def rfm_scores(self) -> DataFrame:
        return scores.rfm_of(rfm_base(self.partials()))

    def clv_scores(self) -> DataFrame:
        return scores.clv_of(clv_base(self.partials()))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions older than the newest ``keep`` and the folders that none
        of those names. Run it while nobody adds."""
        numbers = self.manifests.numbers()
        kept = [self.manifests.read(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.manifests.forget(n)
        gone = []
        for kind in ("parts", "invoices"):
            used = {f for m in kept for f in m[kind]}
            fs, place = path_of(self.spark, f"{self.root}/{kind}")
            names = [f"{kind}/{s.getPath().getName()}" for s in fs.listStatus(place)] if fs.exists(place) else []
            gone += [n for n in names if n not in used]
        for name in gone:
            delete(self.spark, f"{self.root}/{name}")
        return gone
