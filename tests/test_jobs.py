import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronage.operators.keyed_table import KeyedTable
from patronage.operators.manifest import Conflict
from patronage.plans import jobs, scores
from patronage.sources.tables import Tables
from tests.conftest import SF_SMALL


def test_star_schema_and_scores_round_trip(spark, scratch):
    t = Tables.from_tpch(spark, SF_SMALL)
    paths = jobs.build_star_schema(t, f"{scratch}/star")
    from patronage.plans import cleaning
    expected = dict(cleaning.table_counts(t).collect())
    assert {k: spark.read.parquet(paths[k]).count() for k in expected} == expected
    items = spark.read.parquet(paths["order_items"])
    assert "invoice_month" in items.columns and "invoice_month" in spark.read.parquet(paths["orders"]).columns
    assert sorted(r[0] for r in items.select("item_id").collect()) == list(range(1, items.count() + 1))
    assert spark.read.parquet(paths["category_margin_assumptions"]).count() == t.margins().count()

    first = jobs.persist_scores(t, f"{scratch}/scores")
    again = jobs.persist_scores(t, f"{scratch}/scores")
    table = KeyedTable(spark, again["rfm_scores"])
    assert first == again and table.version == 2
    a, b = table.read(1).drop("updated_at"), table.read(2).drop("updated_at")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert b.count() == scores.rfm_scores(t).count()


def _tiny_star(spark):
    """Customers a (a line with a margin) and b (only a category without one)."""
    ts = datetime.datetime
    orders = spark.createDataFrame([("1", "a", ts(2011, 1, 5, 9), "Completed", "UK"), ("2", "a", ts(2011, 3, 7, 9), "Completed", "UK"),
                                    ("3", "b", ts(2011, 3, 8, 9), "Completed", "FR")],
                                   "invoice_no string, customer_id string, invoice_date timestamp_ntz, order_status string, country string")
    items = spark.createDataFrame([(1, "1", "s1", 2, Decimal("3.00"), Decimal("6.00")), (2, "2", "s1", 1, Decimal("3.00"), Decimal("3.00")),
                                   (3, "3", "s2", 5, Decimal("2.00"), Decimal("10.00"))],
                                  "item_id bigint, invoice_no string, stock_code string, quantity int, unit_price decimal(10,2), line_total decimal(14,2)")
    products = spark.createDataFrame([("s1", "MUG", "Kitchen & Dining", Decimal("3.00")), ("s2", "ODD", "No such category", Decimal("2.00"))],
                                     "stock_code string, description string, category string, avg_unit_price decimal(10,2)")
    customers = spark.createDataFrame([("a", "UK", None, None, True), ("b", "FR", None, None, True)],
                                      "customer_id string, country string, first_purchase_date date, last_purchase_date date, is_active boolean")
    return {"orders": orders, "order_items": items, "products": products, "customers": customers}


def test_customers_without_a_margin_keep_their_rfm_scores(spark, scratch):
    star = _tiny_star(spark)
    t = Tables.from_star(spark, **star)
    paths = jobs.persist_scores(t, f"{scratch}/scores")
    rfm, clv = (KeyedTable(spark, paths[n]).read() for n in ("rfm_scores", "clv_scores"))
    assert {r.customer_id for r in rfm.collect()} == {"a", "b"} and {r.customer_id for r in clv.collect()} == {"a"}
    from patronage.plans import explore, serving
    stored = Tables.from_star(spark, **star, rfm_scores=rfm, clv_scores=clv)
    margins = {r.category for r in t.margins().collect()}
    assert "No such category" not in margins
    for tables in (t, stored):
        both = {r.customer_id: r for r in scores.rfm_clv(tables).collect()}
        assert both["b"].rfm_segment and both["b"].clv_segment is None and both["a"].clv_segment
        assert {r.customer_id for r in serving.customer_master(tables).collect()} == {"a"}
        details = serving.order_details(tables).collect()
        assert {r.order_id for r in details} == {"1", "2"} and all(r.clv_segment for r in details)
    # given score tables, the details read the lines once
    plan = serving.order_details(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("line_total#") and "Aggregate" not in plan
    enriched = {r.item_id: r for r in explore.order_items_enriched(stored).collect()}
    assert set(enriched) == {1, 2, 3} and enriched[3].net_line_total == Decimal("4.800000")


def test_heatmap_has_all_days(spark):
    from patronage.plans import explore
    rows = {r.dow: r for r in explore.order_heatmap(Tables.from_star(spark, **_tiny_star(spark))).collect()}
    assert [rows[d].dow_position for d in ("Monday", "Saturday", "Sunday")] == [1, 6, 7] and len(rows) == 7
    assert rows["Saturday"].January is None and rows["Wednesday"].January == 1


def test_top_products_does_not_overflow(spark):
    from patronage.plans import explore
    star = _tiny_star(spark)
    big = Decimal("999999999999.99")
    star["order_items"] = spark.range(400).selectExpr("id + 1 as item_id", "cast(id % 3 + 1 as string) as invoice_no", "'s1' as stock_code",
                                                      "1 as quantity", "cast(1 as decimal(10,2)) as unit_price",
                                                      f"cast('{big}' as decimal(14,2)) as line_total")
    # an invoice's lines stay under 2^63 units of 1e-6; the product's total doesn't
    few = star["order_items"].where("item_id <= 30")
    rows = explore.top_products(Tables.from_star(spark, **{**star, "order_items": few})).collect()
    assert len(rows) == 1 and rows[0].units == 30
    assert rows[0].net_revenue > Decimal(2 ** 63) / 10 ** 6


RAW = ("id bigint, InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, UnitPrice decimal(10,4), "
       "CustomerID string, Country string")


def _raw_rows(n=400):
    """Lines of 60 invoices over 5 months; an invoice's lines are spread over the file."""
    at = datetime.datetime
    return [(i, f"{i * 7 % 60}", f"s{i % 9}", [" mug ", "BAG", None, "lunch bag", "odd"][i * 3 % 5], i % 4 + 1, at(2011, i * 7 % 60 % 5 + 1, 3, 9, i % 60),
             Decimal(i % 11 + 1) / 4, f"c{i * 7 % 60 % 13}", [None, "UK", "FR"][i % 3]) for i in range(1, n + 1)]


def _tables_of(spark, rows):
    return Tables.from_star(spark, raw=spark.createDataFrame(rows, RAW))


def _contents(spark, root):
    t = jobs.load_star_schema(spark, root)
    frames = {"orders": t.orders(with_country=True), "order_items": t.order_items(), "products": t.products(), "customers": t.customers().drop("created_at")}
    return {k: sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect()))) for k, df in frames.items()}


def test_two_appends_equal_one_load_of_both(spark, scratch):
    rows = _raw_rows()
    jobs.build_star_schema(_tables_of(spark, rows), f"{scratch}/one", buckets=4)
    for n, part in enumerate((rows[:150], rows[150:170], rows[170:])):
        for _ in range(2 if n == 1 else 1):  # a load that is sent again is not loaded again
            jobs.build_star_schema(_tables_of(spark, part), f"{scratch}/more", mode="append", buckets=4, load_id=f"day-{n}")
    one, more = _contents(spark, f"{scratch}/one"), _contents(spark, f"{scratch}/more")
    assert one == more and len(one["order_items"]) == 400 and len(one["orders"]) == 60
    t = jobs.load_star_schema(spark, f"{scratch}/more")
    assert t.order_items().agg(F.count_distinct("item_id"), F.min("item_id"), F.max("item_id")).first()[:] == (400, 1, 400)
    whole = _tables_of(spark, rows)
    assert sorted(map(str, map(tuple, scores.rfm_scores(t).collect()))) == sorted(map(str, map(tuple, scores.rfm_scores(
        Tables.from_star(spark, orders=_from(whole, "orders"), order_items=_from(whole, "order_items"))).collect())))


def _from(t, name):
    from patronage.plans import cleaning
    return cleaning.orders_dim(t) if name == "orders" else cleaning.order_items_clean(t)


def test_an_unfinished_or_late_load_stores_nothing(spark, scratch, monkeypatch):
    rows, root = _raw_rows(120), f"{scratch}/star"
    jobs.build_star_schema(_tables_of(spark, rows[:60]), root, buckets=4, load_id="a")
    before = _contents(spark, root)
    from patronage.operators import manifest

    def crash(self, number, content):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifest.Manifests, "commit", crash)
        with pytest.raises(RuntimeError):
            jobs.build_star_schema(_tables_of(spark, rows[60:]), root, mode="append", load_id="b")
    assert _contents(spark, root) == before
    real = manifest.Manifests.commit

    def raced(self, number, content):
        real(self, number, {**content, "loads": content["loads"][:-1] + [{"id": "other", "folder": content["loads"][0]["folder"]}]})
        real(self, number, content)

    with monkeypatch.context() as m:
        m.setattr(manifest.Manifests, "commit", raced)
        with pytest.raises(Conflict):
            jobs.build_star_schema(_tables_of(spark, rows[60:]), f"{scratch}/raced", load_id="b")
    jobs.build_star_schema(_tables_of(spark, rows[60:]), root, mode="append", load_id="b")
    jobs.build_star_schema(_tables_of(spark, rows), f"{scratch}/one", buckets=4)
    assert _contents(spark, root) == _contents(spark, f"{scratch}/one")
    jobs.build_star_schema(_tables_of(spark, rows[:10]), root, mode="overwrite", buckets=8)
    assert len(_contents(spark, root)["order_items"]) == 10


def test_replaced_scores_are_read_back(spark, scratch):
    root = f"{scratch}/star"
    jobs.build_star_schema(_tables_of(spark, _raw_rows(120)), root, buckets=4)
    for mode in ("replace", "upsert", "replace"):
        jobs.persist_scores(jobs.load_star_schema(spark, root), root, mode)
        t = jobs.load_star_schema(spark, root)
        assert t.stored("rfm_scores").count() == 13 and t.stored("clv_scores") is not None
    assert KeyedTable(spark, f"{root}/rfm_scores").version == 3
    some = t.stored("rfm_scores").limit(2)
    KeyedTable(spark, f"{root}/rfm_scores").replace(some, ["customer_id"])
    assert jobs.load_star_schema(spark, root).stored("rfm_scores").count() == 2


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_their_invoices_without_a_shuffle(spark, scratch):
    root = f"{scratch}/star"
    for n in range(2):
        jobs.build_star_schema(_tables_of(spark, _raw_rows()[200 * n:200 * n + 200]), root, mode="append", buckets=4)
    t = jobs.load_star_schema(spark, root)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = _plan(t.completed_orders().join(t.order_items(), "invoice_no"))
        sums = _plan(t.completed_orders().join(scores.invoice_totals(t), "invoice_no"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in (joined, sums):
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") >= 2, plan


def _lines_read(df):
    """Files that the scan of the lines has read."""
    df.collect()
    todo, files = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "FileSourceScan" in node.getClass().getSimpleName() and "line_total" in node.toString():
            files += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return files


def test_a_period_reads_its_months_only(spark, scratch):
    from patronage.plans import serving
    root = f"{scratch}/star"
    jobs.build_star_schema(_tables_of(spark, _raw_rows()), root, buckets=4)
    t = jobs.load_star_schema(spark, root)
    for query in (serving.monthly_revenue, serving.order_details):
        part = query(t.between("2011-02-01", "2011-03-15"))
        assert "dynamicpruning" in part._jdf.queryExecution().executedPlan().toString().lower()
        assert {r["year_month"] for r in part.collect()} == {"2011-02", "2011-03"}
        every, few = _lines_read(query(t)), _lines_read(query(t.between("2011-02-01", "2011-03-15")))
        assert 0 < few <= every * 2 / 5, (query.__name__, every, few)
    whole = {r["year_month"]: r for r in serving.monthly_revenue(t).collect()}
    february = serving.monthly_revenue(t.between("2011-02-01", "2011-03-01")).collect()
    assert len(february) == 1 and february[0]["gross_revenue"] == whole["2011-02"]["gross_revenue"]
    late = t.restrict_orders(lambda o: o.where("customer_id = 'c1' and month(invoice_date) = 4"))
    assert {r["year_month"] for r in serving.monthly_revenue(late).collect()} <= {"2011-04"}
