import pytest
from pyspark.sql import functions as F

from patronage.plans import explore, jobs, rollup, serving
from patronage.sources.tables import Tables
from tests.conftest import SF_SMALL

REPORTS = [serving.monthly_revenue, serving.monthly_kpi, serving.category_revenue, explore.monthly_net_revenue]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def star(spark):
    """Lines without a product or a margin, orders without a country, date or customer."""
    t = Tables.from_tpch(spark, SF_SMALL)
    odd = lambda c, n: F.when(F.col("invoice_no") % n != 1, F.col(c)).alias(c)
    orders = t.orders(with_country=True).select("invoice_no", odd("customer_id", 41), odd("invoice_date", 43), "order_status", odd("country", 5)).cache()
    products = (t.products().where("stock_code % 7 <> 2")
                .withColumn("category", F.when(F.col("stock_code") % 3 == 0, "No such category").otherwise(F.col("category"))).cache())
    return {"orders": orders, "order_items": t.order_items().cache(), "products": products, "customers": t.customers()}


def test_reports_read_the_same_from_one_rollup(spark, star, scratch):
    plain = Tables.from_star(spark, **star)
    rollup.write(rollup.build(plain), f"{scratch}/r")
    kept = rollup.read(spark, f"{scratch}/r")
    stored = Tables.from_star(spark, **star, rollup=kept)
    for report in REPORTS:
        assert _rows(report(stored)) == _rows(report(plain)), report.__name__
        assert all("/r/" in f for f in report(stored).inputFiles())
    # any period is again read from the lines
    part = stored.between("1994-01-01", "1995-01-01")
    assert part.rollup is None and _rows(serving.monthly_revenue(part)) == _rows(serving.monthly_revenue(plain.between("1994-01-01", "1995-01-01")))


def test_distinct_customers_of_every_group(spark, star):
    plain = Tables.from_star(spark, **star)
    kept = rollup.build(plain)
    lines = (plain.completed_orders(with_country=True).join(plain.order_items(), "invoice_no").join(plain.products().select("stock_code", "category"), "stock_code", "left")
             .withColumn("year_month", F.date_format("invoice_date", "yyyy-MM"))).cache()
    for grain, by in [("all", ["country"]), ("all", ["year_month", "country"]), ("category", ["category"]), ("category", ["country", "category"])]:
        want = lines.groupBy(*by).agg(F.count_distinct("invoice_no"), F.count(F.lit(1)), F.count_distinct("customer_id"))
        assert _rows(kept.groups(grain, by).select(*by, "orders", "lines", "customers")) == _rows(want), by
    for grain, by in [("all", ["category"]), ("some", ["country"]), ("all", ["invoice_no"]), ("all", [])]:
        with pytest.raises(ValueError):
            kept.groups(grain, by)


def test_a_customer_in_many_groups_and_many_buckets(spark):
    n = 70_000  # customers: two bitmaps; customer 0 orders in every country and month
    orders = spark.range(n).select(F.col("id").alias("invoice_no"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("customer_id"),
                                   F.expr("make_timestamp_ntz(2011, cast(1 + id % 12 as int), 1, 0, 0, 0)").alias("invoice_date"),
                                   F.lit("Completed").alias("order_status"), (F.col("id") % 5).cast("string").alias("country"))
    items = spark.range(n).selectExpr("id AS invoice_no", "cast(id % 4 as string) AS stock_code", "1 AS quantity", "cast(1.5 as decimal(10,2)) AS unit_price",
                                      "cast(1.5 as decimal(14,2)) AS line_total")
    products = spark.createDataFrame([(str(i), "D", "Kitchen & Dining" if i else None) for i in range(3)], "stock_code string, description string, category string")
    kept = rollup.build(Tables.from_star(spark, orders=orders, order_items=items, products=products, customers=spark.range(0)))
    assert kept.members.select("bucket").distinct().count() == 2  # 35,001 customers
    joined = orders.join(items, "invoice_no")
    for by in (["country"], ["year_month"]):
        want = joined.withColumn("year_month", F.date_format("invoice_date", "yyyy-MM")).groupBy(*by).agg(F.count_distinct("customer_id"))
        assert _rows(kept.customers("all", by)) == _rows(want)


def test_a_rollup_of_earlier_loads_is_not_read(spark, scratch):
    t = Tables.from_tpch(spark, SF_SMALL)
    root = f"{scratch}/star"
    jobs.build_star_schema(t, root)
    assert jobs.load_star_schema(spark, root).rollup is None
    jobs.persist_rollup(spark, root)
    stored = jobs.load_star_schema(spark, root)
    assert stored.rollup is not None
    want = _rows(serving.monthly_kpi(jobs.load_star_schema(spark, root, rollup=None)))
    assert _rows(serving.monthly_kpi(stored)) == want and want
    jobs.build_star_schema(t, root, mode="append", load_id="again")
    assert jobs.load_star_schema(spark, root).rollup is None
    none = rollup.build(Tables.from_star(spark, **{n: stored_frame.limit(0) for n, stored_frame in (
        ("orders", t.orders(with_country=True)), ("order_items", t.order_items()), ("products", t.products()), ("customers", t.customers()))}))
    assert none.groups("all", ["country"]).count() == 0
