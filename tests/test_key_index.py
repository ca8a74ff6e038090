import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronage.operators import key_index
from patronage.operators.manifest import delete
from patronage.plans import jobs
from patronage.sources.star import StarStore
from tests.test_jobs import _contents, _raw_rows, _tables_of


@pytest.mark.parametrize("buckets", [1, 4])
def test_a_file_that_holds_a_key_is_always_named(spark, buckets, monkeypatch):
    monkeypatch.setattr(key_index, "KEYS_A_SEGMENT", 64)  # several segments a file
    key = F.concat(F.lit("inv-"), F.col("id").cast("string"))
    # files by bucket and by ranges of different sizes; keys 0 to 8,999 are stored, one of them in two files
    rows = (spark.range(9000).select("id", key.alias("k")).withColumn("bucket", F.pmod(F.hash("k"), F.lit(buckets)))
            .withColumn("file", F.concat_ws("/", F.when(F.col("id") < 1000, "a").when(F.col("id") < 1100, "b").otherwise("c"), "bucket")))
    again = rows.where("id = 5").withColumn("file", F.concat_ws("/", F.lit("c"), "bucket"))
    stored = rows.unionAll(again).unionAll(rows.limit(1).withColumn("k", F.lit(None).cast("string"))).select("file", "k")
    index = key_index.build(stored, "k", buckets).persist()
    assert index.select("segments").distinct().count() > 1
    asked = spark.range(4500, 13500).select(key.alias("key")).unionAll(spark.createDataFrame([("inv-5",), (None,)], "key string"))
    got = {(r["file"], r["key"]) for r in key_index.holders(index, asked, buckets).collect()}
    want = {(r["file"], r["key"]) for r in stored.withColumnRenamed("k", "key").join(asked, "key").collect()}
    assert want <= got and len([x for x in want if x[1] == "inv-5"]) == 2
    assert len(got - want) < 0.03 * 3 * 9000
    assert key_index.holders(index.limit(0), asked, buckets).count() == 0
    assert key_index.holders(index, asked.limit(0), buckets).count() == 0
    assert key_index.build(stored.limit(0), "k", buckets).count() == 0


def _headers(spark, rows):
    return spark.createDataFrame([(i, c, datetime.datetime(2012, 1, 1), "UK", "Completed") for i, c in rows],
                                 "invoice_no string, customer_id string, invoice_date timestamp_ntz, country string, order_status string")


def _lines(spark, rows):
    return spark.createDataFrame([(i, s, q, Decimal("1.00")) for i, s, q in rows],
                                 "invoice_no string, stock_code string, quantity int, unit_price decimal(10,2)")


def test_stored_headers_come_from_few_files(spark, scratch):
    rows, root = _raw_rows(), f"{scratch}/star"
    for n in range(2):
        jobs.build_star_schema(_tables_of(spark, rows[200 * n:200 * n + 200]), root, mode="append", buckets=8)
    store = StarStore(spark, root)
    every = store.fact("orders").select(F.input_file_name()).distinct().collect()
    asked = spark.createDataFrame([("7",), ("nowhere",), (None,), ("7",)], "invoice_no string")
    files, got = store.order_files(asked), store.headers_of(asked)
    want = store.fact("orders").where("invoice_no = '7'").select(got.columns).collect()
    assert got.collect() == want and len(want) == 1
    assert 1 <= len(files) <= 2 < len(every)
    unknown = store.headers_of(spark.createDataFrame([("zz-1",), ("zz-2",)], "invoice_no string"))
    assert unknown.count() == 0 and unknown.columns == got.columns
    # a store of before the indexes: its loads are read whole
    number, manifest = store.manifest()
    old = [{k: v for k, v in x.items() if k != "indexed"} for x in manifest["loads"]]
    store.manifests.commit(number + 1, {**manifest, "loads": old})
    for x in old:
        delete(spark, f"{root}/orders_index/load={x['folder']}")
    assert len(store.order_files(asked)) == 2 and store.headers_of(asked).collect() == want
    jobs.build_star_schema(_tables_of(spark, rows[:50]), root, mode="append")
    assert len(_contents(spark, root)["orders"]) == 60 and store.headers_of(asked).collect() == want


def test_violations_of_a_batch_are_reported_with_their_keys(spark, scratch):
    root = f"{scratch}/star"
    jobs.build_star_schema(_tables_of(spark, _raw_rows()), root, buckets=8)
    fine = jobs.append_violations(spark, root, _headers(spark, [("n1", "c1"), ("n2", "c2")]), _lines(spark, [("n1", "s1", 1), ("3", "s2", 2)]))
    assert fine.collect() == []  # a line of a stored invoice has its header
    orders = _headers(spark, [("3", "c1"), ("n1", "c1"), ("n1", "c2"), ("n2", "nobody"), (None, "c1"), ("n3", None)])
    lines = _lines(spark, [("n1", "s1", 1), ("gone", "s1", 1), ("gone", "s2", 1), ("3", "new", 1), (None, "s1", 1), ("n1", None, None)])
    got = {tuple(r) for r in jobs.append_violations(spark, root, orders, lines).collect()}
    assert got == {("orders.pk_invoice_no", "3", 1), ("orders.pk_invoice_no", "n1", 2), ("order_items.fk_invoice_no", "gone", 2),
                   ("orders.fk_customer_id", "nobody", 1), ("order_items.fk_stock_code", "new", 1),
                   ("orders.nn_invoice_no", None, 1), ("orders.nn_customer_id", None, 1), ("order_items.nn_invoice_no", None, 1),
                   ("order_items.nn_stock_code", None, 1), ("order_items.nn_quantity", None, 1)}
    none = jobs.append_violations(spark, root, orders.limit(0), lines.limit(0))
    assert none.collect() == []
