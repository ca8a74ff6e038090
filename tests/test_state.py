import pytest
from pyspark.sql import functions as F

from patronage.plans import scores, state
from patronage.plans.state import CustomerState
from patronage.sources.tables import Tables
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def whole(spark):
    """Orders and lines of the small tables; some orders without lines, some lines without a margin."""
    t = Tables.from_tpch(spark, SF_SMALL)
    orders = t.orders(with_country=True).cache()
    items = t.order_items().where("invoice_no % 11 <> 3").cache()
    products = t.products().withColumn("category", F.when(F.col("stock_code") % 3 == 0, "No such category").otherwise(F.col("category"))).cache()
    return {"orders": orders, "order_items": items, "products": products, "customers": t.customers()}


def _batches(spark, star, n):
    """Lines dealt over n batches whatever their invoice; each comes with the headers it needs."""
    out = []
    for i in range(n):
        items = star["order_items"].where(F.pmod(F.xxhash64("invoice_no", "stock_code", "quantity"), F.lit(n)) == i)
        mine = star["orders"].join(items.select("invoice_no").distinct(), "invoice_no", "left_semi")
        lone = star["orders"].join(star["order_items"], "invoice_no", "left_anti").where(F.col("invoice_no") % n == i)
        out.append(Tables.from_star(spark, **{**star, "orders": mine.unionByName(lone), "order_items": items}))
    return out


def test_batches_in_any_order_and_twice_equal_a_full_scoring(spark, scratch, whole, monkeypatch):
    monkeypatch.setattr(state, "FOLD", 3)
    kept = CustomerState(spark, f"{scratch}/state")
    batches = _batches(spark, whole, 4)
    assert [kept.add(batches[i], f"b{i}") for i in (2, 0, 2, 3, 1, 0)] == [True, True, False, True, True, False]
    assert kept.batches == ["b2", "b0", "b3", "b1"]
    everything = Tables.from_star(spark, **whole)
    assert _rows(kept.rfm_scores()) == _rows(scores.rfm_scores(everything))
    assert _rows(kept.clv_scores()) == _rows(scores.clv_scores(everything))
    assert "order_items" not in str(kept.rfm_scores().inputFiles())
    manifest = kept.manifests.latest()[1]
    assert len(manifest["parts"]) < 3  # folded
    before = _rows(kept.partials())
    assert kept.vacuum(keep=1) and kept.vacuum(keep=1) == []
    assert _rows(kept.partials()) == before and kept.add(batches[1], "b1") is False
    months = kept.partials()
    assert months.count() == months.select("customer_id", "period").distinct().count()


def test_an_invoice_keeps_its_header_and_racing_batches_both_count(spark, scratch, whole, monkeypatch):
    kept = CustomerState(spark, f"{scratch}/state")
    first, second = _batches(spark, whole, 2)
    commit, other = kept.manifests.commit, CustomerState(spark, f"{scratch}/state")

    def late(number, content):
        monkeypatch.setattr(kept.manifests, "commit", commit)
        other.add(second, "second")
        commit(number, content)
    monkeypatch.setattr(kept.manifests, "commit", late)
    assert kept.add(first, "first") and kept.batches == ["second", "first"]
    assert _rows(kept.rfm_scores()) == _rows(scores.rfm_scores(Tables.from_star(spark, **whole)))
    moved = Tables.from_star(spark, **{**whole, "orders": whole["orders"].withColumn("customer_id", F.col("customer_id") + 1)})
    with pytest.raises(ValueError, match="header"):
        kept.add(moved, "third")
    assert kept.batches == ["second", "first"]


def test_no_orders(spark, scratch, whole):
    kept = CustomerState(spark, f"{scratch}/state")
    with pytest.raises(ValueError, match="no state"):
        kept.partials()
    assert kept.add(Tables.from_star(spark, **{**whole, "orders": whole["orders"].limit(0)}), "none")
    assert kept.rfm_scores().count() == kept.clv_scores().count() == 0


def test_upsert_reads_the_lines_once(spark):
    t = Tables.from_tpch(spark, SF_SMALL)
    invoices = state.invoice_state(t, clv=False)
    assert invoices._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    assert {r.customer_id for r in scores.score_upsert(t).collect()} == {r.customer_id for r in scores.rfm_scores(t).collect()}
