"""Cleaning path on hand-written edge rows (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest

from patronage import config
from patronage.plans import cleaning
from patronage.sources.tables import Tables

D0 = dt.datetime(2011, 1, 1, 9, 0)
D1 = dt.datetime(2011, 2, 1, 9, 0)
ROWS = [
    (1, "C536379", "85123A", "WHITE HEART", 6, D0, "2.55", "17850", "United Kingdom"),
    (2, "c536379", "85123B", "WHITE HEART", 6, D0, "2.55", "17850", "United Kingdom"),
    (3, "536380", "POST", "POSTAGE", 1, D0, "18.00", "12583", "France"),
    (4, "536381", "BANK CHARGES", "BANK", 1, D0, "15.00", "12583", "France"),
    (5, "536382", "gift_0001_20", "VOUCHER", 1, D0, "20.00", "17850", "United Kingdom"),
    (6, "536383", "DCGS0003", "BOXED GLASS", 1, D0, "5.00", "17850", "United Kingdom"),
    (7, "536384", "POSTER1", "POSTER", 2, D0, "1.00", "17850", "United Kingdom"),
    (8, "536384", "M1", "MINI", 2, D0, "1.00", "17850", "United Kingdom"),
    (9, "536384", "GIFT_1", "GIFT BOX", 2, D0, "1.00", "17850", "United Kingdom"),
    (10, "C1", "POST", "X", -1, D0, "0", None, "United Kingdom"),
    (11, "536385", "22000", "TOY", 1, D0, "1.00", None, "United Kingdom"),
    (12, "536386", "22001", "TOY", 1, D0, "0.00", "17850", "United Kingdom"),
    (13, "536387", "22002", "TOY", 0, D0, "1.00", "17850", "United Kingdom"),
    (14, "536388", "22003", None, 1, D0, "1.00", "17850", "United Kingdom"),
    (15, "536388", "22004", "CHRISTMAS GIFT BAG", 1, D0, "1.00", "17850", "United Kingdom"),
    (16, "536388", "22005", "BAGS", 1, D0, "1.00", "17850", "United Kingdom"),
    (17, "536388", "22006", "RED BAG", 1, D0, "1.00", "17850", "United Kingdom"),
    (18, "536388", "22007", "TEA TOWEL", 1, D0, "1.00", "17850", "United Kingdom"),
    (19, "536388", "22008", "BEACH TOWEL", 1, D0, "1.00", "17850", "United Kingdom"),
    (20, "536388", "22009", "  red bag ", 1, D0, "1.00", "17850", "United Kingdom"),
    (21, "600001", "22010", "CUP", 1, dt.datetime(2011, 1, 1, 10, 0), "1.00", "17850", "United Kingdom"),
    (22, "600001", "22011", "CUP", 1, dt.datetime(2011, 1, 1, 10, 5), "1.00", "17850", "United Kingdom"),
    (23, "600002", "22012", "MUG", 1, D0, "1.00", "X1", "France"),
    (24, "600003", "22013", "MUG", 1, D1, "1.00", "X1", "Germany"),
    (25, "600004", "S1", "BBB", 1, D0, "1.00", "17850", "United Kingdom"),
    (26, "600004", "S1", "AAA", 1, D0, "1.00", "17850", "United Kingdom"),
    (27, "600005", "22014", "PLATE", 3, D0, "1.2350", "17850", "United Kingdom"),
    (28, "600005", "22015", "JAR", 80000, D0, "0.10", "17850", "United Kingdom"),
]
SCHEMA = ("id long, InvoiceNo string, StockCode string, Description string, Quantity int, "
          "InvoiceDate timestamp_ntz, UnitPrice decimal(10,4), CustomerID string, Country string")


@pytest.fixture(scope="module")
def t(spark):
    # insert in shuffled order: "first" must follow id, not insertion order
    rows = [r[:6] + (Decimal(r[6]),) + r[7:] for r in reversed(ROWS)]
    raw = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return Tables.from_star(spark, raw=raw, category_rules=config.CATEGORY_RULES)


def test_audit_counts_every_rule(t):
    got = dict(cleaning.quality_audit(t).collect())
    assert got == {"Total raw rows": 28, "Null CustomerID": 2,
                   "Cancelled invoices (InvoiceNo starts C)": 2, "Zero or negative UnitPrice": 2,
                   "Non-merchandise StockCodes": 5, "Zero or negative Quantity": 2}


def test_waterfall_charges_first_failing_rule(t):
    rows = sorted(cleaning.cleaning_waterfall(t).collect())
    assert [r.rows_removed for r in rows] == [0, 5, 1, 1, 1, 1]
    assert [r.rows_remaining for r in rows] == [28, 23, 22, 21, 20, 19]
    assert rows[-1].rows_remaining == cleaning.clean_lines(t).count()


def test_clean_lines_kept_and_dropped(t):
    kept = {r.stock_code for r in cleaning.clean_lines(t).collect()}
    assert {"85123B", "POSTER1", "M1", "GIFT_1", "22003"} <= kept
    assert not kept & {"85123A", "POST", "BANK CHARGES", "gift_0001_20", "DCGS0003", "22000",
                       "22001", "22002"}


def test_categories_first_match_and_boundaries(t):
    cat = {r.stock_code: (r.description, r.category) for r in cleaning.clean_lines(t).collect()}
    assert cat["22003"] == (None, "Other / Miscellaneous")
    assert cat["22004"][1] == "Christmas & Seasonal"
    assert cat["22005"][1] == "Other / Miscellaneous"
    assert cat["22006"][1] == "Bags & Accessories"
    assert cat["22007"][1] == "Kitchen & Dining"
    assert cat["22008"][1] == "Bath & Body"
    assert cat["22009"] == ("RED BAG", "Bags & Accessories")


def test_first_row_by_staging_id(t):
    orders = {r.invoice_no: r for r in cleaning.orders_dim(t).collect()}
    assert orders["600001"].invoice_date == dt.datetime(2011, 1, 1, 10, 0)
    assert orders["600001"].order_status == "Completed"
    customers = {r.customer_id: r for r in cleaning.customers_dim(t).collect()}
    assert customers["X1"].country == "France"
    assert customers["X1"].last_purchase_date == dt.date(2011, 2, 1)


def test_mode_tie_goes_to_smallest(t):
    products = {r.stock_code: r for r in cleaning.products_dim(t).collect()}
    assert products["S1"].description == "AAA"
    assert products["22003"].description is None
    assert products["22003"].category == "Other / Miscellaneous"


def test_price_narrowing_and_large_quantity(t):
    items = {r.stock_code: r for r in cleaning.order_items_clean(t).collect()}
    assert items["22014"].unit_price == Decimal("1.24")
    assert items["22014"].line_total == Decimal("3.72")
    assert items["22015"].quantity == 80000
    assert items["22015"].line_total == Decimal("8000.00")


def test_table_counts(t):
    got = dict(cleaning.table_counts(t).collect())
    assert got["order_items"] == 19
    assert got["orders"] == len({r[1] for r in ROWS if r[0] in
                                 {2, 7, 8, 9, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28}})


def test_constraint_report_sees_every_kind(spark):
    import datetime
    from decimal import Decimal

    from patronage.plans import cleaning
    from patronage.sources.tables import Tables
    when = datetime.datetime(2011, 1, 5, 9)
    star = {
        "orders": spark.createDataFrame([("1", "a", when, "Completed", "UK"), ("1", "z", None, "Completed", None)],
                                        "invoice_no string, customer_id string, invoice_date timestamp_ntz, order_status string, country string"),
        "order_items": spark.createDataFrame([(1, "1", "s1", 2, Decimal("3.00"), Decimal("6.00")), (1, "9", "s9", None, None, None),
                                              (2, None, "s1", 1, Decimal("1.00"), Decimal("1.00"))],
                                             "item_id bigint, invoice_no string, stock_code string, quantity int, unit_price decimal(10,2), line_total decimal(14,2)"),
        "products": spark.createDataFrame([("s1", "MUG", "Kitchen & Dining", Decimal("3.00")), ("s2", None, "No such", None)],
                                          "stock_code string, description string, category string, avg_unit_price decimal(10,2)"),
        "customers": spark.createDataFrame([("a", None, None, None, True)],
                                           "customer_id string, country string, first_purchase_date date, last_purchase_date date, is_active boolean"),
        "raw": spark.createDataFrame([(1, None, "s", "d", 1, when, Decimal("1"), None, "UK")],
                                     "id bigint, InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
                                     "UnitPrice decimal(10,4), CustomerID string, Country string"),
        "rfm_scores": spark.createDataFrame([("a", 1, 1, Decimal("1.00"), 1, 1, 1, 3, "Lost"), ("q", 1, 1, None, 1, 1, 1, 3, "Lost")],
                                            "customer_id string, recency_days int, frequency int, monetary decimal(14,2), r_score int, f_score int, "
                                            "m_score int, rfm_score int, rfm_segment string"),
    }
    rows = cleaning.constraint_violations(Tables.from_star(spark, **star)).collect()
    got = {r.constraint_name: r.violations for r in rows}
    assert len(got) == len(rows)
    wrong = {k: v for k, v in got.items() if v}
    assert wrong == {
        "orders.pk_invoice_no": 2, "orders.fk_customer_id": 1, "orders.nn_invoice_date": 1, "orders.nn_country": 1,
        "order_items.pk_item_id": 2, "order_items.fk_invoice_no": 2, "order_items.fk_stock_code": 1, "order_items.nn_invoice_no": 1,
        "order_items.nn_quantity": 1, "order_items.nn_unit_price": 1, "products.fk_category": 1, "products.nn_description": 1,
        "products.nn_avg_unit_price": 1, "customers.nn_country": 1, "customers.nn_first_purchase_date": 1,
        "customers.nn_last_purchase_date": 1, "raw_transactions.nn_invoiceno": 1, "rfm_scores.nn_monetary": 1, "rfm_scores.fk_customer_id": 1}
