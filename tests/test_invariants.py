"""Cross-query invariants on the driver tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronage.plans import cleaning, scores, serving, views
from patronage.sources.tables import Tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return Tables.from_tpch(spark, SF_SMALL)


def test_monetary_sums_to_completed_line_totals(t):
    rfm = scores.rfm_scores(t).agg(F.sum("monetary")).first()[0]
    lines = (t.order_items().join(t.completed_orders().select("invoice_no"), "invoice_no")
             .agg(F.sum("line_total")).first()[0])
    assert rfm == lines


def test_quintile_sizes_differ_by_at_most_one(t):
    rfm = scores.rfm_scores(t)
    for col in ("r_score", "f_score", "m_score"):
        sizes = [r[1] for r in rfm.groupBy(col).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1, col
    tiers = [r[1] for r in scores.clv_scores(t).groupBy("clv_segment").count().collect()]
    assert len(tiers) == 3 and max(tiers) - min(tiers) <= 1


def test_one_order_means_zero_churn(t):
    clv = scores.rfm_clv(t)
    assert clv.where((F.col("frequency") == 1) & (F.col("churn_rate") != 0)).count() == 0


def test_retention_is_full_in_month_zero(t):
    c = serving.cohort_retention(t)
    zero = c.where(F.col("month_number") == 0)
    assert zero.where(F.col("retention_rate_pct") != 100.0).count() == 0
    assert zero.where(F.col("active_customers") != F.col("cohort_size")).count() == 0
    assert c.where(F.col("month_number") < 0).count() == 0


def test_country_clv_total_equals_overall_total(t):
    by_country = serving._country_revenue(t, line_grain=False).agg(F.sum("total_clv_12m")).first()[0]
    overall = serving.clv_overall(t).first()["total_projected_12m"]
    assert by_country == overall


def test_line_grain_counts_each_line(t):
    # line grain weights every customer's CLV by its joined line rows: never below per customer
    a = serving._country_revenue(t, line_grain=True).agg(F.sum("total_clv_12m")).first()[0]
    b = serving._country_revenue(t, line_grain=False).agg(F.sum("total_clv_12m")).first()[0]
    assert a >= b > Decimal(0)


def test_customers_without_completed_orders_stay_in_country_report(t):
    customers = t.customers().count()
    reported = serving._country_revenue(t, line_grain=False).agg(F.sum("total_customers")).first()[0]
    assert reported == customers


def test_waterfall_closes(t):
    steps = sorted(cleaning.cleaning_waterfall(t).collect())
    assert steps[0].rows_remaining - sum(s.rows_removed for s in steps) == steps[-1].rows_remaining
    assert steps[-1].rows_remaining == cleaning.clean_lines(t).count()


def test_views_are_queryable_with_sql(spark, t):
    views.register_views(t)
    n = spark.sql("SELECT count(*) FROM vw_customer_master").first()[0]
    assert n == scores.rfm_clv(t).count()
    months = spark.sql("SELECT count(*) FROM vw_monthly_kpi").first()[0]
    assert months == serving.monthly_kpi(t).count()
    seg = spark.sql("SELECT sum(customer_count) FROM vw_segment_kpi").first()[0]
    assert seg == n
    lines = spark.sql("SELECT count(*) FROM vw_order_details").first()[0]
    assert lines == serving.order_details(t).count()
