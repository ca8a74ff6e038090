"""Plan checks: native expressions only, pushdown and pruning reach the scan."""

import pytest

import __spark_entry__ as entry
from patronage.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in plan, f"{name}: {node}"


def test_status_filter_and_pruning_reach_scan(spark):
    from patronage.plans import scores
    from patronage.sources.tables import Tables
    t = Tables.from_tpch(spark, SF)
    plan = _plan(scores.rfm_base(t))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    # lineitem is read with only the two columns RFM needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_fact_join_is_not_single_partition(spark):
    from patronage.plans import serving
    from patronage.sources.tables import Tables
    t = Tables.from_tpch(spark, SF)
    plan = serving.monthly_kpi(t)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


SCORED = ["rfm_scores", "rfm_scores_notebook", "clv_scores", "clv_scores_notebook", "customer_clv_master", "segment_matrix",
          "customer_master", "order_details", "clv_histogram", "clv_stats", "rfm_describe", "campaign_targets", "campaign_roi", "score_upsert"]


@pytest.mark.parametrize("name", SCORED)
def test_customers_are_never_ranked_by_one_task(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "Window [" not in plan and "row_number" not in plan


def test_overall_clv_ranks_nothing(spark):
    from patronage.plans import serving
    from patronage.sources.tables import Tables
    plan = _plan(serving.clv_overall(Tables.from_tpch(spark, SF)))
    assert plan.count("ExistingRDD") == 1 and "Window" not in plan  # the margins; nothing was materialised


def test_a_large_margin_table_is_not_hinted(spark, monkeypatch):
    from patronage.sources import tables
    hinted = lambda t: "broadcast" in t.margins()._jdf.queryExecution().logical().toString()
    given = tables.margins_frame(spark)
    assert hinted(tables.Tables.from_star(spark, margins=given)) and hinted(tables.Tables.from_tpch(spark, SF))
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 3)
    assert not hinted(tables.Tables.from_star(spark, margins=given))


def test_notebook_rfm_reads_no_products(spark):
    from patronage.plans import scores
    from patronage.sources.tables import Tables
    t = Tables.from_tpch(spark, SF)
    scores.notebook_base(t, with_clv=False)
    assert "part" not in t._sources


def test_counts_do_not_expand_the_lines(spark):
    for name in ("table_counts", "staging_counts"):
        assert "Expand" not in _plan(entry.queries()[name](spark, SF))
