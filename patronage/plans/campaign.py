"""Campaign targeting, ROI and acquisition-cost summaries.

Input is the customer master under notebook rules (one row per customer).
The 10-row campaign matrix is compiled into CASE lookups, so no join is
needed; every summary is one grouped or global aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage import config
from patronage.functions.rounding import round_half_up
from patronage.functions.rules import lookup_col, roi_band_col
from patronage.plans import scores
from patronage.plans.scores import np_round
from patronage.sources.tables import Tables

TARGET_COLUMNS = ["customer_id", "rfm_segment", "clv_segment", "campaign_name", "campaign_cost",
                  "clv_12m", "expected_revenue", "priority_tier"]


def _matrix(col: str, field: int, default) -> Column:
    return lookup_col(col, [(row[0], row[field]) for row in config.CAMPAIGN_MATRIX], default)


def with_campaign(master: DataFrame) -> DataFrame:
    """Campaign, cost and expected revenue; the priority tier if there are CLV tiers."""
    name, cost, uplift = config.CAMPAIGN_FALLBACK
    seg = "rfm_segment"
    tiered = "clv_segment" in master.columns
    tier = [lookup_col("clv_segment", [(x, x) for x in config.TIER_ORDER], "Low").alias("priority_tier")] if tiered else []
    return master.select(
        "customer_id", "rfm_segment", *(["clv_segment"] if tiered else []),
        _matrix(seg, 1, name).alias("campaign_name"),
        _matrix(seg, 2, cost).cast("int").alias("campaign_cost"),
        "clv_12m",
        np_round(F.col("clv_12m") * _matrix(seg, 3, uplift), 2).alias("expected_revenue"), *tier)


def campaign_targets(t: Tables) -> DataFrame:
    """Q-34: campaign, cost, expected revenue and priority tier per customer."""
    return with_campaign(scores.notebook_master(t)).select(*TARGET_COLUMNS)


def _money(col: str) -> Column:
    return F.sum(F.col(col).cast("decimal(18,2)"))


def campaign_roi(t: Tables) -> DataFrame:
    """Q-35: per segment and campaign — customers, cost, average CLV,
    expected revenue, ROI % and its band."""
    targets = with_campaign(scores.notebook_master(t, tiers=False))
    agg = targets.groupBy("rfm_segment", "campaign_name").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("campaign_cost").cast("bigint").alias("total_cost"),
        (_money("clv_12m").cast("double") / F.count("clv_12m")).alias("avg_clv"),
        _money("expected_revenue").alias("total_expected"))
    roi = np_round((F.col("total_expected").cast("double") - F.col("total_cost"))
                   / F.col("total_cost") * 100, 1)
    out = agg.select("rfm_segment", "campaign_name", "customers", "total_cost",
                     round_half_up(F.col("avg_clv"), 6).alias("avg_clv"),
                     F.col("total_expected").cast("decimal(18,2)").alias("total_expected"),
                     roi.alias("roi_pct"))
    return out.withColumn("roi_band", roi_band_col("roi_pct"))


def cac_reduction(t: Tables) -> DataFrame:
    """Q-36: blanket vs targeted campaign cost and total incremental revenue."""
    targets = with_campaign(scores.notebook_master(t, tiers=False))
    agg = targets.agg(F.count(F.lit(1)).alias("customers"),
                      F.sum("campaign_cost").cast("bigint").alias("targeted_total"),
                      _money("expected_revenue").alias("incremental"))
    blanket = F.col("customers") * config.BLANKET_COST_PER_CUSTOMER
    return agg.select(
        "customers", blanket.cast("bigint").alias("blanket_total"), "targeted_total",
        np_round((blanket - F.col("targeted_total")) / blanket * 100, 1).alias("cac_reduction_pct"),
        F.col("incremental").cast("decimal(18,2)").alias("total_incremental_revenue"))


def campaign_cost_by_segment(t: Tables) -> DataFrame:
    """Q-37: per segment — customers, targeted cost, blanket cost, mean cost."""
    targets = with_campaign(scores.notebook_master(t, tiers=False))
    agg = targets.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("campaign_cost").cast("bigint").alias("total_cost"))
    return agg.select(
        "rfm_segment", "customers", "total_cost",
        (F.col("customers") * config.BLANKET_COST_PER_CUSTOMER).cast("bigint").alias("blanket_cost"),
        np_round(F.col("total_cost") / F.col("customers"), 2).alias("avg_cost"))


def segment_counts(t: Tables) -> DataFrame:
    """Q-38: customers per RFM segment, per CLV tier and per priority tier."""
    targets = with_campaign(scores.notebook_master(t))
    long = targets.select(F.expr(
        "stack(3, 'rfm_segment', rfm_segment, 'clv_segment', clv_segment, "
        "'priority_tier', priority_tier) AS (kind, label)"))
    counts = long.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("customers"))
    # display order: tiers in their fixed order (absent tiers drop out), other
    # labels by descending count then label; at most ~15 rows per kind
    tier_pos = lookup_col("label", [(x, i + 1) for i, x in enumerate(config.TIER_ORDER)], None)
    by_count = F.row_number().over(
        Window.partitionBy("kind").orderBy(F.col("customers").desc(), F.col("label")))
    return counts.select("kind", "label", "customers",
                         F.when(F.col("kind") == "priority_tier", tier_pos).otherwise(by_count)
                         .cast("int").alias("position"))


def analysis_footer(t: Tables) -> DataFrame:
    """Q-43: customers, average CLV/AOV/margin, champions and lost counts."""
    m = scores.notebook_master(t, tiers=False)
    return m.agg(
        F.count(F.lit(1)).alias("customers"),
        np_round(_money("clv_12m").cast("double") / F.count("clv_12m"), 2).alias("avg_clv_12m"),
        np_round(_money("avg_order_value").cast("double") / F.count("avg_order_value"), 2)
        .alias("avg_aov"),
        np_round(F.avg("gross_margin_pct") * 100, 1).alias("avg_margin_pct"),
        F.count_if(F.col("rfm_segment") == "Champions").alias("champions"),
        F.count_if(F.col("rfm_segment") == "Lost").alias("lost"))
