"""Analyst queries over the marts: channel ranking, carrier trade-off, ITT comparison.

The marts are small by construction (one row per channel, per carrier x market, per arm),
so the "whole table" windows of the analyst SQL (``RANK() OVER (ORDER BY ...)``,
``AVG(...) OVER ()``) run as windows over the mart's few rows (its row count is bounded by
the channel, carrier x market and arm domains) - never as an unpartitioned window over a fact
table, and without computing the mart twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of


def channel_rank(channel_mart: DataFrame) -> DataFrame:
    """Channels ranked by contribution margin (1 = best).

    The mart has one row per acquisition channel (a fixed, small domain), so the global
    ordering window runs over a handful of rows.
    """
    w = Window.orderBy(F.col("contribution_margin").desc())
    return channel_mart.select(
        "acquisition_channel", "orders", "net_revenue", "contribution_margin", "contribution_margin_pct",
        F.rank().over(w).cast("int").alias("profitability_rank"))


def channel_rank_report(channel_mart: DataFrame) -> DataFrame:
    """The ranking, best channel first."""
    return channel_rank(channel_mart).orderBy("profitability_rank", "acquisition_channel")


def carrier_tradeoff_report(logistics_mart: DataFrame) -> DataFrame:
    """The trade-off, least punctual first."""
    return carrier_tradeoff(logistics_mart).orderBy("on_time_rate", "market", "carrier")


def carrier_tradeoff(logistics_mart: DataFrame) -> DataFrame:
    """Cost and reliability of each carrier x market relative to the unweighted mart mean.

    The mart has one row per carrier x market (fixed domains), so the whole-mart window is
    a handful of rows; the mean is exact (decimal sum / count).
    """
    every = Window.partitionBy()
    mean_cost = mean_of(F.sum(F.col("avg_delivery_cost").cast("decimal(18,2)")).over(every),
                        F.count("avg_delivery_cost").over(every))
    mean_rate = mean_of(F.sum(F.col("on_time_rate").cast("decimal(10,4)")).over(every),
                        F.count("on_time_rate").over(every))
    return logistics_mart.select(
        "market", "carrier", "deliveries", "on_time_rate", "avg_delivery_cost",
        (F.col("avg_delivery_cost") - mean_cost).alias("cost_vs_average"),
        (F.col("on_time_rate") - mean_rate).alias("reliability_vs_average"))


def experiment_itt(mart: DataFrame) -> DataFrame:
    """Arm rows with the margin lift over the control arm (window over the arm rows)."""
    control = F.max(F.when(F.col("treatment") == "control", F.col("margin_per_assigned_prospect")))
    return mart.select(
        "treatment", "assigned_prospects", "converted_prospects", "conversion_rate",
        "margin_per_assigned_prospect",
        (F.col("margin_per_assigned_prospect") - control.over(Window.partitionBy())).alias("margin_lift_vs_control"))
