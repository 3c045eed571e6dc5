"""Staging models over untyped (text) extracts, and the channel funnel built on them.

The raw extracts arrive as text (every column a string, as a seed loader stores them);
staging selects the columns it needs and casts the numeric ones.  Uncast columns stay text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import mean_of, round_half_up, round_money
from ..sources.csv import load_text_csv


def as_text(df: DataFrame) -> DataFrame:
    """Untyped view of an extract: every column cast to string (the seed load)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def load_extract(model, table: str) -> DataFrame:
    """A table's text extract: the written CSV of a built warehouse, else the table as text."""
    if hasattr(model, "extract"):
        return load_text_csv(model.spark, model.extract(table))
    return as_text(model.table(table))


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select("customer_id", "prospect_id", "market", "acquisition_channel", "acquisition_date")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Orders without status and cost columns; revenue and margin cast to double."""
    return raw_orders.select(
        "order_id", "customer_id", "prospect_id", "order_date", "market", "acquisition_channel",
        F.col("net_revenue").cast("double").alias("net_revenue"),
        F.col("contribution_margin").cast("double").alias("contribution_margin"))


def stg_prospects(raw_prospects: DataFrame) -> DataFrame:
    return raw_prospects.select(
        "prospect_id", "market", "acquisition_channel",
        F.col("engagement_score").cast("double").alias("engagement_score"),
        F.col("converted").cast("int").alias("converted"))


def channel_funnel(stg_prospects_df: DataFrame, stg_orders_df: DataFrame) -> DataFrame:
    """Funnel per channel, parity definition: ``prospects`` counts joined prospect-order rows.

    Computed from orders pre-aggregated per prospect; a prospect with ``k`` orders stands
    for ``max(k, 1)`` joined rows.  Margins are summed as exact cents.
    """
    per = stg_orders_df.groupBy("prospect_id").agg(
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.col("contribution_margin").cast("decimal(18,2)")).alias("_cm"))
    p = stg_prospects_df.select("prospect_id", "acquisition_channel", "converted")
    j = p.join(per, "prospect_id", "left").select(
        "acquisition_channel", "converted", "_cm",
        F.greatest(F.coalesce(F.col("_k"), F.lit(0)), F.lit(1)).alias("_rows"))
    g = j.groupBy("acquisition_channel").agg(
        F.sum("_rows").alias("prospects"),
        F.sum(F.col("converted") * F.col("_rows")).alias("converted_prospects"),
        F.sum(F.when(F.col("converted").isNotNull(), F.col("_rows"))).alias("_n_conv"),
        F.sum(F.coalesce(F.col("_cm"), F.lit(0))).alias("_cm"))
    return g.select(
        "acquisition_channel",
        F.col("prospects").cast("bigint").alias("prospects"),
        F.col("converted_prospects").cast("bigint").alias("converted_prospects"),
        round_half_up(mean_of(F.col("converted_prospects"), F.col("_n_conv")), 4).alias("conversion_rate"),
        round_money(F.col("_cm")).alias("contribution_margin"))
