"""Decision marts: channel, market, logistics, experiment and KPI summaries.

Every function takes DataFrames and returns a lazy DataFrame.  Money is summed exactly as
``decimal(18,2)``; outputs are doubles rounded half away from zero.

Roll-ups.  ``prospect_outcomes`` adds up what each prospect did; channel and experiment marts are
grouped sums over it (``*_of``), and a built warehouse stores it, so they read no order.

Channel marts and fan-out.  The parity mart (``channel_profitability``) reproduces a left
join of prospects to orders followed by ``SUM``/``AVG`` of the prospect's 0/1 ``converted``
flag, so a prospect with ``k`` orders counts ``max(k, 1)`` times.  Instead of building the
joined rows, orders are first aggregated per prospect (map-side partial aggregation, one
shuffle on ``prospect_id``) and joined 1:1; the fan-out weights are then
``greatest(k, 1)``.  The result equals the direct join-then-group form when ``order_id``
and ``prospect_id`` are unique (checked after every warehouse build), and it never
materialises the joined rows nor plans an ``Expand`` for two distinct counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import threshold_label
from ..functions.numeric import mean_of, ratio, round_half_up, round_money, single_row


def orders_per_prospect(orders: DataFrame) -> DataFrame:
    """One row per prospect with order count and exact revenue / margin sums."""
    return orders.groupBy("prospect_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("net_revenue").alias("prospect_revenue"),
        F.sum("contribution_margin").alias("prospect_margin"),
    )


def prospect_outcomes(prospects: DataFrame, orders: DataFrame, assignments: DataFrame | None = None) -> DataFrame:
    """One row per prospect: its attributes, its arm, and sums and counts over its orders.

    Sums and counts merge, so every mart by attributes of a prospect rolls this table up.  A
    prospect without orders has zero orders and null sums; without an assignment, a null arm.
    """
    p = prospects.select("prospect_id", "market", "acquisition_channel", "category_interest", "device_type", "converted")
    if assignments is None:
        p = p.withColumn("treatment", F.lit(None).cast("string"))
    else:
        p = p.join(assignments.select("prospect_id", "treatment"), "prospect_id", "left")
    j = p.join(orders_per_prospect(orders), "prospect_id", "left")
    return j.select(*p.columns, F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
                    F.col("prospect_revenue").cast("decimal(28,2)").alias("prospect_revenue"),
                    F.col("prospect_margin").cast("decimal(28,2)").alias("prospect_margin"))


def _channel_mart(outcomes: DataFrame, once: bool) -> DataFrame:
    """Channel mart; each prospect counts once, or as often as a join with its orders repeats it."""
    weight = F.lit(1) if once else F.greatest("order_count", F.lit(1))
    g = outcomes.groupBy("acquisition_channel").agg(
        F.count(F.lit(1)).alias("prospects"),
        F.sum(F.col("converted") * weight).alias("customers"),
        F.sum(weight).alias("_rows"),
        F.sum("order_count").alias("orders"),
        F.sum("prospect_revenue").alias("_rev"),
        F.sum("prospect_margin").alias("_cm"),
    )
    cm = F.coalesce(F.col("_cm"), F.lit(0))
    return g.select(
        "acquisition_channel",
        F.col("prospects").cast("bigint").alias("prospects"),
        F.col("customers").cast("bigint").alias("customers"),
        round_half_up(mean_of(F.col("customers"), F.col("_rows")), 4).alias("conversion_rate"),
        F.col("orders").cast("bigint").alias("orders"),
        round_money(F.coalesce(F.col("_rev"), F.lit(0))).alias("net_revenue"),
        round_money(cm).alias("contribution_margin"),
        round_half_up(ratio(cm, F.col("_rev")), 4).alias("contribution_margin_pct"),
        round_half_up(ratio(cm, F.col("prospects")), 2).alias("margin_per_prospect"),
    )


def channel_profitability_of(outcomes: DataFrame) -> DataFrame:
    """Channel mart, parity definition (conversion weighted by joined order rows)."""
    return _channel_mart(outcomes, once=False)


def channel_profitability_distinct_of(outcomes: DataFrame) -> DataFrame:
    """Channel mart with conversion counted once per prospect (the measure-layer definition)."""
    return _channel_mart(outcomes, once=True)


def channel_profitability(prospects: DataFrame, orders: DataFrame) -> DataFrame:
    return channel_profitability_of(prospect_outcomes(prospects, orders))


def channel_profitability_distinct(prospects: DataFrame, orders: DataFrame) -> DataFrame:
    return channel_profitability_distinct_of(prospect_outcomes(prospects, orders))


def market_profitability(orders: DataFrame) -> DataFrame:
    """Completed orders by market: count, revenue, margin, margin per order."""
    g = (orders.where(F.col("order_status") == "completed")
         .groupBy("market")
         .agg(F.count(F.lit(1)).alias("orders"),  # order_id is the key, checked after every build
              F.sum("net_revenue").alias("_rev"),
              F.sum("contribution_margin").alias("_cm"),
              F.count("contribution_margin").alias("_n")))
    return g.select(
        "market", F.col("orders").cast("bigint").alias("orders"),
        round_money(F.col("_rev")).alias("net_revenue"),
        round_money(F.col("_cm")).alias("contribution_margin"),
        round_half_up(mean_of(F.col("_cm"), F.col("_n")), 2).alias("contribution_margin_per_order"),
    )


def logistics(deliveries: DataFrame, orders: DataFrame) -> DataFrame:
    """Deliveries by carrier x market: count, on-time rate, mean delivery cost (delivery table)."""
    d = deliveries.select("order_id", "carrier", "on_time", "delivery_cost")
    o = orders.select("order_id", "market")
    g = d.join(o, "order_id").groupBy("carrier", "market").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sum("on_time").alias("_on_time"),
        F.count("on_time").alias("_n_on_time"),
        F.sum("delivery_cost").alias("_cost"),
        F.count("delivery_cost").alias("_n_cost"),
    )
    return g.select(
        "carrier", "market", F.col("deliveries").cast("bigint").alias("deliveries"),
        round_half_up(mean_of(F.col("_on_time"), F.col("_n_on_time")), 4).alias("on_time_rate"),
        round_half_up(mean_of(F.col("_cost"), F.col("_n_cost")), 2).alias("avg_delivery_cost"),
    )


def arm_totals(outcomes: DataFrame) -> DataFrame:
    """Exact counts and sums of each arm (every assigned prospect counts, zero-filled)."""
    return outcomes.where(F.col("treatment").isNotNull()).groupBy("treatment").agg(
        F.count(F.lit(1)).alias("assigned_prospects"),
        F.sum("converted").alias("converted_prospects"),
        F.count("converted").alias("_n_conv"),
        F.sum(F.coalesce(F.col("prospect_margin"), F.lit(0))).alias("_cm"),
        F.sum(F.coalesce(F.col("prospect_revenue"), F.lit(0))).alias("_rev"),
    )


def experiment_of(outcomes: DataFrame) -> DataFrame:
    """Experiment mart by arm (intention to treat)."""
    return arm_totals(outcomes).select(
        "treatment",
        F.col("assigned_prospects").cast("bigint").alias("assigned_prospects"),
        F.col("converted_prospects").cast("bigint").alias("converted_prospects"),
        round_half_up(mean_of(F.col("converted_prospects"), F.col("_n_conv")), 4).alias("conversion_rate"),
        round_half_up(mean_of(F.col("_cm"), F.col("assigned_prospects")), 2).alias("margin_per_assigned_prospect"),
        round_half_up(mean_of(F.col("_rev"), F.col("assigned_prospects")), 2).alias("revenue_per_assigned_prospect"),
    )


def experiment(assignments: DataFrame, prospects: DataFrame, orders: DataFrame) -> DataFrame:
    return experiment_of(prospect_outcomes(prospects, orders, assignments))


def kpi_summary(prospects: DataFrame, orders: DataFrame) -> DataFrame:
    """Headline KPIs: prospects, per-prospect conversion (unrounded), revenue, margin (all orders)."""
    p = prospects.agg(F.count(F.lit(1)).alias("prospects"), F.sum("converted").alias("_conv"),
                      F.count("converted").alias("_n"))
    # Order totals as a scalar subquery next to the prospect aggregate.
    o = single_row(orders.agg(F.sum("net_revenue").alias("_rev"), F.sum("contribution_margin").alias("_cm")))
    return p.select(
        F.col("prospects").cast("bigint").alias("prospects"),
        mean_of(F.col("_conv"), F.col("_n")).alias("conversion_rate"),
        round_money(o["_rev"]).alias("net_revenue"),
        round_money(o["_cm"]).alias("contribution_margin"),
    )


def carrier_summary(logistics_mart: DataFrame) -> DataFrame:
    """Per carrier, deliveries-weighted mean of the mart's (rounded) on-time rates."""
    rate = F.col("on_time_rate").cast("decimal(10,4)")
    g = logistics_mart.groupBy("carrier").agg(
        F.sum(rate * F.col("deliveries")).alias("_weighted"), F.sum("deliveries").alias("_n"))
    return g.select("carrier", mean_of(F.col("_weighted"), F.col("_n")).alias("on_time_rate"))


def cover_totals(channel_mart: DataFrame) -> DataFrame:
    """Totals over the channel mart rows (conversion = sum of customers / sum of prospects)."""
    g = channel_mart.agg(
        F.sum("prospects").alias("prospects"), F.sum("customers").alias("_customers"),
        F.sum(F.col("net_revenue").cast("decimal(18,2)")).alias("_rev"),
        F.sum(F.col("contribution_margin").cast("decimal(18,2)")).alias("_cm"),
    )
    return g.select(
        F.col("prospects").cast("bigint").alias("prospects"),
        mean_of(F.col("_customers"), F.col("prospects")).alias("conversion_rate"),
        F.col("_rev").cast("double").alias("net_revenue"),
        F.col("_cm").cast("double").alias("contribution_margin"),
    )


# Decision thresholds on margin per prospect.
SCALE_ABOVE, PROTECT_ABOVE = 2, 0


def channel_decision(channel_mart: DataFrame) -> DataFrame:
    """Scale / Protect / Fix label per channel from its margin per prospect."""
    label = threshold_label(F.col("margin_per_prospect"), [(SCALE_ABOVE, "Scale"), (PROTECT_ABOVE, "Protect")],
                            "Fix / Pause")
    return channel_mart.select("acquisition_channel", "margin_per_prospect", label.alias("decision"))
