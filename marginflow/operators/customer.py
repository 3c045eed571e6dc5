"""Customer economics: first order, 90-day window, customer summary, cohorts, lifetime.

Populations: the 90-day analysis uses completed orders only; lifetime uses all orders.
The acquisition date of the 90-day analysis is the customer's first *completed* order.
The window is half-open: an order on day 90 after acquisition is outside.

Scale: per-customer results are grouped aggregates (map-side partial aggregation, so a
customer with a huge share of the orders is pre-combined before the shuffle).  The only
true ordering, ``purchase_number``, is numbered on two levels (``number_by_day``).  The
summary works on rows combined per customer and day, the exact cohort median selects by
digits among counted margins, so neither orders nor customers of a group meet in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of, round_half_up, round_money
from ..session import scratch_dir
from .ranking import median_by_digits, number_by_day

WINDOW_DAYS = 90
COMPLETED = "completed"


def _first_completed(orders: DataFrame) -> DataFrame:
    """Per customer: first completed order date and order count (hash aggregation)."""
    return orders.where(F.col("order_status") == COMPLETED).groupBy("customer_id").agg(
        F.min("order_date").alias("acquisition_date"), F.count(F.lit(1)).alias("_n"))


def first_orders(orders: DataFrame) -> DataFrame:
    """First completed order date per customer (``acquisition_date``)."""
    return _first_completed(orders).select("customer_id", "acquisition_date")


def customer_orders_90d(orders: DataFrame) -> DataFrame:
    """Completed orders within 90 days of acquisition, numbered per customer by date, order id."""
    completed = orders.where(F.col("order_status") == COMPLETED).select(
        "customer_id", "order_id", "order_date", "market", "acquisition_channel", "net_revenue", "contribution_margin")
    numbered = number_by_day(completed, "customer_id", "order_date", "order_id", out="purchase_number",
                             first="acquisition_date", within=WINDOW_DAYS)
    return numbered.select(
        "customer_id", "acquisition_date", "order_id", "order_date", "market", "acquisition_channel",
        F.col("net_revenue").cast("double").alias("net_revenue"),
        F.col("contribution_margin").cast("double").alias("contribution_margin"),
        "purchase_number")


def _customer_summary_exact(orders: DataFrame) -> DataFrame:
    """Customer summary with exact decimal sums (shared by the summary and the cohorts).

    Completed orders are combined (map-side first) to one row per customer, day, market and
    channel; a customer has no more of these than the calendar allows, however many orders.
    Acquisition date, first order and the 90-day filter follow on those rows.
    """
    days = (orders.where(F.col("order_status") == COMPLETED)
            .groupBy("customer_id", "order_date", "market", "acquisition_channel")
            .agg(F.sum("net_revenue").alias("_rev"), F.sum("contribution_margin").alias("_cm"),
                 F.count(F.lit(1)).alias("_n"), F.min("order_id").alias("_least_id")))
    own = Window.partitionBy("customer_id")
    first = F.min(F.struct("order_date", "_least_id")).over(own)
    inside = days.withColumn("_first", first).where(
        F.col("order_date") < F.date_add(F.col("_first.order_date"), WINDOW_DAYS))
    g = inside.groupBy("customer_id", F.col("_first.order_date").alias("acquisition_date"), "market",
                       "acquisition_channel").agg(
        F.sum("_rev").alias("revenue_90d"), F.sum("_cm").alias("contribution_margin_90d"),
        F.sum("_n").alias("orders_90d"), F.min("_least_id").alias("_some_order"),
        F.min("_first._least_id").alias("_first_order"))
    # A later purchase is in the group if it has two orders, or one that is not the first.
    repeated = F.when((F.col("orders_90d") >= 2) | (F.col("_some_order") != F.col("_first_order")), 1).otherwise(0)
    return g.select("customer_id", "acquisition_date", "market", "acquisition_channel", "revenue_90d",
                    "contribution_margin_90d", F.col("orders_90d").cast("bigint").alias("orders_90d"),
                    repeated.cast("int").alias("repeated_90d"))


def customer_90d(orders: DataFrame) -> DataFrame:
    """Per customer (and order-level market / channel): 90-day revenue, margin, orders, repeat flag."""
    s = _customer_summary_exact(orders)
    return s.select("customer_id", "acquisition_date", "market", "acquisition_channel",
                    F.col("revenue_90d").cast("double").alias("revenue_90d"),
                    F.col("contribution_margin_90d").cast("double").alias("contribution_margin_90d"),
                    "orders_90d", "repeated_90d")


COHORT_KEYS = ["acquisition_month", "market", "acquisition_channel"]


def _cohort_rows(orders: DataFrame) -> DataFrame:
    return _customer_summary_exact(orders).select(
        F.trunc(F.col("acquisition_date"), "month").alias("acquisition_month"), "market", "acquisition_channel",
        "revenue_90d", "contribution_margin_90d", "repeated_90d")


def cohort_profitability_90d(orders: DataFrame) -> DataFrame:
    """Acquisition cohorts (month x market x channel): size, 90-day means, repeat rate, exact median margin.

    Margins are cents and repeat, so customers are counted per (cohort, margin) first; means add up
    these rows, and the median is selected among them by digits, so no task holds a cohort.  Three
    steps read these rows, so they are written to the scratch folder when the function is called.
    """
    values = _cohort_rows(orders).groupBy(*COHORT_KEYS, "contribution_margin_90d").agg(
        F.count(F.lit(1)).alias("_n"), F.count("contribution_margin_90d").alias("_n_cm"),
        F.sum("contribution_margin_90d").alias("_cm"),
        F.sum("revenue_90d").alias("_rev"), F.count("revenue_90d").alias("_n_rev"),
        F.sum("repeated_90d").alias("_rep"), F.count("repeated_90d").alias("_n_rep"))
    path = f"{scratch_dir(orders.sparkSession)}/cohorts/{uuid.uuid4().hex}"
    values.write.parquet(path)
    values = orders.sparkSession.read.schema(values.schema).parquet(path)
    g = values.groupBy(*COHORT_KEYS).agg(
        F.sum("_n").alias("acquired_customers"), F.sum("_rev").alias("_rev"), F.sum("_n_rev").alias("_n_rev"),
        F.sum("_cm").alias("_cm"), F.sum("_n_cm").alias("_n_cm"), F.sum("_rep").alias("_rep"),
        F.sum("_n_rep").alias("_n_rep"))
    cents = values.withColumn("_cents", (F.col("contribution_margin_90d") * 100).cast("bigint"))
    middle = median_by_digits(cents, COHORT_KEYS, "_cents", "_n_cm").select(
        *[F.col(c).alias(f"_{c}") for c in COHORT_KEYS], "low", "high")
    same = [g[c].eqNullSafe(middle[f"_{c}"]) for c in COHORT_KEYS]
    return g.join(middle, same, "left").select(
        *COHORT_KEYS, F.col("acquired_customers").cast("bigint").alias("acquired_customers"),
        mean_of(F.col("_rev"), F.col("_n_rev")).alias("avg_revenue_90d"),
        mean_of(F.col("_cm"), F.col("_n_cm")).alias("avg_contribution_margin_90d"),
        mean_of(F.col("_rep"), F.col("_n_rep")).alias("repeat_purchase_rate_90d"),
        # Midpoints of cent values have at most three decimals: four keep them exact.
        round_half_up(((F.col("low") + F.col("high")) / F.lit(200)).cast("double"), 4)
        .alias("median_contribution_margin_90d"))


def cohort_median_90d_approx(orders: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Cohort medians by ``percentile_approx``: a bounded sketch per cohort, rank error about 1 / accuracy."""
    return _cohort_rows(orders).groupBy(*COHORT_KEYS).agg(F.percentile_approx(
        F.col("contribution_margin_90d").cast("double"), 0.5, accuracy).alias("median_contribution_margin_90d"))


def customer_lifetime(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Lifetime per customer over all orders; customers without orders keep 0 orders, NULL sums."""
    per = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("latest_order_date"),
        F.count(F.lit(1)).alias("lifetime_orders"),  # order_id is the key, checked after every build
        F.sum("net_revenue").alias("_rev"),
        F.sum("contribution_margin").alias("_cm"),
    )
    c = customers.select("customer_id", "prospect_id", "market", "acquisition_channel")
    j = c.join(per, "customer_id", "left")
    return j.select(
        "customer_id", "prospect_id", "market", "acquisition_channel", "first_order_date", "latest_order_date",
        F.coalesce(F.col("lifetime_orders"), F.lit(0)).cast("bigint").alias("lifetime_orders"),
        round_money(F.col("_rev")).alias("lifetime_net_revenue"),
        round_money(F.col("_cm")).alias("lifetime_contribution_margin"),
        F.datediff(F.col("latest_order_date"), F.col("first_order_date")).cast("int").alias("active_span_days"))
