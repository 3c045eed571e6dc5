"""Declared schemas, value domains and constraints of the commerce star schema.

The schema is fixed and declared, never inferred.  Money is ``decimal(18,2)`` so that sums
are exact and independent of partitioning; 0/1 flags are integers because marts sum and
average them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType()
M = T.DecimalType(18, 2)

# Value domains of the commerce model.
MARKETS = ["LV", "LT", "EE"]
CHANNELS = ["Paid Search", "Paid Social", "Organic Search", "CRM", "Affiliate"]
CATEGORIES = ["Electronics", "Home", "Beauty", "Sports", "Pet Care"]
CARRIERS = ["BalticPost", "FastShip", "EconomyBox"]
ARMS = ["control", "treatment"]
ORDER_STATUSES = ["completed", "refunded"]
DEVICES = ["mobile", "desktop"]


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


TABLES: dict[str, T.StructType] = {
    "dim_prospect": _struct(
        ("prospect_id", S, False), ("market", S, False), ("acquisition_channel", S, False),
        ("category_interest", S, False), ("device_type", S, False), ("engagement_score", D, False),
        ("assignment_date", DT, False), ("converted", I, False)),
    "dim_customer": _struct(
        ("customer_id", S, False), ("prospect_id", S, False), ("market", S, False),
        ("acquisition_channel", S, False), ("acquisition_date", DT, False)),
    "fct_orders": _struct(
        ("order_id", S, False), ("customer_id", S, False), ("prospect_id", S, False),
        ("order_date", DT, False), ("market", S, False), ("acquisition_channel", S, False),
        ("category", S, False), ("order_status", S, False), ("gross_revenue", M, False),
        ("discount_amount", M, False), ("refund_amount", M, False), ("product_cost", M, False),
        ("delivery_cost", M, False), ("payment_cost", M, False), ("fulfillment_cost", M, False),
        ("attributed_marketing_cost", M, False), ("net_revenue", M, False),
        ("contribution_margin", M, False)),
    "fct_marketing_spend": _struct(
        ("month", DT, False), ("market", S, False), ("channel", S, False), ("spend", M, False)),
    "fct_deliveries": _struct(
        ("order_id", S, False), ("carrier", S, False), ("promised_date", DT, False),
        ("delivered_date", DT, False), ("on_time", I, False), ("delivery_cost", M, False)),
    "fct_experiment_assignments": _struct(
        ("prospect_id", S, False), ("experiment_id", S, False), ("treatment", S, False),
        ("assignment_date", DT, False)),
}

# Load order: dimensions before facts (facts are dropped first on a full refresh).
LOAD_ORDER = ["dim_prospect", "dim_customer", "fct_orders", "fct_deliveries",
              "fct_experiment_assignments", "fct_marketing_spend"]

# Constraint registry (what the warehouse DDL declares).  Used by operators.quality.
PRIMARY_KEYS = {
    "dim_prospect": "prospect_id",
    "dim_customer": "customer_id",
    "fct_orders": "order_id",
    "fct_deliveries": "order_id",
    "fct_experiment_assignments": "prospect_id",
}
UNIQUE_KEYS = {"dim_customer": ["prospect_id"]}
ACCEPTED_VALUES = [
    ("dim_prospect", "market", MARKETS),
    ("dim_customer", "market", MARKETS),
    ("fct_orders", "market", MARKETS),
    ("dim_prospect", "converted", [0, 1]),
    ("fct_deliveries", "on_time", [0, 1]),
    ("fct_experiment_assignments", "treatment", ARMS),
]
RANGES = [  # (table, column, low, high); None = unbounded
    ("dim_prospect", "engagement_score", 0, 1),
    ("fct_orders", "gross_revenue", 0, None),
    ("fct_marketing_spend", "spend", 0, None),
]
FOREIGN_KEYS = [  # (child table, column, parent table, parent column)
    ("dim_customer", "prospect_id", "dim_prospect", "prospect_id"),
    ("fct_orders", "customer_id", "dim_customer", "customer_id"),
    ("fct_orders", "prospect_id", "dim_prospect", "prospect_id"),
    ("fct_deliveries", "order_id", "fct_orders", "order_id"),
    ("fct_experiment_assignments", "prospect_id", "dim_prospect", "prospect_id"),
]


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]


# Marts that have a row for each value of fixed domains (channel, market, carrier, arm, month).
REPORT_MARTS = frozenset({
    "channel_profitability", "market_profitability", "logistics", "experiment", "carrier_summary",
    "cohort_profitability_90d", "channel_funnel", "channel_rank_report", "carrier_tradeoff_report"})

# Documentation, written as table and column comments.
MODEL_DOCS = {
    "dim_prospect": "One row for each person the campaign addressed, converted or not.",
    "dim_customer": "One row for each person with an order.",
    "fct_orders": "One row for each order, with every cost that enters its margin.",
    "fct_deliveries": "One row for each order that was shipped.",
    "fct_experiment_assignments": "The arm that each prospect was drawn into.",
    "fct_marketing_spend": "Spend by month, market and channel.",
    "stg_customers": "Customers as the text extract has them.",
    "stg_orders": "Orders of the text extract, money as numbers.",
    "stg_prospects": "Prospects of the text extract, score and flag as numbers.",
    "channel_funnel": "From addressed to converted to margin, by channel.",
    "channel_profitability": "What a channel's prospects ordered and earned.",
    "channel_profitability_distinct": "The same with each prospect counted once.",
    "market_profitability": "Completed orders by market.",
    "logistics": "Punctuality and cost by carrier and market.",
    "experiment": "Outcome of each arm over all who were assigned.",
    "customer_90d": "What a customer did in the first 90 days.",
    "cohort_profitability_90d": "First 90 days by month of acquisition, market and channel.",
    "customer_lifetime": "All orders of a customer so far.",
    "agg_prospect_outcomes": "What each prospect did: sums and counts that merge.",
    "quality_report": "Violations found by each declared check.",
    "experiment_stats": "The arms with lift, interval, p-values and margin lift.",
    "experiment_decision": "The statistics of the treatment arm alone.",
    "experiment_comparison": "Control and treatment side by side, measure by measure.",
    "experiment_itt": "Outcome of all who were assigned, against control.",
    "kpi_summary": "Headline figures over all prospects and orders.",
    "cover_totals": "Totals of the channel mart.",
    "carrier_summary": "Punctuality of each carrier over all markets.",
    "carrier_tradeoff": "Punctuality and cost of each carrier against the others of its market.",
    "channel_decision": "What to do with each channel.",
    "channel_rank": "Channels by what they earn.",
    "metric_layer": "The reusable measures by market and channel.",
}
COLUMN_DOCS = {
    "prospect_id": "Key of a prospect.", "customer_id": "Key of a customer.", "order_id": "Key of an order.",
    "market": "Country code: LV, LT or EE.", "acquisition_channel": "Channel that brought the prospect in.",
    "channel": "Channel the money was spent on.", "category_interest": "Product group the prospect looked at most.",
    "device_type": "Phone or computer.", "engagement_score": "Interest before any purchase, from 0 to 1.",
    "assignment_date": "Day the campaign began for this prospect.", "converted": "1 if an order followed the campaign.",
    "acquisition_date": "Day of the first order.", "order_date": "Day of the order.", "category": "Product group.",
    "order_status": "refunded once the refund reaches the gross amount, else completed.",
    "gross_revenue": "Charged before any deduction.", "discount_amount": "Granted off the gross amount.",
    "refund_amount": "Paid back.", "product_cost": "Cost of the goods.", "delivery_cost": "Paid to the carrier.",
    "payment_cost": "Paid to the payment provider.", "fulfillment_cost": "Picking and packing.",
    "attributed_marketing_cost": "Share of acquisition spend borne by this order.",
    "net_revenue": "Gross less discount and refund.", "contribution_margin": "Net revenue less all costs listed here.",
    "carrier": "Who delivered.", "promised_date": "Latest day promised.", "delivered_date": "Day of arrival.",
    "on_time": "1 if it came by the promised day.", "experiment_id": "Name of the experiment.",
    "treatment": "Arm: control or treatment.", "month": "First day of the month.", "spend": "Money spent.",
    "prospects": "Prospects (rows joined with orders, in the funnel).", "customers": "Converted, weighted by order rows.",
    "converted_prospects": "How many converted.", "assigned_prospects": "How many were drawn into the arm.",
    "conversion_rate": "Converted per prospect.", "orders": "Number of orders.",
    "contribution_margin_pct": "Margin per unit of net revenue.", "margin_per_prospect": "Margin per prospect.",
    "contribution_margin_per_order": "Mean margin of an order.", "deliveries": "Number of deliveries.",
    "on_time_rate": "Share of deliveries on time.", "avg_delivery_cost": "Mean cost of a delivery.",
    "margin_per_assigned_prospect": "Margin over all assigned.", "revenue_per_assigned_prospect": "Revenue over all assigned.",
    "acquisition_month": "Month of the first completed order.", "acquired_customers": "Customers of the cohort.",
    "avg_revenue_90d": "Mean net revenue of a customer in 90 days.",
    "avg_contribution_margin_90d": "Mean margin of a customer in 90 days.",
    "median_contribution_margin_90d": "Exact median margin of a customer in 90 days.",
    "repeat_purchase_rate_90d": "Share of customers with a later order in 90 days.",
    "revenue_90d": "Net revenue of the first 90 days.", "contribution_margin_90d": "Margin of the first 90 days.",
    "orders_90d": "Orders of the first 90 days.", "repeated_90d": "1 if one of them came after the first.",
    "first_order_date": "Day of the first order.", "latest_order_date": "Day of the last order so far.",
    "lifetime_orders": "Orders so far.", "lifetime_net_revenue": "Net revenue so far.",
    "lifetime_contribution_margin": "Margin so far.", "active_span_days": "Days from the first order to the last.",
    "order_count": "Orders of the prospect.", "prospect_revenue": "Net revenue of these orders.",
    "prospect_margin": "Margin of these orders.",
    "check": "Kind of check.", "table": "Table it looks at.", "column": "Column or reference it looks at.",
    "violations": "Rows, or keys' extra rows, that break it.",
    "conversion_lift_pp": "Treatment's conversion less control's, in percentage points.",
    "conversion_ci_low_pp": "Low end of its 95 % interval.", "conversion_ci_high_pp": "High end of its 95 % interval.",
    "conversion_p_value": "Two-sided p-value of the lift.",
    "margin_lift_vs_control": "Margin per assigned prospect less control's.",
    "cost_vs_average": "Mean delivery cost less the mean over all carriers and markets.",
    "reliability_vs_average": "On-time share less the mean over all carriers and markets.",
    "srm_p_value": "p-value of the arms' sizes under an even split.",
    "metric": "Measure compared.", "control": "Its value in control.", "difference": "Treatment less control.",
    "decision": "Scale, Protect or Fix / Pause, by margin per prospect.",
    "profitability_rank": "1 earns most.", "eligible_prospects": "Prospects in the group.",
    "margin_per_eligible_prospect": "Margin over these prospects.", "on_time_delivery_rate": "Share of deliveries on time.",
}


def missing_docs(name: str, columns: list[str]) -> list[str]:
    """What a written table lacks a text for: its own name, or columns."""
    return [name] * (name not in MODEL_DOCS) + [f"{name}.{c}" for c in columns if c not in COLUMN_DOCS]


def documented(table: str) -> T.StructType:
    """The declared schema with column comments attached as metadata."""
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable, {"comment": COLUMN_DOCS[f.name]})
                         for f in TABLES[table].fields])


def with_comments(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its columns' comments, the first one led by the model's own."""
    out = []
    for i, c in enumerate(df.columns):
        told = ([MODEL_DOCS[name]] if i == 0 and name in MODEL_DOCS else []) + ([COLUMN_DOCS[c]] if c in COLUMN_DOCS else [])
        out.append(F.col(c).alias(c, metadata={"comment": " ".join(told)}) if told else F.col(c))
    return df.select(*out)
