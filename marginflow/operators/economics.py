"""Order-economics rules as column expressions over order rows.

These are the definitions behind the fact columns (net revenue, contribution margin,
payment cost, attributed marketing, status, delivery promise, peak season, treatment
discount floor).  They are pure projections: no shuffle, codegen-friendly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY

# Order-economics constants.
PAYMENT_RATE, PAYMENT_FIXED = "0.018", "0.20"
REPEAT_MARKETING_SHARE = "0.03"
PROMISE_DAYS = 3
PEAK_MONTHS = (11, 12)
TREATMENT_DISCOUNT_RATE = "0.07"
TREATMENT_DISCOUNT_MIN_GROSS = 55


def _dec(text: str) -> Column:
    scale = len(text.split(".")[1]) if "." in text else 0
    return F.lit(text).cast(f"decimal({len(text.replace('.', ''))},{scale})")


def cents(x: Column) -> Column:
    return F.round(x, 2).cast(MONEY)


def net_revenue(gross: Column, discount: Column, refund: Column) -> Column:
    return (gross - discount - refund).cast(MONEY)


def contribution_margin(net: Column, product: Column, delivery: Column, payment: Column,
                        fulfillment: Column, marketing: Column) -> Column:
    return (net - product - delivery - payment - fulfillment - marketing).cast(MONEY)


def payment_cost(gross: Column) -> Column:
    """A rate and a fixed fee on what is charged.

    A departure from a plain "rate plus fee": where nothing is charged (an order without lines), no fee
    is due, since no payment takes place.
    """
    return F.when(gross > 0, cents(gross * _dec(PAYMENT_RATE) + _dec(PAYMENT_FIXED))).otherwise(_dec("0.00").cast(MONEY))


def attributed_marketing(acquisition_cost: Column, is_first_purchase: Column) -> Column:
    """Full acquisition cost on the first purchase, a fixed share of it on later ones."""
    return F.when(is_first_purchase, acquisition_cost.cast(MONEY)).otherwise(
        cents(acquisition_cost * _dec(REPEAT_MARKETING_SHARE)))


def order_status(refund: Column, gross: Column) -> Column:
    """``completed`` while the refund is below the gross amount, else ``refunded``."""
    return F.when(refund < gross, "completed").otherwise("refunded")


def promised_date(order_date: Column) -> Column:
    return F.date_add(order_date, PROMISE_DAYS)


def on_time(delivered: Column, promised: Column) -> Column:
    return F.when(delivered <= promised, 1).otherwise(0).cast("int")


def peak_season(day: Column) -> Column:
    return F.month(day).isin(*PEAK_MONTHS).cast("int")


def treatment_discount_floor(treatment: Column, gross: Column) -> Column:
    """Minimum discount for treatment orders at or above the gross threshold (else 0)."""
    eligible = (treatment == "treatment") & (gross >= TREATMENT_DISCOUNT_MIN_GROSS)
    return F.when(eligible, cents(gross * _dec(TREATMENT_DISCOUNT_RATE))).otherwise(_dec("0.00").cast(MONEY))


def order_economics(orders: DataFrame) -> DataFrame:
    """Orders with the economics identities re-derived and checked row by row."""
    net = net_revenue(F.col("gross_revenue"), F.col("discount_amount"), F.col("refund_amount"))
    margin = contribution_margin(F.col("net_revenue"), F.col("product_cost"), F.col("delivery_cost"),
                                 F.col("payment_cost"), F.col("fulfillment_cost"),
                                 F.col("attributed_marketing_cost"))
    return orders.select(
        "order_id", "order_status",
        *[F.col(c).cast("double").alias(c) for c in (
            "gross_revenue", "discount_amount", "refund_amount", "product_cost", "delivery_cost",
            "payment_cost", "fulfillment_cost", "attributed_marketing_cost", "net_revenue",
            "contribution_margin")],
        (net == F.col("net_revenue")).cast("int").alias("net_revenue_ok"),
        (margin == F.col("contribution_margin")).cast("int").alias("contribution_margin_ok"),
        (payment_cost(F.col("gross_revenue")) == F.col("payment_cost")).cast("int").alias("payment_cost_ok"),
        (order_status(F.col("refund_amount"), F.col("gross_revenue")) == F.col("order_status"))
        .cast("int").alias("order_status_ok"),
    )


def treatment_discount(orders: DataFrame, assignments: DataFrame) -> DataFrame:
    """Discount after the treatment floor: ``greatest(discount, floor)`` per order."""
    o = orders.select("order_id", "prospect_id", "gross_revenue", "discount_amount")
    a = assignments.select("prospect_id", "treatment")
    # Both sides are plain scans, so AQE splits the shuffle partition of a prospect (or of NULL)
    # that holds a large share of the orders.
    j = o.join(a, "prospect_id", "left")
    floor = treatment_discount_floor(F.col("treatment"), F.col("gross_revenue"))
    return j.select(
        "order_id", "treatment",
        F.col("gross_revenue").cast("double").alias("gross_revenue"),
        F.col("discount_amount").cast("double").alias("discount_amount"),
        floor.cast("double").alias("discount_floor"),
        F.greatest(F.col("discount_amount"), floor).cast("double").alias("adjusted_discount"))


def delivery_service(deliveries: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivery promise, lateness and peak-season flag per order."""
    d = deliveries.select("order_id", "carrier", "delivered_date", "on_time")
    o = orders.select("order_id", "order_date", "market")
    j = d.join(o, "order_id")
    promised = promised_date(F.col("order_date"))
    return j.select(
        "order_id", "carrier", "market", "order_date", promised.alias("promised_date"), "delivered_date",
        on_time(F.col("delivered_date"), promised).alias("on_time"),
        F.datediff(F.col("delivered_date"), promised).cast("int").alias("days_after_promise"),
        peak_season(F.col("order_date")).alias("peak_season"))
