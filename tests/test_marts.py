"""Mart semantics on hand-made frames (fan-out, populations, nulls, rounding)."""

import datetime as dt

from pyspark.sql import functions as F

from frames import D, customers, deliveries, orders, prospects
from marginflow.functions.numeric import round_half_up
from marginflow.operators import customer, economics, marts, metrics, staging


def _rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_channel_fan_out_parity_and_distinct(spark):
    p = prospects(spark, [("P1", "LV", "CRM", 0), ("P2", "LV", "CRM", 1), ("P3", "LV", "CRM", 1),
                          ("P4", "LV", "Affiliate", 0)])
    o = orders(spark, [("O1", "C2", "P2", D(2025, 1, 1), "LV", "CRM", "completed", 10, 2),
                       ("O2", "C3", "P3", D(2025, 1, 1), "LV", "CRM", "completed", 10, 2),
                       ("O3", "C3", "P3", D(2025, 1, 2), "LV", "CRM", "completed", 10, 2),
                       ("O4", "C3", "P3", D(2025, 1, 3), "LV", "CRM", "completed", 10, -1)])
    parity = _rows(marts.channel_profitability(p, o), "acquisition_channel")
    crm = parity["CRM"]
    # joined rows: P1 x1, P2 x1, P3 x3 -> customers 4, conversion 4/5
    assert crm["prospects"] == 3 and crm["customers"] == 4 and crm["orders"] == 4
    assert crm["conversion_rate"] == 0.8
    assert crm["net_revenue"] == 40.0 and crm["contribution_margin"] == 5.0
    assert crm["contribution_margin_pct"] == 0.125 and crm["margin_per_prospect"] == 1.67
    aff = parity["Affiliate"]  # channel without orders
    assert aff["net_revenue"] == 0.0 and aff["contribution_margin"] == 0.0
    assert aff["contribution_margin_pct"] is None and aff["margin_per_prospect"] == 0.0
    distinct = _rows(marts.channel_profitability_distinct(p, o), "acquisition_channel")
    assert distinct["CRM"]["customers"] == 2 and distinct["CRM"]["conversion_rate"] == 0.6667


def test_channel_rewrite_has_no_expand(spark):
    p = prospects(spark, [("P1", "LV", "CRM", 1)])
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 1, 1)])
    plan = marts.channel_profitability(p, o)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_market_profitability_completed_only(spark):
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 10, 3),
                       ("O2", "C1", "P1", D(2025, 1, 2), "LV", "CRM", "refunded", 0, -5)])
    r = marts.market_profitability(o).collect()[0]
    assert (r["orders"], r["net_revenue"], r["contribution_margin"], r["contribution_margin_per_order"]) == \
        (1, 10.0, 3.0, 3.0)


def test_ninety_day_window_and_tie_break(spark):
    o = orders(spark, [
        ("O0", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "refunded", 0, 0),     # earlier, refunded
        ("O2", "C1", "P1", D(2025, 1, 10), "LV", "CRM", "completed", 5, 1),   # day 0
        ("O1", "C1", "P1", D(2025, 1, 10), "LV", "CRM", "completed", 5, 1),   # day 0, tie -> first
        ("O3", "C1", "P1", D(2025, 4, 9), "LV", "CRM", "completed", 5, 1),    # day 89 in
        ("O4", "C1", "P1", D(2025, 4, 10), "LV", "CRM", "completed", 5, 1),   # day 90 out
        ("O5", "C2", "P2", D(2025, 2, 1), "EE", "CRM", "completed", 7, 2),    # single order
    ])
    first = _rows(customer.first_orders(o), "customer_id")
    assert first["C1"]["acquisition_date"] == D(2025, 1, 10)
    w = _rows(customer.customer_orders_90d(o), "order_id")
    assert set(w) == {"O1", "O2", "O3", "O5"}
    assert [w[k]["purchase_number"] for k in ("O1", "O2", "O3", "O5")] == [1, 2, 3, 1]
    s = _rows(customer.customer_90d(o), "customer_id")
    assert s["C1"]["orders_90d"] == 3 and s["C1"]["repeated_90d"] == 1 and s["C1"]["revenue_90d"] == 15.0
    assert s["C2"]["repeated_90d"] == 0


def test_repeat_flag_when_group_splits_by_market(spark):
    # The customer's second order has another market: its group holds only purchase 2.
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 5, 1),
                       ("O2", "C1", "P1", D(2025, 1, 5), "EE", "CRM", "completed", 5, 1)])
    s = {(r["customer_id"], r["market"]): r["repeated_90d"] for r in customer.customer_90d(o).collect()}
    assert s == {("C1", "LV"): 0, ("C1", "EE"): 1}


def test_cohort_median_even_and_odd(spark):
    rows = []
    margins = {"LV": [1, 2, 3, 4], "EE": [5, 1, 9]}
    n = 0
    for market, ms in margins.items():
        for m in ms:
            n += 1
            rows.append((f"O{n}", f"C{n}", f"P{n}", D(2025, 3, n), market, "CRM", "completed", 10, m))
    c = _rows(customer.cohort_profitability_90d(orders(spark, rows)), "market")
    assert c["LV"]["median_contribution_margin_90d"] == 2.5
    assert c["EE"]["median_contribution_margin_90d"] == 5.0
    assert c["LV"]["acquired_customers"] == 4 and c["LV"]["acquisition_month"] == D(2025, 3, 1)


def test_customer_lifetime_without_orders(spark):
    c = customers(spark, [("C1", "P1", "LV", "CRM", D(2025, 1, 1)), ("C2", "P2", "LV", "CRM", D(2025, 1, 1))])
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 10, 3),
                       ("O2", "C1", "P1", D(2025, 1, 31), "LV", "CRM", "refunded", 0, -2)])
    r = _rows(customer.customer_lifetime(c, o), "customer_id")
    assert r["C1"]["lifetime_orders"] == 2 and r["C1"]["active_span_days"] == 30
    assert r["C1"]["lifetime_contribution_margin"] == 1.0
    assert r["C2"]["lifetime_orders"] == 0 and r["C2"]["lifetime_net_revenue"] is None
    assert r["C2"]["first_order_date"] is None


def test_funnel_counts_joined_rows(spark):
    p = staging.stg_prospects(staging.as_text(prospects(spark, [("P1", "LV", "CRM", 0), ("P2", "LV", "CRM", 1)])))
    o = staging.stg_orders(staging.as_text(orders(spark, [
        ("O1", "C2", "P2", D(2025, 1, 1), "LV", "CRM", "completed", 10, 2.5),
        ("O2", "C2", "P2", D(2025, 1, 2), "LV", "CRM", "completed", 10, 0.25)])))
    r = staging.channel_funnel(p, o).collect()[0]
    assert (r["prospects"], r["converted_prospects"], r["conversion_rate"], r["contribution_margin"]) == \
        (3, 2, 0.6667, 2.75)
    assert dict(o.dtypes)["net_revenue"] == "double" and dict(o.dtypes)["order_date"] == "string"


def test_metric_layer_no_fan_out(spark):
    p = prospects(spark, [("P1", "LV", "CRM", 1), ("P2", "LV", "CRM", 0)])
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 10, 4),
                       ("O2", "C1", "P1", D(2025, 1, 2), "LV", "CRM", "completed", 10, 4)])
    d = deliveries(spark, [("O1", "FastShip", 1, 5), ("O2", "FastShip", 0, 5)])
    r = metrics.metric_layer(p, o, d).collect()[0]
    assert (r["eligible_prospects"], r["converted_prospects"], r["conversion_rate"]) == (2, 1, 0.5)
    assert (r["net_revenue"], r["contribution_margin"], r["contribution_margin_pct"]) == (20.0, 8.0, 0.4)
    assert (r["margin_per_eligible_prospect"], r["on_time_delivery_rate"]) == (4.0, 0.5)


def test_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (0.285,), (-2.675,), (-0.001,)], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [2.68, 1.01, 0.29, -2.68, 0.0]
    assert str(got[-1]) == "0.0"  # no negative zero


def test_economics_rules(spark):
    df = spark.createDataFrame([(dt.date(2025, 11, 3), "treatment", 60.0), (dt.date(2025, 6, 1), "control", 60.0),
                                (dt.date(2025, 12, 1), "treatment", 40.0)], "d date, arm string, gross double")
    g = F.col("gross").cast("decimal(18,2)")
    r = df.select(economics.payment_cost(g).cast("double").alias("pay"),
                  economics.peak_season(F.col("d")).alias("peak"),
                  economics.treatment_discount_floor(F.col("arm"), g).cast("double").alias("floor"),
                  economics.promised_date(F.col("d")).alias("promised")).collect()
    assert [x["pay"] for x in r] == [1.28, 1.28, 0.92]
    assert [x["peak"] for x in r] == [1, 0, 1]
    assert [x["floor"] for x in r] == [4.2, 0.0, 0.0]
    assert r[0]["promised"] == dt.date(2025, 11, 6)


def test_order_status_rule(spark):
    df = spark.createDataFrame([(10.0, 5.0), (10.0, 10.0), (10.0, 0.0)], "gross double, refund double")
    got = [r[0] for r in df.select(economics.order_status(F.col("refund"), F.col("gross"))).collect()]
    assert got == ["completed", "refunded", "completed"]


def test_cohort_approx_median_option(spark):
    rows = [(f"O{i}", f"C{i}", f"P{i}", D(2025, 3, 1 + i % 20), "LV", "CRM", "completed", 10, i % 7)
            for i in range(60)]
    o = orders(spark, rows)
    exact = customer.cohort_profitability_90d(o).first()["median_contribution_margin_90d"]
    approx = customer.cohort_median_90d_approx(o).first()["median_contribution_margin_90d"]
    assert exact == 3.0 and abs(approx - exact) <= 1.0


def test_clamp(spark):
    from marginflow.functions.numeric import clamp

    df = spark.createDataFrame([(-2.0,), (0.25,), (7.0,), (None,)], "v double")
    assert [r[0] for r in df.select(clamp(F.col("v"), 0.0, 1.0)).collect()] == [0.0, 0.25, 1.0, None]
