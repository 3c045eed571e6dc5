"""Properties: the scale rewrites equal the definitions over plain rows; totals reconcile across marts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMOKE
from frames import orders, prospects
from marginflow.operators import marts, staging
from marginflow.plans.warehouse import warehouse

CHANNELS = ["CRM", "Affiliate", "Organic Search"]


def _joined_rows(ps, os_):
    """The definition over plain rows: each prospect beside each of its orders, or beside none."""
    out = {}
    for pid, _, channel, converted in ps:
        mine = [o for o in os_ if o[2] == pid] or [None]
        g = out.setdefault(channel, {"ids": set(), "flags": [], "orders": set(), "rev": 0, "cm": 0})
        g["ids"].add(pid)
        for o in mine:
            g["flags"].append(converted)
            if o:
                g["orders"].add(o[0])
                g["rev"] += round(o[7] * 100)
                g["cm"] += round(o[8] * 100)
    return out


@st.composite
def commerce(draw):
    n = draw(st.integers(1, 8))
    ps, os_ = [], []
    for i in range(n):
        k = draw(st.integers(0, 4))
        ps.append((f"P{i}", "LV", draw(st.sampled_from(CHANNELS)), 1 if k else draw(st.integers(0, 1))))
        for j in range(k):
            cents = draw(st.integers(-5000, 5000))
            os_.append((f"O{i}_{j}", f"C{i}", f"P{i}", dt.date(2025, 1, 1 + j), "LV", ps[-1][2], "completed",
                        abs(cents) / 100, cents / 100))
    return ps, os_


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(commerce())
def test_rewrite_equals_direct_fan_out(spark, data):
    ps, os_ = data
    p, o = prospects(spark, ps), orders(spark, os_)
    ours = {r["acquisition_channel"]: r for r in marts.channel_profitability(p, o).collect()}
    want = _joined_rows(ps, os_)
    assert ours.keys() == want.keys()
    for ch, g in want.items():
        got = ours[ch]
        assert (got["prospects"], got["customers"], got["orders"]) == (len(g["ids"]), sum(g["flags"]), len(g["orders"]))
        assert abs(got["conversion_rate"] - sum(g["flags"]) / len(g["flags"])) <= 0.00005
        assert round(got["net_revenue"] * 100) == g["rev"] and round(got["contribution_margin"] * 100) == g["cm"]


def test_margin_totals_reconcile(spark):
    wh = warehouse(spark, SMOKE)
    raw = wh.orders.agg(F.sum("contribution_margin")).first()[0]
    channel = marts.channel_profitability(wh.prospects, wh.orders).agg(
        F.sum(F.col("contribution_margin").cast("decimal(18,2)"))).first()[0]
    funnel = staging.channel_funnel(staging.stg_prospects(staging.as_text(wh.prospects)),
                                    staging.stg_orders(staging.as_text(wh.orders))).agg(
        F.sum(F.col("contribution_margin").cast("decimal(18,2)"))).first()[0]
    assert raw == channel == funnel


def _early(rows):
    """Completed orders of the first 90 days by customer, in order, with the first day."""
    by = {}
    for r in rows:
        if r[6] == "completed":
            by.setdefault(r[1], []).append(r)
    for c, mine in by.items():
        mine.sort(key=lambda r: (r[3], r[0]))
        first = mine[0][3]
        yield c, first, [r for r in mine if (r[3] - first).days < 90]


@st.composite
def mixed_orders(draw):
    rows = []
    for c in range(draw(st.integers(1, 5))):
        for j in range(draw(st.integers(1, 5))):
            rows.append((f"O{c}_{j}", f"C{c}", f"P{c}", dt.date(2025, 1, 1) + dt.timedelta(days=draw(st.integers(0, 120))),
                         draw(st.sampled_from(["LV", "EE"])), draw(st.sampled_from(CHANNELS[:2])),
                         draw(st.sampled_from(["completed", "completed", "refunded"])),
                         draw(st.integers(0, 500)) / 100, 0))
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(mixed_orders())
def test_customer_90d_equals_window_form(spark, rows):
    from marginflow.operators import customer

    want = {}
    for c, first, mine in _early(rows):
        for nth, r in enumerate(mine, 1):
            g = want.setdefault((c, first, r[4], r[5]), [0, 0, 0])
            g[0] += round(r[7] * 100)
            g[1] += 1
            g[2] |= nth > 1
    got = {(r.customer_id, r.acquisition_date, r.market, r.acquisition_channel):
           [round(r.revenue_90d * 100), r.orders_90d, r.repeated_90d]
           for r in customer.customer_90d(orders(spark, rows)).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(mixed_orders())
def test_purchase_numbers_equal_window_form(spark, rows):
    from marginflow.operators import customer

    got = customer.customer_orders_90d(orders(spark, rows)).select("order_id", "purchase_number").collect()
    want = {r[0]: nth for _, _, mine in _early(rows) for nth, r in enumerate(mine, 1)}
    assert {r.order_id: r.purchase_number for r in got} == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(mixed_orders())
def test_cohort_median_equals_sorted_middle(spark, rows):
    import statistics

    from marginflow.operators import customer

    rows = [(*r[:8], round(r[7] * 7 % 5, 2)) for r in rows]
    margins = {}
    for c, first, mine in _early(rows):
        per = {}
        for r in mine:
            per[r[4], r[5]] = per.get((r[4], r[5]), 0) + round(r[8] * 100)
        for k, cents in per.items():
            margins.setdefault((first.replace(day=1), *k), []).append(cents)
    got = {(r.acquisition_month, r.market, r.acquisition_channel): round(r.median_contribution_margin_90d * 200)
           for r in customer.cohort_profitability_90d(orders(spark, rows)).collect()}
    assert got == {k: round(statistics.median(v) * 2) for k, v in margins.items()}


def test_metric_layer_regroups_consistently(spark):
    from marginflow.operators import metrics

    wh = warehouse(spark, SMOKE)
    fine = metrics.metric_layer(wh.prospects, wh.orders, wh.deliveries)
    coarse = metrics.metric_layer(wh.prospects, wh.orders, wh.deliveries, keys=("market",))
    rolled = {r["market"]: r for r in fine.groupBy("market").agg(
        F.sum("eligible_prospects").alias("e"), F.sum("converted_prospects").alias("c"),
        F.sum(F.col("contribution_margin").cast("decimal(18,2)")).alias("m")).collect()}
    for r in coarse.collect():
        got = rolled[r["market"]]
        assert (r["eligible_prospects"], r["converted_prospects"]) == (got["e"], got["c"])
        assert abs(r["contribution_margin"] - float(got["m"])) < 1e-9


def test_metric_layer_under_any_grouping(spark):
    from marginflow.operators import metrics

    wh = warehouse(spark, SMOKE)
    total = metrics.metric_layer(wh.prospects, wh.orders, wh.deliveries, keys=()).first()
    assert total.eligible_prospects == wh.prospects.count()
    for keys in (("carrier",), ("category",), ("device_type",), ("order_status",), ("market", "carrier"), ("treatment",)):
        rows = metrics.metric_layer(wh.prospects, wh.orders, wh.deliveries, keys, wh.experiment_assignments).collect()
        assert len({tuple(r[k] for k in keys) for r in rows}) == len(rows) > 1
        if "carrier" in keys and len(keys) == 1:  # a carrier does not filter prospects or orders
            assert all(r.eligible_prospects == total.eligible_prospects and r.net_revenue == total.net_revenue for r in rows)
        else:
            assert sum(r.eligible_prospects for r in rows) >= total.eligible_prospects - 1


def test_metric_layer_keeps_null_as_one_row(spark):
    from frames import deliveries
    from marginflow.operators import metrics

    p = prospects(spark, [("P1", "LV", "CRM", 1), ("P2", "LV", "CRM", 0)]).withColumn(
        "market", F.when(F.col("prospect_id") == "P1", F.col("market")))
    o = orders(spark, [("O1", "C1", "P1", dt.date(2025, 1, 1), "LV", "CRM", "completed", 10, 2),
                       ("O2", "C2", "P9", dt.date(2025, 1, 1), "EE", "CRM", "completed", 5, 1)]).withColumn(
        "market", F.when(F.col("order_id") == "O1", F.col("market")))
    rows = metrics.metric_layer(p, o, deliveries(spark, [("O2", "FastShip", 1, 3)]), ("market",)).collect()
    got = {r.market: (r.eligible_prospects, r.net_revenue, r.on_time_delivery_rate) for r in rows}
    assert len(rows) == 2 and got == {"LV": (1, 10.0, None), None: (1, 5.0, 1.0)}
