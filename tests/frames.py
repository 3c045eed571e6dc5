"""Small hand-made commerce frames with the declared schemas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from marginflow import schemas

D = dt.date


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def prospects(spark, rows):
    """rows: (prospect_id, market, channel, converted)."""
    data = [(pid, mkt, ch, "Home", "mobile", 0.5, D(2025, 1, 1), conv) for pid, mkt, ch, conv in rows]
    return spark.createDataFrame(data, schemas.TABLES["dim_prospect"])


def customers(spark, rows):
    """rows: (customer_id, prospect_id, market, channel, acquisition_date)."""
    return spark.createDataFrame(rows, schemas.TABLES["dim_customer"])


def orders(spark, rows):
    """rows: (order_id, customer_id, prospect_id, order_date, market, channel, status, net, margin)."""
    data = []
    for oid, cid, pid, day, mkt, ch, status, net, margin in rows:
        z = money(0)
        data.append((oid, cid, pid, day, mkt, ch, "Home", status, money(net), z, z, z, z, z, z, z,
                     money(net), money(margin)))
    return spark.createDataFrame(data, schemas.TABLES["fct_orders"])


def deliveries(spark, rows):
    """rows: (order_id, carrier, on_time, cost)."""
    data = [(oid, car, D(2025, 1, 4), D(2025, 1, 4), ot, money(cost)) for oid, car, ot, cost in rows]
    return spark.createDataFrame(data, schemas.TABLES["fct_deliveries"])


def assignments(spark, rows):
    """rows: (prospect_id, treatment)."""
    data = [(pid, "exp", arm, D(2025, 1, 1)) for pid, arm in rows]
    return spark.createDataFrame(data, schemas.TABLES["fct_experiment_assignments"])


def spend(spark, rows):
    """rows: (month, market, channel, spend)."""
    return spark.createDataFrame([(m, mk, ch, money(s)) for m, mk, ch, s in rows],
                                 schemas.TABLES["fct_marketing_spend"])
