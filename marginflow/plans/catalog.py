"""Named queries: each takes ``(spark, data_dir)`` and returns a lazy DataFrame.

A query reads the commerce tables derived from the driver tables of ``data_dir`` and composes
operators; nothing is collected to the driver.  Jobs that run when a query is *called*
(before its DataFrame is returned): the warehouse build on the first call per session and state
of the inputs, and, once per build, the CSV extracts that ``stg_*`` and ``load_*`` read - all written
to the shared scratch folder - and what a load asks of these extracts (headers, quotes).
``QUERIES`` is what ``__spark_entry__.queries()`` exposes and what ``bench.py`` times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import analysis, customer, economics, marts, metrics, quality, staging, stats
from ..sources import csv
from ..sources.adapter import CommerceModel
from .warehouse import warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def model(spark: SparkSession, data_dir: str):
    """Commerce tables for a query.

    Default: the warehouse built once per session and data directory (``warehouse.py``).
    With ``spark.conf marginflow.model=lazy`` the tables are derived inside each query's
    own plan instead (one plan from the raw tables, used to inspect end-to-end plans).
    """
    if spark.conf.get("marginflow.model", "warehouse") == "lazy":
        return CommerceModel(spark, data_dir)
    return warehouse(spark, data_dir)


# ---- marts ----
@query("channel_profitability")
def q_channel_profitability(spark, d):
    return marts.channel_profitability_of(model(spark, d).prospect_outcomes)


@query("channel_profitability_distinct")
def q_channel_profitability_distinct(spark, d):
    return marts.channel_profitability_distinct_of(model(spark, d).prospect_outcomes)


@query("market_profitability")
def q_market_profitability(spark, d):
    return marts.market_profitability(model(spark, d).orders)


@query("logistics")
def q_logistics(spark, d):
    m = model(spark, d)
    return marts.logistics(m.deliveries, m.orders)


@query("experiment")
def q_experiment(spark, d):
    return marts.experiment_of(model(spark, d).prospect_outcomes)


@query("kpi_summary")
def q_kpi_summary(spark, d):
    m = model(spark, d)
    return marts.kpi_summary(m.prospects, m.orders)


@query("carrier_summary")
def q_carrier_summary(spark, d):
    return marts.carrier_summary(q_logistics(spark, d))


@query("cover_totals")
def q_cover_totals(spark, d):
    return marts.cover_totals(q_channel_profitability(spark, d))


@query("channel_decision")
def q_channel_decision(spark, d):
    return marts.channel_decision(q_channel_profitability(spark, d))


# ---- experiment inference ----
@query("experiment_stats")
def q_experiment_stats(spark, d):
    return stats.experiment_statistics(q_experiment(spark, d))


@query("experiment_stats_exact")
def q_experiment_stats_exact(spark, d):
    return stats.experiment_statistics_exact(model(spark, d).prospect_outcomes)


@query("experiment_decision")
def q_experiment_decision(spark, d):
    return stats.experiment_decision(q_experiment_stats(spark, d))


@query("experiment_comparison")
def q_experiment_comparison(spark, d):
    return stats.experiment_comparison(q_experiment(spark, d))


# ---- analyst SQL over marts ----
@query("channel_rank")
def q_channel_rank(spark, d):
    return analysis.channel_rank(q_channel_profitability(spark, d))


@query("carrier_tradeoff")
def q_carrier_tradeoff(spark, d):
    return analysis.carrier_tradeoff(q_logistics(spark, d))


@query("experiment_itt")
def q_experiment_itt(spark, d):
    return analysis.experiment_itt(q_experiment(spark, d))


# ---- customer economics ----
@query("first_orders")
def q_first_orders(spark, d):
    return customer.first_orders(model(spark, d).orders)


@query("customer_orders_90d")
def q_customer_orders_90d(spark, d):
    return customer.customer_orders_90d(model(spark, d).orders)


@query("customer_90d")
def q_customer_90d(spark, d):
    return customer.customer_90d(model(spark, d).orders)


@query("cohort_profitability_90d")
def q_cohort_profitability_90d(spark, d):
    return customer.cohort_profitability_90d(model(spark, d).orders)


@query("customer_lifetime")
def q_customer_lifetime(spark, d):
    m = model(spark, d)
    return customer.customer_lifetime(m.customers, m.orders)


# ---- staging models over text extracts, funnel, metric layer ----
@query("stg_customers")
def q_stg_customers(spark, d):
    return staging.stg_customers(staging.load_extract(model(spark, d), "dim_customer"))


@query("stg_orders")
def q_stg_orders(spark, d):
    return staging.stg_orders(staging.load_extract(model(spark, d), "fct_orders"))


@query("stg_prospects")
def q_stg_prospects(spark, d):
    return staging.stg_prospects(staging.load_extract(model(spark, d), "dim_prospect"))


@query("channel_funnel")
def q_channel_funnel(spark, d):
    return staging.channel_funnel(q_stg_prospects(spark, d), q_stg_orders(spark, d))


@query("metric_layer")
def q_metric_layer(spark, d):
    m = model(spark, d)
    return metrics.metric_layer(m.prospects, m.orders, m.deliveries)


@query("metric_layer_total")
def q_metric_layer_total(spark, d):
    m = model(spark, d)
    return metrics.metric_layer(m.prospects, m.orders, m.deliveries, keys=())


@query("metric_layer_by_carrier")
def q_metric_layer_by_carrier(spark, d):
    m = model(spark, d)
    return metrics.metric_layer(m.prospects, m.orders, m.deliveries, keys=("carrier",))


@query("metric_layer_by_category_device")
def q_metric_layer_by_category_device(spark, d):
    m = model(spark, d)
    return metrics.metric_layer(m.prospects, m.orders, m.deliveries, keys=("category", "device_type"))


SUBTOTAL_KEYS = ("market", "device_type", "carrier")


@query("metric_layer_subtotals")
def q_metric_layer_subtotals(spark, d):
    m = model(spark, d)
    return metrics.metric_layer_subtotals(m.prospects, m.orders, m.deliveries, keys=SUBTOTAL_KEYS)


# ---- order economics ----
@query("order_economics")
def q_order_economics(spark, d):
    return economics.order_economics(model(spark, d).orders)


@query("treatment_discount")
def q_treatment_discount(spark, d):
    m = model(spark, d)
    return economics.treatment_discount(m.orders, m.experiment_assignments)


@query("delivery_service")
def q_delivery_service(spark, d):
    m = model(spark, d)
    return economics.delivery_service(m.deliveries, m.orders)


@query("marketing_spend")
def q_marketing_spend(spark, d):
    s = model(spark, d).marketing_spend
    return s.select("month", "market", "channel", s.spend.cast("double").alias("spend"))


# ---- data quality ----
def _observed(m) -> dict | None:
    """What the warehouse build has observed while it wrote the tables; None for a lazy model."""
    return getattr(m, "observed", None)


def _tables(spark, d):
    m = model(spark, d)
    return {name: m.table(name) for name in schemas.TABLES}


@query("dq_unique_keys")
def q_dq_unique_keys(spark, d):
    return quality.unique_keys(_tables(spark, d))


@query("dq_not_null")
def q_dq_not_null(spark, d):
    return quality.not_null(_tables(spark, d))


@query("dq_accepted_values")
def q_dq_accepted_values(spark, d):
    return quality.accepted_values(_tables(spark, d))


@query("dq_ranges")
def q_dq_ranges(spark, d):
    return quality.ranges(_tables(spark, d))


@query("dq_orphans")
def q_dq_orphans(spark, d):
    return quality.orphans(_tables(spark, d))


@query("dq_reconciliation")
def q_dq_reconciliation(spark, d):
    m = model(spark, d)
    return quality.reconciliation(m.orders, marts.channel_profitability_of(m.prospect_outcomes), _observed(m))


@query("dq_experiment_health")
def q_dq_experiment_health(spark, d):
    m = model(spark, d)
    return quality.experiment_health(m.prospects, marts.experiment_of(m.prospect_outcomes), _observed(m))


@query("dq_report")
def q_dq_report(spark, d):
    m = model(spark, d)
    tables = {name: m.table(name) for name in schemas.TABLES}
    outcomes = m.prospect_outcomes
    return quality.report(tables, marts.channel_profitability_of(outcomes), marts.experiment_of(outcomes), _observed(m))


@query("dq_seeded_faults")
def q_dq_seeded_faults(spark, d):
    """The table checks over tables into which faults are put by rule, so that every check fires."""
    t = _tables(spark, d)
    odd = lambda key, n: F.pmod(F.substring(key, 2, 20).cast("bigint"), F.lit(n)) == 0
    p, c, o, dl = (t[n] for n in ("dim_prospect", "dim_customer", "fct_orders", "fct_deliveries"))
    t["dim_prospect"] = (p.where(~odd("prospect_id", 11))
                         .withColumn("market", F.when(odd("prospect_id", 7), F.lit("XX")).otherwise(F.col("market")))
                         .withColumn("converted", F.when(odd("prospect_id", 13), F.lit(2)).otherwise(F.col("converted")))
                         .withColumn("engagement_score", F.col("engagement_score") + F.when(
                             odd("prospect_id", 17), F.lit(1.5)).otherwise(F.lit(0.0))))
    t["dim_customer"] = c.where(~odd("customer_id", 5))
    t["fct_orders"] = o.union(o.where(odd("order_id", 19))).withColumn(
        "category", F.when(odd("order_id", 23), F.lit(None)).otherwise(F.col("category")))
    t["fct_deliveries"] = dl.withColumn(
        "order_id", F.when(odd("order_id", 29), F.concat(F.lit("X"), "order_id")).otherwise(F.col("order_id")))
    return quality.table_checks(t)


# ---- CSV: typed load by column name from the build's extracts ----
def _loaded(spark, d, table: str):
    m = warehouse(spark, d)
    return csv.load_typed_csv(spark, m.extract(table), table)


@query("load_prospects")
def q_load_prospects(spark, d):
    return _loaded(spark, d, "dim_prospect")


@query("load_orders")
def q_load_orders(spark, d):
    loaded = _loaded(spark, d, "fct_orders")
    money_cols = [f.name for f in schemas.TABLES["fct_orders"].fields if str(f.dataType).startswith("Decimal")]
    return loaded.select(*[F.col(c).cast("double").alias(c) if c in money_cols else F.col(c)
                           for c in loaded.columns])
