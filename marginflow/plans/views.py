"""Temp views over the warehouse: tables, staging models, decision marts and analyst reports.

Views are dropped and recreated on each call and are lazy: each read re-plans the mart, as a
database view is recomputed on read.  Everything is built from the operators; no SQL text.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import schemas
from ..operators import analysis, marts, staging

MART_VIEWS = ("mart_channel_profitability", "mart_market_profitability", "mart_logistics", "mart_experiment")


def staging_models(model) -> dict:
    """Staging models over a model's text extracts (``model.extract``) or tables read as text."""
    def text(table: str):
        return staging.load_extract(model, table)

    return {"stg_customers": staging.stg_customers(text("dim_customer")),
            "stg_orders": staging.stg_orders(text("fct_orders")),
            "stg_prospects": staging.stg_prospects(text("dim_prospect"))}


def register_views(spark: SparkSession, model, prefix: str = "") -> list[str]:
    """Register table, staging, mart and report views for ``model`` (a warehouse or lazy model)."""
    o = model.orders
    channel = marts.channel_profitability_of(model.prospect_outcomes)
    logistics = marts.logistics(model.deliveries, o)
    experiment = marts.experiment_of(model.prospect_outcomes)
    views = {table: model.table(table) for table in schemas.TABLES} | staging_models(model) | {
        "mart_channel_profitability": channel,
        "mart_market_profitability": marts.market_profitability(o),
        "mart_logistics": logistics,
        "mart_experiment": experiment,
        "channel_rank_report": analysis.channel_rank_report(channel),
        "carrier_tradeoff_report": analysis.carrier_tradeoff_report(logistics),
        "experiment_itt_report": analysis.experiment_itt(experiment),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
