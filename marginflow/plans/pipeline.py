"""Full batch rebuild: warehouse -> quality gate -> marts -> reports -> publish.

``run(spark, data_dir, out_dir)`` is the whole refresh in one call, into a fresh version folder:

1. build the warehouse (``warehouse.build_warehouse``: one pass over the line table, the
   six commerce tables and the per-prospect outcomes);
2. compute the quality report and stop on any violation, before any other mart is written
   (``strict=False`` goes on; duplicate keys stop the build in any case);
3. register the staging models as views and write every mart, the funnel included, as Parquet
   with comments (``marts/<name>``) - marts read by several reports (channel, logistics,
   experiment) are materialised first and reused;
4. write the report marts (decision marts, carrier summary, cohorts, funnel, rank and carrier
   trade-off) as single ordered CSV files with a header (``reports/<name>``), ordered as the published reports are;
5. publish the version: readers (``versions.read_mart``, ``warehouse.open_warehouse``) move from the
   whole old version to the whole new one; a run that stops earlier changes nothing for them.

Returns the output paths.  All work is Spark jobs; the driver only sequences them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import analysis, customer, marts, metrics, quality, staging, stats
from ..sources import sinks
from ..sources.tables import input_state
from . import versions
from .views import staging_models
from .warehouse import INPUTS, build_warehouse

# Published report order of the report marts: (column, descending).
REPORT_ORDER = {
    "channel_profitability": [("contribution_margin", True)],
    "market_profitability": [("contribution_margin", True)],
    "logistics": [("carrier", False), ("market", False)],
    "experiment": [("treatment", False)],
    "carrier_summary": [("on_time_rate", True)],
    "channel_funnel": [("acquisition_channel", False)],
    "channel_rank_report": [("profitability_rank", False), ("acquisition_channel", False)],
    "carrier_tradeoff_report": [("on_time_rate", False), ("market", False), ("carrier", False)],
    "cohort_profitability_90d": [("acquisition_month", False), ("market", False), ("acquisition_channel", False)],
}


def _sort_columns(name: str) -> list:
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in REPORT_ORDER[name]]


def run(spark: SparkSession, data_dir: str, out_dir: str, strict: bool = True) -> dict[str, str]:
    base, folder = out_dir.rstrip("/"), versions.fresh_folder(out_dir)
    out = f"{base}/{folder}"
    wh = build_warehouse(spark, data_dir, f"{out}/warehouse")
    tables = {name: wh.table(name) for name in schemas.TABLES}
    p, o, d = wh.prospects, wh.orders, wh.deliveries
    c, outcomes = wh.customers, wh.prospect_outcomes

    paths: dict[str, str] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{out}/marts/{name}"
        paths[name] = path
        return sinks.materialize(df, path, name)

    channel = keep("channel_profitability", marts.channel_profitability_of(outcomes))
    experiment = keep("experiment", marts.experiment_of(outcomes))
    report = keep("quality_report", quality.report(tables, channel, experiment, wh.observed))
    if strict:
        quality.assert_quality(report)
    logistics = keep("logistics", marts.logistics(d, o))
    stages = staging_models(wh)
    for name, df in stages.items():  # views: staging is read, not stored
        schemas.with_comments(df, name).createOrReplaceTempView(name)
    market = keep("market_profitability", marts.market_profitability(o))
    experiment_stats = keep("experiment_stats", stats.experiment_statistics(experiment))
    derived = {
        "channel_profitability_distinct": marts.channel_profitability_distinct_of(outcomes),
        "kpi_summary": marts.kpi_summary(p, o),
        "carrier_summary": marts.carrier_summary(logistics),
        "cover_totals": marts.cover_totals(channel),
        "channel_decision": marts.channel_decision(channel),
        "experiment_decision": stats.experiment_decision(experiment_stats),
        "experiment_comparison": stats.experiment_comparison(experiment),
        "channel_funnel": staging.channel_funnel(stages["stg_prospects"], stages["stg_orders"]),
        "channel_rank": analysis.channel_rank(channel),
        "carrier_tradeoff": analysis.carrier_tradeoff(logistics),
        "experiment_itt": analysis.experiment_itt(experiment),
        "customer_90d": customer.customer_90d(o),
        "cohort_profitability_90d": customer.cohort_profitability_90d(o),
        "customer_lifetime": customer.customer_lifetime(c, o),
        "metric_layer": metrics.metric_layer(p, o, d),
    }
    kept = {name: keep(name, df) for name, df in derived.items()}
    # Small marts only: one row per channel / market / carrier x market / arm / carrier, and
    # per month x market x channel for the cohorts.
    reports = {"channel_profitability": channel, "market_profitability": market, "logistics": logistics,
               "experiment": experiment_stats, "carrier_summary": kept["carrier_summary"],
               "cohort_profitability_90d": kept["cohort_profitability_90d"],
               "channel_funnel": kept["channel_funnel"], "channel_rank_report": kept["channel_rank"],
               "carrier_tradeoff_report": kept["carrier_tradeoff"]}
    for name, df in reports.items():
        path = f"{out}/reports/{name}"
        sinks.write_report_csv(df, path, name, _sort_columns(name))
        paths[f"report:{name}"] = path
    inside = lambda path: path.removeprefix(f"{base}/")
    versions.publish(spark, base, {
        "folder": folder, "buckets": wh.buckets, "observed": wh.observed,
        "tables": {name: inside(path) for name, path in wh.paths.items()},
        "marts": {name: inside(path) for name, path in paths.items() if not name.startswith("report:")},
        "reports": {name[7:]: inside(path) for name, path in paths.items() if name.startswith("report:")}})
    return paths


def main(argv: list[str] | None = None) -> None:
    """``python -m marginflow.plans.pipeline DATA_DIR OUT_DIR [--lenient] [--master local[8]]``."""
    import argparse
    import json

    from ..session import build_session, scale_settings

    parser = argparse.ArgumentParser(description="Full batch rebuild: warehouse, quality, marts, reports.")
    parser.add_argument("data_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--lenient", action="store_true", help="go on when a quality check has violations")
    parser.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    size = sum(f[1] for t in INPUTS for f in input_state(spark, f"{args.data_dir.rstrip('/')}/{t}.parquet"))
    for key, value in scale_settings(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    try:
        print(json.dumps(run(spark, args.data_dir, args.out_dir, strict=not args.lenient), indent=1))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
