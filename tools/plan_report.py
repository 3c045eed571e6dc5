"""Summarise physical plans as they would run at scale (automatic broadcast disabled).

Usage: python tools/plan_report.py [data_dir] [--lazy] [query ...]
Default: marts over the built warehouse (the production path); --lazy: each query's
plan from the raw tables, ETL included.
Prints per query: shuffles, join kinds, aggregates, windows, Expand, and which tables are scanned.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def summarise(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = sorted(set(re.findall(r"file:[^\]]*/([A-Za-z_]+)(?:\.parquet)?", final)))
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "exchanges": count(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "smj": count(r"SortMergeJoin"), "bhj": count(r"BroadcastHashJoin"), "bnlj": count(r"BroadcastNestedLoopJoin"),
        "window": count(r"Window \["), "expand": count(r"Expand \["),
        "single_partition": count(r"Exchange SinglePartition"), "scans": scans,
    }


def main():
    from marginflow.plans.catalog import QUERIES
    from marginflow.session import build_session

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = [a for a in sys.argv[2:] if not a.startswith("--")]
    lazy = "--lazy" in sys.argv
    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                                               "spark.sql.adaptive.enabled": "false",
                                               "spark.sql.maxMetadataStringLength": "2000"})
    if lazy:
        spark.conf.set("marginflow.model", "lazy")
    else:
        from marginflow.plans.warehouse import build_warehouse
        from marginflow.sources.adapter import CommerceModel
        etl = CommerceModel(spark, data_dir)._order_frame
        print(f"{'ETL order frame':32} " + str(summarise(etl)))
        build_warehouse(spark, data_dir)
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        s = summarise(fn(spark, data_dir))
        print(f"{name:32} exch={s['exchanges']:<3} smj={s['smj']:<2} bhj={s['bhj']:<2} bnlj={s['bnlj']:<2} "
              f"win={s['window']:<2} expand={s['expand']} single={s['single_partition']} scans={','.join(s['scans'])}")


if __name__ == "__main__":
    main()
