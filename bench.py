"""Benchmark: wall seconds of the warehouse build and of every catalog query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the median is reported), BENCH_QUERIES (comma list, default all).

``warehouse_build`` is the ETL (driver tables -> six commerce tables, written once); each
query is then built afresh and its full result is materialised (xor of per-row hashes over
all columns), so no shuffle files or cached plans are reused between runs.  A warm-up pass
over a separate warehouse build is not reported.  What is written once per build (CSV extracts and
their survey) is timed as ``once:*`` against a fresh build; the queries then read it.  ``value`` is the build, these and all queries;
``flagship_from_raw_sec`` (not in ``value``) is the flagship as one plan from the raw tables.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marginflow.plans.catalog import QUERIES  # noqa: E402
from marginflow.plans.warehouse import warehouse  # noqa: E402
from marginflow.schemas import LOAD_ORDER  # noqa: E402
from marginflow.session import build_session, scale_settings  # noqa: E402


ONCE = ("stg_customers", "stg_orders", "stg_prospects")


def _sf_of(path: str):
    name = Path(path.rstrip("/")).name
    text = name[2:] if name.startswith("sf") else name
    try:
        return float(text)
    except ValueError:
        return text


def _run(spark, fn, data_dir: str) -> float:
    start = time.perf_counter()
    df = fn(spark, data_dir)
    # Materialise every row and column: an xor of per-row hashes over all columns.
    from pyspark.sql import functions as F
    df.select(F.bit_xor(F.xxhash64(*df.columns)).alias("h"), F.count(F.lit(1)).alias("n")).collect()
    return time.perf_counter() - start


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    size = sum(f.stat().st_size for f in Path(data_dir).rglob("*.parquet"))
    spark = build_session(f"local[{cpus}]", extra={"spark.driver.memory": "8g", **scale_settings(size, cpus)})
    names = wanted or list(QUERIES)
    # Warm-up (JIT, file listing caches): one throw-away build and three queries.
    warehouse(spark, data_dir, refresh=True)
    for name in names[:3]:
        _run(spark, QUERIES[name], data_dir)
    results = {}
    builds = []
    for _ in range(repeat):
        start = time.perf_counter()
        wh = warehouse(spark, data_dir, refresh=True)
        builds.append(time.perf_counter() - start)
    results["warehouse_build"] = round(statistics.median(builds), 4)
    rows = {name: wh.table(name).count() for name in LOAD_ORDER}
    for name in [n for n in ONCE if n in names]:
        start = time.perf_counter()
        QUERIES[name](spark, data_dir)
        results[f"once:{name}"] = round(time.perf_counter() - start, 4)
    for name in names:
        times = [_run(spark, QUERIES[name], data_dir) for _ in range(repeat)]
        results[name] = round(statistics.median(times), 4)
    total = round(sum(results.values()), 4)
    # Flagship as one plan straight from the driver tables (ETL inlined), for reference only.
    spark.conf.set("marginflow.model", "lazy")
    flagship_from_raw = round(_run(spark, QUERIES["channel_profitability"], data_dir), 4)
    spark.conf.unset("marginflow.model")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": results, "sf": _sf_of(data_dir), "cpus": cpus,
                      "n_queries": len(results), "repeat": repeat, "rows": rows, "flagship_from_raw_sec": flagship_from_raw}))
    spark.stop()


if __name__ == "__main__":
    main()
