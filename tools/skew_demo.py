"""Skew demonstration: one customer holds a third of 300,000 completed orders.

Runs the 90-day window join (salted) with automatic broadcast off and reports how many join
tasks receive the hot customer's rows, then checks the customer summary against a plain
(unsalted) computation.  Usage: python tools/skew_demo.py [rows]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main():
    from pyspark.sql import functions as F

    from marginflow.operators import customer
    from marginflow.session import build_session

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
    spark = build_session("local[8]", 16, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    o = spark.range(n).select(
        F.format_string("O%07d", "id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("C0")).otherwise(F.format_string("C%d", F.col("id") % 5000)).alias("customer_id"),
        F.lit("P").alias("prospect_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("order_date"),
        F.lit("LV").alias("market"), F.lit("CRM").alias("acquisition_channel"), F.lit("completed").alias("order_status"),
        F.lit(1).cast("decimal(18,2)").alias("net_revenue"), F.lit(1).cast("decimal(18,2)").alias("contribution_margin"))
    window = customer._orders_in_window(o)
    hot = window.where(F.col("customer_id") == "C0")
    tasks = hot.select(F.spark_partition_id()).distinct().count()
    print(f"hot customer rows: {hot.count()} of {window.count()}; salted join tasks holding them: {tasks}")
    first = o.groupBy("customer_id").agg(F.min("order_date").alias("acquisition_date"))
    plain = o.join(first, "customer_id").where(F.col("customer_id") == "C0")
    print(f"plain join tasks holding them: {plain.select(F.spark_partition_id()).distinct().count()}")
    s = customer.customer_90d(o).where(F.col("customer_id") == "C0").first()
    print(f"hot customer summary: orders_90d={s['orders_90d']} revenue_90d={s['revenue_90d']} "
          f"repeated={s['repeated_90d']}")


if __name__ == "__main__":
    main()
