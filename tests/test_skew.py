"""Salted joins: same rows as the plain join, hot key spread over several tasks."""

from pyspark.sql import functions as F

from marginflow.operators.skew import hot_keys, salted_join


def _frames(spark):
    left = spark.range(6000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%d", F.col("id") % 97)).alias("k"),
        (F.col("id") % 11).alias("v"))
    right = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"R{i}") for i in range(0, 97, 2)], "k string, attr string")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return left, right, counts


def test_hot_keys_bounded(spark):
    left, _, counts = _frames(spark)
    hot = hot_keys(counts, "k", "n", partitions=8).collect()
    assert [(r["_hot_key"], r["_salts"]) for r in hot] == [("hot", 3)]


def test_salted_join_equals_plain_join(spark):
    left, right, counts = _frames(spark)
    hot = hot_keys(counts, "k", "n", partitions=8)
    for how in ("inner", "left"):
        ours = salted_join(left, right, "k", hot, how, spread_by="row_id")
        plain = left.join(right, "k", how)
        cols = ["row_id", "k", "v", "attr"]
        assert sorted(map(tuple, ours.select(*cols).collect())) == sorted(map(tuple, plain.select(*cols).collect()))


def test_hot_key_spread_over_partitions(spark):
    left, right, counts = _frames(spark)
    # Force a shuffle join (no automatic broadcast, no AQE re-planning) so the salt decides
    # which task receives a row.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = salted_join(left, right, "k", hot_keys(counts, "k", "n", partitions=8), "inner", spread_by="row_id")
        assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
        parts = j.where(F.col("k") == "hot").select(F.spark_partition_id()).distinct().count()
        plain = left.join(right, "k").where(F.col("k") == "hot").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plain == 1 and parts >= 2
