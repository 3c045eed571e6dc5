"""A rebuild is published whole or not at all; facts share buckets; checks are observed while tables are written."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from marginflow import schemas
from marginflow.operators import economics, marts, metrics, quality
from marginflow.plans import pipeline, versions
from marginflow.plans.warehouse import buckets_for, open_warehouse, read_bucketed, warehouse
from marginflow.sources import files
from test_plans import _exchanges


def test_order_joins_need_no_shuffle(spark):
    """No exchange below the join of deliveries and orders: both are bucketed by order_id."""
    w = warehouse(spark, SMOKE)
    for df in (marts.logistics(w.deliveries, w.orders), economics.delivery_service(w.deliveries, w.orders)):
        plan = _exchanges(df)
        below = plan[plan.index("SortMergeJoin"):]
        depth = re.search(r"\n([ :|+-]*)(?:\*\(\d+\) )?SortMergeJoin", plan)[1]
        side = [line for line in below.splitlines()[1:] if len(re.match(r"[ :|+-]*", line)[0]) > len(depth)]
        assert "Bucketed: true" in below and not any("Exchange" in line for line in side)
    assert _exchanges(economics.delivery_service(w.deliveries, w.orders)).count("Exchange") == 0
    layer = _exchanges(metrics.metric_layer(w.prospects, w.orders, w.deliveries, keys=("carrier", "device_type")))
    assert "hashpartitioning(order_id" not in layer


def test_bucketed_facts_hold_each_key_in_its_bucket(spark):
    w = warehouse(spark, SMOKE)
    for name in ("fct_orders", "fct_deliveries"):
        spread = spark.read.parquet(w.paths[name]).select(
            F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c", 1).cast("int").alias("file"),
            F.pmod(F.hash("order_id"), F.lit(w.buckets)).alias("bucket"))
        assert spread.where("file <> bucket").count() == 0
    assert [buckets_for(n, 200) for n in (0, 10, 150_000, 10**9, 10**12)] == [1, 1, 8, 500, 100_000]


def test_bucketed_table_is_found_by_its_path(spark, tmp_path):
    from marginflow.plans.warehouse import _registered, write_bucketed

    df = spark.range(100).select(F.format_string("O%03d", "id").alias("order_id"), F.col("id").alias("it's"))
    path = str(tmp_path / "t")
    write_bucketed(df.repartition(3, "order_id"), path, "order_id", 3)
    spark.sql(f"DROP TABLE {_registered(path)}")  # as another session finds it
    again = read_bucketed(spark, path, "order_id", 3)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    assert "Bucketed: true" in _exchanges(again.join(again.withColumnRenamed("it's", "b"), "order_id"))


def test_a_run_that_stops_leaves_the_old_version(spark, published, tmp_path, monkeypatch):
    out, small = published[0], str(tmp_path / "small")
    first = versions.current(spark, out)
    folders = len(files.names(spark, f"{out}/versions"))
    before = [tuple(r) for r in versions.read_mart(spark, out, "channel_profitability").collect()]
    orders = open_warehouse(spark, out).orders.count()

    for t in ("customer", "nation", "lineitem", "events"):
        spark.read.parquet(f"{SMOKE}/{t}.parquet").write.parquet(f"{small}/{t}.parquet")
    spark.read.parquet(f"{SMOKE}/orders.parquet").where("o_orderkey % 2 = 0").write.parquet(f"{small}/orders.parquet")
    monkeypatch.setattr(marts, "market_profitability", lambda o: o.select(F.raise_error(F.lit("stopped")).alias("market")))
    with pytest.raises(Exception, match="stopped"):
        pipeline.run(spark, small, out)  # tables and some marts of the new version are written by now
    assert len(files.names(spark, f"{out}/versions")) == folders + 1
    assert versions.current(spark, out) == first and open_warehouse(spark, out).orders.count() == orders
    assert [tuple(r) for r in versions.read_mart(spark, out, "channel_profitability").collect()] == before


def test_readers_move_to_the_new_version_and_old_ones_expire(spark, tmp_path):
    out = str(tmp_path / "out")
    assert versions.current(spark, out) is None
    with pytest.raises(KeyError):
        versions.read_mart(spark, out, "m")
    for n in (1, 2, 3):
        folder = versions.fresh_folder(out)
        spark.range(n).write.parquet(f"{out}/{folder}/marts/m")
        assert versions.publish(spark, out, {"folder": folder, "marts": {"m": f"{folder}/marts/m"}}) == n
        assert versions.read_mart(spark, out, "m").count() == n
    assert versions.expire(spark, out, keep=2) == [1] and versions.expire(spark, out, keep=0) == [2]
    assert versions.read_mart(spark, out, "m").count() == 3
    assert files.names(spark, f"{out}/versions") == [folder.split("/")[1]]


def test_two_publishers_get_two_numbers(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    assert versions.publish(spark, out, {"folder": "a"}) == 1
    real, calls = versions._numbers, []

    def late(spark, out_dir):  # the other run publishes between look and leap
        found = real(spark, out_dir)
        if not calls:
            calls.append(1)
            assert files.create_text(spark, f"{out}/manifests/{2:012d}.json", '{"folder": "b"}')
        return found

    monkeypatch.setattr(versions, "_numbers", late)
    assert versions.publish(spark, out, {"folder": "c"}) == 3
    monkeypatch.undo()
    assert versions.current(spark, out) == {"folder": "c"}
    assert not files.create_text(spark, f"{out}/manifests/{2:012d}.json", "x")
    assert len(files.names(spark, f"{out}/manifests")) == 3  # no draft is left


def test_observed_checks_equal_a_pass_over_the_tables(spark):
    w = warehouse(spark, SMOKE)
    tables = {name: w.table(name) for name in schemas.TABLES}
    seen = sorted(map(tuple, quality.observed_checks(spark, w.observed).collect()))
    assert seen == sorted(map(tuple, quality._single_pass(tables, quality.ROW_CHECKS).collect())) and len(seen) > 40
    total = w.orders.agg(F.sum("contribution_margin")).first()[0]
    assert w.observed["fct_orders"]["contribution_margin"] == str(total)


def test_observed_faults_are_counted(spark, tmp_path):
    from pyspark.sql import Observation

    w = warehouse(spark, SMOKE)
    faulty = w.prospects.withColumn("market", F.when(F.col("prospect_id").like("%1"), "XX").otherwise(F.col("market")))
    seen = Observation()
    faulty.observe(seen, *quality.observations("dim_prospect")).write.parquet(str(tmp_path / "p"))
    assert seen.get["accepted_values:market"] == faulty.where("market = 'XX'").count() > 0


def test_key_audit_is_one_shuffle_for_all_keys(spark):
    w = warehouse(spark, SMOKE)
    tables = {name: w.table(name) for name in schemas.TABLES}
    assert [len(d) for d in sorted(quality.key_domains(), key=len)] == [2, 2, 4]
    for df in (quality.key_audit(tables), quality.unique_keys(tables), quality.orphans(tables)):
        plan = _exchanges(df)
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") == 2 and "Join" not in plan


def test_report_shuffles(spark):
    from marginflow.plans.catalog import QUERIES

    report = QUERIES["dq_report"](spark, SMOKE)
    plan = _exchanges(report)
    assert plan.count("Exchange") <= 10 and plan.count("FileScan") == 10  # 8 key columns, two marts
    assert not any("fct_marketing_spend" in f for f in report.inputFiles())


def test_rolled_up_marts_read_no_orders(spark):
    from marginflow.plans.catalog import QUERIES

    w = warehouse(spark, SMOKE)
    for name in ("channel_profitability", "channel_profitability_distinct", "experiment", "experiment_stats",
                 "experiment_stats_exact", "channel_rank", "channel_decision", "dq_reconciliation"):
        assert all("/agg_prospect_outcomes/" in f for f in QUERIES[name](spark, SMOKE).inputFiles()), name
    assert w.prospect_outcomes.count() == w.prospects.count()


def test_subtotals_equal_each_grouping(spark):
    w = warehouse(spark, SMOKE)
    keys = ["market", "carrier"]
    every = metrics.metric_layer_subtotals(w.prospects, w.orders, w.deliveries, tuple(keys))
    for number, own in ((0, keys), (1, ["market"]), (2, ["carrier"]), (3, [])):
        want = metrics.metric_layer(w.prospects, w.orders, w.deliveries, tuple(own))
        got = every.where(F.col("grouping_id") == number).select(*own, *list(metrics.MEASURES))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_subtotals_tell_totals_from_null_values(spark):
    from frames import D, deliveries, orders, prospects

    p = prospects(spark, [("P1", "LV", "CRM", 1), ("P2", "LV", "CRM", 0)]).withColumn(
        "market", F.when(F.col("prospect_id") == "P1", F.col("market")))
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 10, 2)])
    rows = metrics.metric_layer_subtotals(p, o, deliveries(spark, [("O1", "FastShip", 1, 3)]), ("market",)).collect()
    assert {(r.market, r.grouping_id): r.eligible_prospects for r in rows} == {("LV", 0): 1, (None, 0): 1, (None, 1): 2}


def test_keys_of_bucketed_facts_are_checked_where_they_lie(spark):
    w = warehouse(spark, SMOKE)
    tables = {name: w.table(name) for name in schemas.TABLES}
    facts = {name: tables[name] for name in ("fct_orders", "fct_deliveries")}
    assert "hashpartitioning(order_id" not in _exchanges(quality.unique_keys_apart(facts))
    tables["fct_orders"] = tables["fct_orders"].union(tables["fct_orders"].limit(3))
    nulled = tables["dim_prospect"].limit(2).withColumn("prospect_id", F.lit(None).cast("string"))
    tables["dim_prospect"] = tables["dim_prospect"].union(nulled)
    found = [sorted(map(tuple, check(tables).collect())) for check in (quality.unique_keys_apart, quality.unique_keys)]
    assert found[0] == found[1] and ("unique", "fct_orders", "order_id", 3) in found[0]


def test_amounts_are_not_shuffled(spark):
    """What is dealt to buckets holds whole units; each customer's summary is read, not added up again."""
    w = warehouse(spark, SMOKE)
    rows = spark.read.parquet(f"{w.root}/_stage/order_rows")
    assert not any(t.startswith("decimal") for _, t in rows.dtypes) and rows.count() == w.orders.count()
    keys = spark.read.parquet(f"{w.root}/_stage/customer_orders")
    assert keys.count() == keys.select("o_custkey").distinct().count()


@pytest.mark.parametrize("value", [1.005, 0.125, float("nan"), float("inf")])
def test_values_finer_than_the_units_stop_the_job(spark, value):
    from marginflow.sources.adapter import exact_units

    whole = spark.sql("select explode(array(0.07D, -1.15D, 1.1D, -0.0D, null)) as x").select(exact_units(F.col("x"), 100).alias("n"))
    assert [r.n for r in whole.collect()] == [7, -115, 110, 0, None]
    assert "rint" in whole._jdf.queryExecution().optimizedPlan().toString().lower()
    with pytest.raises(Exception, match="finer than"):
        spark.createDataFrame([(value,)], "x double").select(exact_units(F.col("x"), 100)).collect()
