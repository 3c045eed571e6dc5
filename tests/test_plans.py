"""Plan shape checks: pruning, pushdown, one lineitem pass in the ETL."""

from marginflow.sources.adapter import CommerceModel

from conftest import SMOKE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_orders_read_and_columns_pruned(spark):
    m = CommerceModel(spark, SMOKE)
    assert m.order_totals.count() == spark.read.parquet(f"{SMOKE}/orders.parquet").count()
    plan = m.order_totals._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int" in plan
    assert "l_quantity" not in plan and "l_tax" not in plan


def test_warehouse_reads_lineitem_once(spark):
    from marginflow.plans.warehouse import build_warehouse

    w = build_warehouse(spark, SMOKE)
    assert set(w.paths) == {"dim_prospect", "dim_customer", "fct_orders", "fct_deliveries",
                            "fct_experiment_assignments", "fct_marketing_spend", "agg_prospect_outcomes"}
    # Tables derived from the staged order frame never scan lineitem again.
    from marginflow.operators import marts
    assert "lineitem" not in _plan(marts.channel_profitability(w.prospects, w.orders))


def test_lazy_and_warehouse_models_agree(spark):
    from marginflow.operators import marts
    from marginflow.plans.warehouse import warehouse

    lazy = CommerceModel(spark, SMOKE)
    wh = warehouse(spark, SMOKE)
    a = sorted(map(tuple, marts.channel_profitability(lazy.prospects, lazy.orders).collect()))
    b = sorted(map(tuple, marts.channel_profitability(wh.prospects, wh.orders).collect()))
    assert a == b


def test_etl_stage_scans_lineitem_once(spark):
    plan = CommerceModel(spark, SMOKE).order_totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1


def test_dates_independent_of_session_zone_and_timestamp_mode(spark):
    from marginflow.operators import marts

    base = sorted(map(tuple, marts.channel_profitability(*_model_tables(CommerceModel(spark, SMOKE))).collect()))
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    other.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    m = CommerceModel(other, SMOKE)
    assert dict(other.read.parquet(f"{SMOKE}/orders.parquet").dtypes)["o_orderdate"] == "timestamp"
    shifted = sorted(map(tuple, marts.channel_profitability(*_model_tables(m)).collect()))
    assert shifted == base
    months = {r[0] for r in m.marketing_spend.select("month").collect()}
    assert len(months) == 1


def _model_tables(m):
    return m.prospects, m.orders


def _exchanges(df):
    spark = df.sparkSession
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_customer_plans(spark):
    """One scan and two shuffles for the 90-day summary; the exact cohort median has no sort of a cohort."""
    from marginflow.operators import customer, marts
    from marginflow.plans.warehouse import warehouse

    w = warehouse(spark, SMOKE)
    plan = _exchanges(customer.customer_90d(w.orders))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 1 and "Join" not in plan
    cohorts = _exchanges(customer.cohort_profitability_90d(w.orders))  # sums, and selection by digits
    assert cohorts.count("Exchange hashpartitioning") <= 10 and "Window" not in cohorts
    assert _exchanges(customer.customer_lifetime(w.customers, w.orders)).count("Exchange hashpartitioning") == 2
    market = _exchanges(marts.market_profitability(w.orders))
    assert market.count("Exchange") == 1 and "hashpartitioning(market" in market


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    import pytest

    from marginflow import session

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session())
    assert session.scratch_dir(spark)


def test_changed_input_is_built_anew(spark, tmp_path):
    import shutil

    from marginflow.plans.catalog import QUERIES

    for t in ("customer", "nation", "orders", "lineitem", "events"):
        shutil.copyfile(f"{SMOKE}/{t}.parquet", tmp_path / f"{t}.parquet")  # without its read-only mode
    before = QUERIES["kpi_summary"](spark, str(tmp_path)).first()
    again = QUERIES["kpi_summary"](spark, str(tmp_path)).first()
    customers = spark.read.parquet(f"{SMOKE}/customer.parquet").toPandas()
    customers.iloc[:50].to_parquet(tmp_path / "customer.parquet")
    after = QUERIES["kpi_summary"](spark, str(tmp_path)).first()
    assert before == again and before.prospects == len(customers) and after.prospects == 50


def test_finer_source_values_stop_the_job(spark):
    import pytest
    from pyspark.sql import functions as F

    from marginflow.sources.adapter import exact_units

    df = spark.createDataFrame([(12.34,), (None,), (0.0,)], "v double")
    assert [r[0] for r in df.select(exact_units(F.col("v"), 100)).collect()] == [1234, None, 0]
    with pytest.raises(Exception, match="finer"):
        spark.createDataFrame([(0.125,)], "v double").select(exact_units(F.col("v"), 100)).collect()


def test_scale_settings():
    from marginflow.session import scale_settings

    s = scale_settings(100 * 2**40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(10 * 2**20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_order_ids_padded_and_guarded(spark):
    import pytest
    from pyspark.sql import functions as F

    from marginflow.sources.adapter import order_key_id

    ok = spark.createDataFrame([(9,), (10,), (999_999_999_999,)], "k long")
    ids = [r[0] for r in ok.select(order_key_id(F.col("k"))).collect()]
    assert ids == ["O000000000009", "O000000000010", "O999999999999"] and ids == sorted(ids)
    bad = spark.createDataFrame([(10 ** 12,)], "k long")
    with pytest.raises(Exception, match="order key outside"):
        bad.select(order_key_id(F.col("k"))).collect()
