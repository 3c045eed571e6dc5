"""Data-quality checks find seeded violations, one per check."""

from frames import D, assignments, customers, deliveries, orders, prospects, spend
from marginflow.operators import marts, quality


def _tables(spark):
    p = prospects(spark, [("P1", "LV", "CRM", 1), ("P2", "XX", "CRM", 0), ("P2", "LV", "CRM", 0)])
    p = p.withColumn("engagement_score", p.engagement_score * 0 + 1.2).unionByName(
        prospects(spark, [("P3", "EE", "CRM", 0)]))
    c = customers(spark, [("C1", "P1", "LV", "CRM", D(2025, 1, 1)), ("C9", "P9", "LV", "CRM", D(2025, 1, 1))])
    o = orders(spark, [("O1", "C1", "P1", D(2025, 1, 1), "LV", "CRM", "completed", 10, 1),
                       ("O2", "C1", "P1", D(2025, 1, 2), "LV", "CRM", "completed", 10, 1)])
    d = deliveries(spark, [("O1", "FastShip", 1, 5), ("O7", "FastShip", 2, 5)])
    a = assignments(spark, [("P1", "control"), ("P3", "treatment")])
    s = spend(spark, [(D(2025, 1, 1), "LV", "CRM", -1)])
    return {"dim_prospect": p, "dim_customer": c, "fct_orders": o, "fct_deliveries": d,
            "fct_experiment_assignments": a, "fct_marketing_spend": s}


def _violations(df):
    return {(r["check"], r["table"], r["column"]): r["violations"] for r in df.collect()}


def test_seeded_violations(spark):
    t = _tables(spark)
    u = _violations(quality.unique_keys(t))
    assert u[("unique", "dim_prospect", "prospect_id")] == 1
    assert sum(u.values()) == 1
    av = _violations(quality.accepted_values(t))
    assert av[("accepted_values", "dim_prospect", "market")] == 1
    assert av[("accepted_values", "fct_deliveries", "on_time")] == 1
    rg = _violations(quality.ranges(t))
    assert rg[("range", "dim_prospect", "engagement_score")] == 3
    assert rg[("range", "fct_marketing_spend", "spend")] == 1
    orph = _violations(quality.orphans(t))
    assert orph[("relationships", "dim_customer", "prospect_id->dim_prospect.prospect_id")] == 1
    assert orph[("relationships", "fct_deliveries", "order_id->fct_orders.order_id")] == 1
    assert sum(orph.values()) == 2


def test_not_null(spark):
    from marginflow import schemas
    p = prospects(spark, [("P1", "LV", "CRM", 1)])
    nulls = spark.createDataFrame([(None, "LV", "CRM", "Home", "mobile", 0.5, D(2025, 1, 1), 1)],
                                  schemas.TABLES["dim_prospect"].fromJson(
                                      {**schemas.TABLES["dim_prospect"].jsonValue(),
                                       "fields": [{**f, "nullable": True}
                                                  for f in schemas.TABLES["dim_prospect"].jsonValue()["fields"]]}))
    v = _violations(quality.not_null({"dim_prospect": p.unionByName(nulls)}))
    assert v[("not_null", "dim_prospect", "prospect_id")] == 1
    assert v[("not_null", "dim_prospect", "market")] == 0


def test_report_and_assert(spark):
    t = _tables(spark)
    p, o, a = t["dim_prospect"], t["fct_orders"], t["fct_experiment_assignments"]
    rep = quality.report(t, marts.channel_profitability(p, o), marts.experiment(a, p, o))
    checks = {r["check"] for r in rep.collect()}
    assert {"unique", "not_null", "accepted_values", "range", "relationships", "reconciliation",
            "outcome_variety", "arm_rate_interior"} <= checks
    try:
        quality.assert_quality(rep)
    except quality.QualityError as exc:
        assert "unique dim_prospect.prospect_id=1" in str(exc)
    else:
        raise AssertionError("expected a quality error")


def test_schema_and_required_columns(spark):
    from marginflow.plans.warehouse import warehouse
    from conftest import SMOKE

    wh = warehouse(spark, SMOKE)
    tables = {name: wh.table(name) for name in ("dim_prospect", "fct_orders", "fct_deliveries")}
    assert quality.schema_violations(tables) == []
    bad = {"fct_orders": wh.orders.withColumn("gross_revenue", wh.orders.gross_revenue.cast("double"))
           .drop("order_id")}
    problems = quality.schema_violations(bad)
    assert ("fct_orders", "order_id", "missing") in problems
    assert any(c == "gross_revenue" and p.startswith("type double") for _, c, p in problems)
    from marginflow import schemas
    nullable = spark.createDataFrame([], schemas.T.StructType(
        [schemas.T.StructField(f.name, f.dataType, True) for f in schemas.TABLES["dim_customer"].fields]))
    assert ("dim_customer", "market", "nullable") in quality.schema_violations({"dim_customer": nullable}, True)
    from marginflow.operators import stats
    exp = stats.experiment_statistics(marts.experiment(wh.experiment_assignments, wh.prospects, wh.orders))
    assert quality.missing_columns(exp, ["conversion_p_value", "srm_p_value"]) == []
    assert quality.missing_columns(exp, ["nope"]) == ["nope"]


def test_duplicate_keys_stop_the_build(spark, tmp_path):
    import shutil

    import pytest

    from conftest import SMOKE
    from marginflow.plans.warehouse import build_warehouse

    for t in ("customer", "nation", "lineitem", "events"):
        shutil.copy(f"{SMOKE}/{t}.parquet", tmp_path / f"{t}.parquet")
    o = spark.read.parquet(f"{SMOKE}/orders.parquet")
    o.union(o.limit(3)).write.parquet(str(tmp_path / "orders.parquet"))
    with pytest.raises(quality.QualityError, match="fct_orders.order_id=3"):
        build_warehouse(spark, str(tmp_path), str(tmp_path / "out"))


def test_orders_of_unknown_customers_are_reported(spark, tmp_path):
    import shutil

    from conftest import SMOKE
    from marginflow.plans.catalog import QUERIES

    for t in ("orders", "nation", "lineitem", "events"):
        shutil.copy(f"{SMOKE}/{t}.parquet", tmp_path / f"{t}.parquet")
    c = spark.read.parquet(f"{SMOKE}/customer.parquet")
    c.where("c_custkey % 10 <> 1").write.parquet(str(tmp_path / "customer.parquet"))
    found = _violations(QUERIES["dq_orphans"](spark, str(tmp_path)))
    assert found["relationships", "fct_orders", "prospect_id->dim_prospect.prospect_id"] > 0
    assert QUERIES["load_orders"](spark, str(tmp_path)) is not None
