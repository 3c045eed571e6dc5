"""Views read the warehouse and the operators; reports are ordered."""

from pyspark.sql import functions as F

from conftest import SMOKE
from marginflow import schemas
from marginflow.functions.labels import surrogate_key, threshold_label
from marginflow.plans.views import register_views
from marginflow.plans.warehouse import warehouse


def test_views(spark):
    wh = warehouse(spark, SMOKE)
    names = register_views(spark, wh, prefix="v_")
    assert {"v_stg_customers", "v_stg_orders", "v_stg_prospects", "v_mart_experiment"} <= set(names)
    assert spark.table("v_mart_market_profitability").count() == 3
    ranks = [r.profitability_rank for r in spark.table("v_channel_rank_report").collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1 and len(ranks) == 5
    rates = [r.on_time_rate for r in spark.table("v_carrier_tradeoff_report").collect()]
    assert rates == sorted(rates) and len(rates) == 9
    arms = {r.treatment: r.margin_lift_vs_control for r in spark.table("v_experiment_itt_report").collect()}
    assert arms["control"] == 0.0
    staged = spark.table("v_stg_orders")
    assert dict(staged.dtypes)["order_date"] == "string" and dict(staged.dtypes)["net_revenue"] == "double"
    assert staged.count() == wh.orders.count()


def test_written_tables_carry_comments(spark):
    wh = warehouse(spark, SMOKE)
    for name in schemas.TABLES:
        fields = spark.read.parquet(wh.paths[name]).schema.fields
        assert all(f.metadata["comment"].endswith(schemas.COLUMN_DOCS[f.name]) for f in fields)
        assert fields[0].metadata["comment"].startswith(schemas.MODEL_DOCS[name])


def test_surrogate_key_and_labels(spark):
    df = spark.createDataFrame([(7, 2.5), (123456, 0.0), (42, -1.0)], "n long, v double")
    rows = df.select(surrogate_key("C", F.col("n"), 5).alias("k"),
                     threshold_label(F.col("v"), [(2, "Scale"), (0, "Protect")], "Fix / Pause").alias("l")).collect()
    assert [r["k"] for r in rows] == ["C00007", "C123456", "C00042"]
    assert [r["l"] for r in rows] == ["Scale", "Fix / Pause", "Fix / Pause"]


def test_every_written_mart_and_column_has_a_text(spark, published, tmp_path):
    """Catalog tables over a published version carry the registry's comments."""
    from marginflow.plans import versions

    made = versions.register_tables(spark, published[0], prefix="pub_")
    assert len(made) >= 28 and "pub_customer_lifetime" in made and "pub_fct_orders" in made
    for name in made:
        told = {r.col_name: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").collect()}
        assert told["Comment"].data_type == schemas.MODEL_DOCS[name.removeprefix("pub_")]
        for c in spark.table(name).columns:
            assert told[c].comment == schemas.COLUMN_DOCS[c] and told[c].comment
        spark.sql(f"DROP TABLE `{name}`")
    import pytest
    from marginflow.sources import sinks
    with pytest.raises(ValueError, match="no text for new_mart, new_mart.oddity"):
        sinks.materialize(spark.createDataFrame([(1,)], "oddity int"), str(tmp_path / "m"), "new_mart")
