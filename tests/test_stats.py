"""Experiment inference: published golden values and edge cases."""

import pytest
from pyspark.sql import functions as F

from marginflow.operators import analysis, stats

MART_SCHEMA = ("treatment string, assigned_prospects bigint, converted_prospects bigint, conversion_rate double, "
               "margin_per_assigned_prospect double, revenue_per_assigned_prospect double")


def mart(spark, rows):
    return spark.createDataFrame(rows, MART_SCHEMA)


def test_golden_values(spark):
    m = mart(spark, [("control", 3006, 864, 0.2874, 0.37, 22.51), ("treatment", 2994, 973, 0.325, -0.71, 25.4)])
    rows = {r["treatment"]: r for r in stats.experiment_statistics(m).collect()}
    for r in rows.values():  # statistics repeated on both arm rows
        assert r["conversion_lift_pp"] == 3.76
        assert r["conversion_ci_low_pp"] == 1.43
        assert r["conversion_ci_high_pp"] == 6.09
        assert r["conversion_p_value"] == 0.0016
        assert r["margin_lift_vs_control"] == -1.08
        assert r["srm_p_value"] == 0.8769
    d = stats.experiment_decision(stats.experiment_statistics(m)).collect()
    assert len(d) == 1 and d[0]["conversion_lift_pp"] == 3.76


def test_zero_standard_error(spark):
    m = mart(spark, [("control", 10, 0, 0.0, 0.0, 0.0), ("treatment", 10, 0, 0.0, 0.0, 0.0)])
    r = stats.experiment_statistics(m).collect()[0]
    assert r["conversion_p_value"] == 1.0 and r["conversion_lift_pp"] == 0.0
    assert r["srm_p_value"] == 1.0


def test_missing_arm_raises(spark):
    m = mart(spark, [("control", 10, 1, 0.1, 0.0, 0.0)])
    with pytest.raises(Exception, match="control and a treatment"):
        stats.experiment_statistics(m).collect()


def test_comparison_and_itt(spark):
    m = mart(spark, [("control", 3006, 864, 0.2874, 0.37, 22.51), ("treatment", 2994, 973, 0.325, -0.71, 25.4)])
    c = {r["metric"]: r for r in stats.experiment_comparison(m).collect()}
    assert c["conversion_rate"]["difference"] == 0.0376
    assert c["assigned_prospects"]["difference"] == -12.0
    itt = {r["treatment"]: r["margin_lift_vs_control"] for r in analysis.experiment_itt(m).collect()}
    assert itt["control"] == 0.0 and round(itt["treatment"], 10) == -1.08


def test_erf_polynomial_accuracy(spark):
    import math
    from marginflow.functions.numeric import erf
    xs = [i / 10 for i in range(-40, 41)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(erf(F.col("x"))).collect()]
    assert max(abs(g - math.erf(x)) for g, x in zip(got, xs)) < 2e-7
