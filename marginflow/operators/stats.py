"""Randomised-experiment inference on the experiment mart, as Column arithmetic.

The mart has one row per arm.  A conditional aggregate turns it into one row holding the
control and treatment figures, attached to the arm rows by a window over the (two) rows.  Nothing is
collected to the driver.  A missing arm raises at execution time (``raise_error``).

Parity: statistics are computed from the mart's *rounded* rates and means, as the published
figures are.  ``experiment_statistics_exact`` computes the same statistics from unrounded
rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of, round_half_up, two_sided_p
from .marts import arm_totals

# 95% two-sided normal quantile and the planned allocation share.
Z_95 = 1.96
PLANNED_SHARE = 0.25  # variance factor p * (1 - p) for a 50/50 split


def _arm(value: str, arm: str) -> Column:
    return F.max(F.when(F.col("treatment") == arm, F.col(value)))


def _statistics(pairs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    n_c, n_t = F.col("n_c").cast("double"), F.col("n_t").cast("double")
    p_c, p_t = F.col("p_c"), F.col("p_t")
    lift = p_t - p_c
    se = F.sqrt(p_c * (F.lit(1.0) - p_c) / n_c + p_t * (F.lit(1.0) - p_t) / n_t)
    z = F.when(se != 0, lift / se).otherwise(F.lit(0.0))
    total = n_c + n_t
    srm_z = (n_t - total / F.lit(2.0)) / F.sqrt(total * F.lit(PLANNED_SHARE))
    return pairs.select(
        *(keep or []),
        round_half_up(lift * F.lit(100.0), 2).alias("conversion_lift_pp"),
        round_half_up((lift - F.lit(Z_95) * se) * F.lit(100.0), 2).alias("conversion_ci_low_pp"),
        round_half_up((lift + F.lit(Z_95) * se) * F.lit(100.0), 2).alias("conversion_ci_high_pp"),
        round_half_up(two_sided_p(z), 4).alias("conversion_p_value"),
        round_half_up(F.col("m_t") - F.col("m_c"), 2).alias("margin_lift_vs_control"),
        round_half_up(two_sided_p(srm_z), 4).alias("srm_p_value"),
        "_guard",
    )


STAT_COLUMNS = ["conversion_lift_pp", "conversion_ci_low_pp", "conversion_ci_high_pp",
                "conversion_p_value", "margin_lift_vs_control", "srm_p_value"]


def _with_statistics(arms: DataFrame, rate: str, margin: str) -> DataFrame:
    """Arm rows with both arms' figures and the statistics attached.

    The input has one row per arm (a two-value domain), so the whole-relation window below
    sees a couple of rows: the mart is computed once and no join is needed.
    """
    every = Window.partitionBy()
    pairs = arms.select(
        "*",
        *[_arm(col, arm).over(every).alias(alias) for col, arm, alias in (
            ("assigned_prospects", "control", "n_c"), ("assigned_prospects", "treatment", "n_t"),
            (rate, "control", "p_c"), (rate, "treatment", "p_t"),
            (margin, "control", "m_c"), (margin, "treatment", "m_t"))])
    missing = F.col("n_c").isNull() | F.col("n_t").isNull()
    guarded = pairs.where(F.when(missing, F.raise_error(F.lit("experiment mart needs a control and a treatment arm")))
                          .isNull())
    stats = _statistics(guarded.select("*", F.lit(None).alias("_guard")), keep=arms.columns)
    return stats


def experiment_statistics(mart: DataFrame) -> DataFrame:
    """Mart rows plus lift, 95% CI, p-value, margin lift and SRM p-value (from rounded inputs)."""
    return _with_statistics(mart, "conversion_rate", "margin_per_assigned_prospect").select(
        *mart.columns, *STAT_COLUMNS)


def experiment_statistics_exact(outcomes: DataFrame) -> DataFrame:
    """The same statistics from unrounded per-arm rates and means (one row per arm)."""
    arms = arm_totals(outcomes).select(
        "treatment", F.col("assigned_prospects").cast("bigint").alias("assigned_prospects"),
        F.col("converted_prospects").cast("bigint").alias("converted_prospects"),
        mean_of(F.col("converted_prospects"), F.col("assigned_prospects")).alias("conversion_rate"),
        mean_of(F.col("_cm"), F.col("assigned_prospects")).alias("margin_per_assigned_prospect"),
    )
    stats = _with_statistics(arms, "conversion_rate", "margin_per_assigned_prospect")
    return stats.select(
        "treatment", "assigned_prospects", "converted_prospects",
        round_half_up(F.col("conversion_rate"), 6).alias("conversion_rate"),
        round_half_up(F.col("margin_per_assigned_prospect"), 6).alias("margin_per_assigned_prospect"),
        *STAT_COLUMNS)


def experiment_decision(stats: DataFrame) -> DataFrame:
    """The decision row: statistics of the treatment arm."""
    return stats.where(F.col("treatment") == "treatment").select(*STAT_COLUMNS)


COMPARISON_METRICS = [  # (metric label, mart column)
    ("assigned_prospects", "assigned_prospects"),
    ("conversion_rate", "conversion_rate"),
    ("revenue_per_assigned_prospect", "revenue_per_assigned_prospect"),
    ("margin_per_assigned_prospect", "margin_per_assigned_prospect"),
]


def experiment_comparison(mart: DataFrame) -> DataFrame:
    """Control / treatment / difference per metric (4 rows), from the mart."""
    aggs = []
    for label, column in COMPARISON_METRICS:
        aggs.append(_arm(column, "control").cast("double").alias(f"{label}__c"))
        aggs.append(_arm(column, "treatment").cast("double").alias(f"{label}__t"))
    wide = mart.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(f"{label}__c").alias("control"),
                 F.col(f"{label}__t").alias("treatment"))
        for label, _ in COMPARISON_METRICS])
    long = wide.select(F.inline(rows))
    return long.select("metric", "control", "treatment",
                       round_half_up(F.col("treatment") - F.col("control"), 4).alias("difference"))
