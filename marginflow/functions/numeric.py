"""Numeric column helpers: exact money, deterministic rounding, null-safe division, normal CDF.

All helpers build JVM-side ``Column`` expressions (no Python UDF), so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Wide enough for any mart value; doubles are routed through it before rounding so that
# rounding is half-up on the decimal expansion and never yields -0.0.
ROUNDING_DECIMAL = "decimal(30,12)"


def round_half_up(col: Column, digits: int) -> Column:
    """Round a double (or decimal) half away from zero and return a double.

    Goes through ``decimal(30,12)`` so that the result is deterministic and matches SQL
    engines that round decimals half away from zero.
    """
    return F.round(col.cast(ROUNDING_DECIMAL), digits).cast("double")


def round_money(col: Column, digits: int = 2) -> Column:
    """Round an exact decimal sum and hand it out as a double."""
    return F.round(col, digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / NULLIF(denominator, 0)`` in double arithmetic (NULL on a zero or NULL base)."""
    den = denominator.cast("double")
    return F.when(den != 0, numerator.cast("double") / den)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from an exact sum and a count: ``cast(sum as double) / count``."""
    return ratio(total, count)


def single_row(df) -> Column:
    """A one-row DataFrame (a global aggregate) as a struct-valued scalar subquery.

    Spark evaluates it once and uses the value in the outer plan - no join, nothing
    broadcast but the single row.  Fails at run time if ``df`` does not have exactly one row.
    """
    return df.select(F.struct(*df.columns).alias("_row")).scalar()


def clamp(col: Column, low: float, high: float) -> Column:
    """``col`` held between two bounds; NULL stays NULL."""
    return F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(col, F.lit(high))))


# Abramowitz & Stegun formula 7.1.26 for erf(x), x >= 0 (|error| < 1.5e-7).
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(col: Column) -> Column:
    """erf(x) as a Column expression (odd extension of the 7.1.26 polynomial)."""
    x = F.abs(col)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    a1, a2, a3, a4, a5 = (F.lit(a) for a in ERF_A)
    poly = t * (a1 + t * (a2 + t * (a3 + t * (a4 + t * a5))))
    y = F.lit(1.0) - poly * F.exp(-(x * x))
    return F.when(col < 0, -y).otherwise(y)


def normal_cdf(col: Column) -> Column:
    """Standard normal CDF, 0.5 * (1 + erf(x / sqrt 2))."""
    return F.lit(0.5) * (F.lit(1.0) + erf(col / F.sqrt(F.lit(2.0))))


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value 2 * (1 - Phi(|z|))."""
    return F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.abs(z)))
