"""Key and label helpers (JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded surrogate key, e.g. ``P00042`` (string order equals numeric order)."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def threshold_label(value: Column, thresholds: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold the value exceeds (``value > t``), in the given order."""
    expr = None
    for limit, label in thresholds:
        expr = F.when(value > limit, label) if expr is None else expr.when(value > limit, label)
    return expr.otherwise(otherwise) if expr is not None else F.lit(otherwise)
