"""Sinks: mart tables and small ordered CSV reports.

* ``materialize`` writes one mart as Parquet, with its documentation as column comments (a named mart
  whose name or columns have no text is refused), and
  returns a DataFrame reading it back; this cuts lineage for marts read by several reports.
* ``write_report_csv`` writes a registered report mart as a single ordered CSV with header.  One
  task writes it, so it accepts only marts whose row count is bounded by fixed domains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas
from .csv import _DIALECT


def materialize(df: DataFrame, path: str, name: str | None = None) -> DataFrame:
    if name and (lacking := schemas.missing_docs(name, df.columns)):
        raise ValueError(f"no text for {', '.join(lacking)}")
    out = schemas.with_comments(df, name) if name else df
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_report_csv(df: DataFrame, path: str, name: str, order_by: list) -> None:
    """Single ordered CSV with header for a report mart (row order preserved)."""
    if name not in schemas.REPORT_MARTS:
        raise ValueError(f"{name} is not a mart of bounded size: write it as a table")
    df.orderBy(*order_by).coalesce(1).write.mode("overwrite").options(**_DIALECT).csv(path)
