"""Data-quality checks returning violation counts (one row per check).

Output schema of every check: ``check`` string, ``table`` string, ``column`` string,
``violations`` bigint.  Checks read the constraint registry in ``marginflow.schemas``.

Keys.  Columns that refer to each other, directly or through others, share a key domain (prospects,
customers, orders).  ``key_audit`` unites the key columns of all tables as tagged rows (domain, key,
column), counts them by domain and key in one grouping, combined before its one shuffle, and reads
duplicates and orphans of every relation off these counts: a key referenced by a third of all rows is
one row there, and no table is joined to another.

Rows.  Not-null, accepted-value and range checks look at single rows.  ``observations`` states them as
aggregates that Spark observes while a table is written, so that a report on a built warehouse makes no
pass over the tables for them; over other tables they are one aggregation pass each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.numeric import single_row

Tables = dict[str, DataFrame]


def _row(df: DataFrame, check: str, table: str, column: str, violations: Column) -> DataFrame:
    return df.agg(violations.alias("_v")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"),
        F.coalesce(F.col("_v"), F.lit(0)).cast("bigint").alias("violations"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


KeyColumn = tuple[str, str]  # (table, column)


def key_domains() -> list[list[KeyColumn]]:
    """Key columns that declared references connect; a key that nothing refers to is alone."""
    unique = [(t, c) for t, c in schemas.PRIMARY_KEYS.items()]
    unique += [(t, c) for t, cols in schemas.UNIQUE_KEYS.items() for c in cols]
    links = [((child, column), (parent, key)) for child, column, parent, key in schemas.FOREIGN_KEYS]
    domains = [{column} for column in dict.fromkeys([*unique, *[end for link in links for end in link]])]
    for a, b in links:
        joined = [d for d in domains if a in d or b in d]
        domains = [d for d in domains if d not in joined] + [set().union(*joined)]
    return [sorted(d) for d in domains]


def key_audit(tables: Tables, kinds: tuple[str, ...] = ("unique", "relationships")) -> DataFrame:
    """Rows beyond the first per key value, for primary keys and declared unique columns, and child
    rows whose non-null key has no parent row."""
    checks: list[tuple[str, str, str, int, Column]] = []  # check, table, column, domain, violations of a key
    tagged = []
    for number, domain in enumerate(key_domains()):
        domain = [k for k in domain if k[0] in tables]
        rows = {k: F.col(f"_n{i}") for i, k in enumerate(domain)}
        wanted = []
        if "unique" in kinds:
            pairs = [*schemas.PRIMARY_KEYS.items(), *[(t, c) for t, cols in schemas.UNIQUE_KEYS.items() for c in cols]]
            wanted += [("unique", t, c, [(t, c)], F.greatest(rows[t, c] - 1, F.lit(0))) for t, c in pairs if (t, c) in rows]
        if "relationships" in kinds:
            wanted += [("relationships", t, f"{c}->{parent}.{key}", [(t, c), (parent, key)],
                        F.when(rows[parent, key] == 0, rows[t, c]).otherwise(0))
                       for t, c, parent, key in schemas.FOREIGN_KEYS if (t, c) in rows and (parent, key) in rows]
        checks += [(check, t, c, number, count) for check, t, c, _, count in wanted]
        for i, (t, c) in enumerate(domain):
            if any((t, c) in needed for _, _, _, needed, _ in wanted):
                tagged.append(tables[t].where(F.col(c).isNotNull()).select(
                    F.lit(number).alias("_domain"), F.col(c).cast("string").alias("_key"), F.lit(i).alias("_tag")))
    width = max(len(d) for d in key_domains())
    per_key = reduce(DataFrame.union, tagged).groupBy("_domain", "_key").agg(
        *[F.count(F.when(F.col("_tag") == i, 1)).alias(f"_n{i}") for i in range(width)])
    totals = per_key.agg(*[F.sum(F.when(F.col("_domain") == number, count)).alias(f"_v{i}")
                           for i, (_, _, _, number, count) in enumerate(checks)])
    return _unpivoted(totals, [check[:3] for check in checks])


def _unpivoted(totals: DataFrame, checks: list[tuple[str, str, str]]) -> DataFrame:
    """One row per check from one row of totals ``_v0, _v1, ...``."""
    rows = ", ".join(f"{_quote(check)}, {_quote(table)}, {_quote(column)}, CAST(COALESCE(_v{i}, 0) AS BIGINT)"
                     for i, (check, table, column) in enumerate(checks))
    return totals.selectExpr(f"stack({len(checks)}, {rows}) AS (`check`, `table`, `column`, violations)")


def unique_keys(tables: Tables) -> DataFrame:
    """Rows beyond the first per key value, for primary keys and declared unique columns."""
    return key_audit(tables, ("unique",))


def unique_keys_apart(tables: Tables) -> DataFrame:
    """The rows of ``unique_keys``, each key column grouped by itself: a table stored in buckets of its
    key is counted where it lies, without a shuffle."""
    pairs = [*schemas.PRIMARY_KEYS.items(), *[(t, c) for t, cols in schemas.UNIQUE_KEYS.items() for c in cols]]
    return _union([
        _row(tables[t].where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n")),
             "unique", t, c, F.sum(F.col("_n") - 1))
        for t, c in pairs if t in tables])


def orphans(tables: Tables) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    return key_audit(tables, ("relationships",))


def _quote(value) -> str:
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _table_checks(tables: Tables, kinds: tuple[str, ...]) -> dict[str, list[tuple[str, str, str]]]:
    """Per table: (check, column, SQL condition that flags a violating row)."""
    specs: dict[str, list[tuple[str, str, str]]] = {}
    if "not_null" in kinds:
        for table in schemas.TABLES:
            if table in tables:
                for column in schemas.not_null_columns(table):
                    specs.setdefault(table, []).append(("not_null", column, f"`{column}` IS NULL"))
    if "accepted_values" in kinds:
        for table, column, values in schemas.ACCEPTED_VALUES:
            if table in tables:
                allowed = ", ".join(_quote(v) for v in values)
                specs.setdefault(table, []).append(
                    ("accepted_values", column, f"`{column}` IS NOT NULL AND `{column}` NOT IN ({allowed})"))
    if "range" in kinds:
        for table, column, low, high in schemas.RANGES:
            if table in tables:
                bad = [f"`{column}` < {low}"] if low is not None else []
                bad += [f"`{column}` > {high}"] if high is not None else []
                specs.setdefault(table, []).append(
                    ("range", column, f"`{column}` IS NOT NULL AND ({' OR '.join(bad)})"))
    return specs


def _single_pass(tables: Tables, kinds: tuple[str, ...]) -> DataFrame:
    """Not-null / accepted-values / range checks: one aggregation pass per table for all kinds.

    The generated conditions are SQL text, so a table with dozens of checks is one
    expression per check for the planner (and one round trip from Python).
    """
    frames = []
    for table, checks in _table_checks(tables, kinds).items():
        sums = [f"SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS _v{i}" for i, (_, _, cond) in enumerate(checks)]
        frames.append(_unpivoted(tables[table].selectExpr(*sums), [(check, table, column) for check, column, _ in checks]))
    return _union(frames)


ROW_CHECKS = ("not_null", "accepted_values", "range")


def observations(table: str) -> list[Column]:
    """What to observe while ``table`` is written: its row checks, and totals that marts are held to."""
    checks = _table_checks({table: None}, ROW_CHECKS)[table]
    out = [F.expr(f"COUNT(CASE WHEN {cond} THEN 1 END)").alias(f"{check}:{column}") for check, column, cond in checks]
    if table == "fct_orders":
        out.append(F.sum("contribution_margin").alias("contribution_margin"))
    if table == "dim_prospect":
        out += [F.min("converted").alias("least_converted"), F.max("converted").alias("most_converted")]
    return out


def observed_checks(spark, observed: dict[str, dict]) -> DataFrame:
    """The row checks of written tables, as they were observed (a row a declared check)."""
    rows = [(check, table, column, int(observed[table][f"{check}:{column}"]))
            for table, checks in _table_checks(dict.fromkeys(observed), ROW_CHECKS).items() for check, column, _ in checks]
    return spark.createDataFrame(rows, "check string, table string, column string, violations bigint")


def not_null(tables: Tables) -> DataFrame:
    return _single_pass(tables, ("not_null",))


def accepted_values(tables: Tables) -> DataFrame:
    return _single_pass(tables, ("accepted_values",))


def ranges(tables: Tables) -> DataFrame:
    return _single_pass(tables, ("range",))


def _told(check: str, table: str, column: str, violated: Column) -> list[Column]:
    return [F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"),
            F.when(violated, 1).otherwise(0).cast("bigint").alias("violations")]


def reconciliation(orders: DataFrame, channel_mart: DataFrame, observed: dict | None = None) -> DataFrame:
    """1 when the channel mart's margin total differs from the orders total at cents precision.

    The orders total is what was observed while the orders were written, or else is added up.
    """
    mart = channel_mart.agg(
        F.round(F.sum(F.col("contribution_margin").cast("decimal(18,2)")), 2).alias("_mart"))
    if observed is not None:
        raw = F.round(F.lit(observed["fct_orders"]["contribution_margin"]).cast("decimal(28,2)"), 2)
    else:
        raw = single_row(orders.agg(F.round(F.sum("contribution_margin"), 2).alias("_raw")))["_raw"]
    return mart.select(*_told("reconciliation", "mart_channel_profitability", "contribution_margin",
                              ~raw.eqNullSafe(F.col("_mart"))))


def experiment_health(prospects: DataFrame, experiment_mart: DataFrame, observed: dict | None = None) -> DataFrame:
    """Outcome variety: converted must take both 0 and 1; each arm's rate must lie in (0, 1)."""
    if observed is not None:
        seen = observed["dim_prospect"]
        varied = (seen["least_converted"], seen["most_converted"]) == ("0", "1")
        variety = prospects.sparkSession.createDataFrame(
            [("outcome_variety", "dim_prospect", "converted", int(not varied))],
            "check string, table string, column string, violations bigint")
    else:
        p = prospects.agg(F.min("converted").alias("_lo"), F.max("converted").alias("_hi"))
        both = F.coalesce((F.col("_lo") == 0) & (F.col("_hi") == 1), F.lit(False))
        variety = p.select(*_told("outcome_variety", "dim_prospect", "converted", ~both))
    rate = F.col("conversion_rate")
    arms = _row(experiment_mart, "arm_rate_interior", "mart_experiment", "conversion_rate",
                F.sum(((rate <= 0) | (rate >= 1) | rate.isNull()).cast("int")))
    return variety.unionByName(arms)


def table_checks(tables: Tables, observed: dict | None = None) -> DataFrame:
    """Every check that looks at tables alone, one row each; row checks as ``observed``, if given."""
    rows = (_single_pass(tables, ROW_CHECKS) if observed is None
            else observed_checks(next(iter(tables.values())).sparkSession, observed))
    return key_audit(tables).unionByName(rows)


def report(tables: Tables, channel_mart: DataFrame, experiment_mart: DataFrame, observed: dict | None = None) -> DataFrame:
    """Every check, one row each; ``observed`` is what the load of the tables has observed."""
    return _union([
        table_checks(tables, observed), reconciliation(tables["fct_orders"], channel_mart, observed),
        experiment_health(tables["dim_prospect"], experiment_mart, observed),
    ])


def schema_violations(tables: Tables, check_nullable: bool = False) -> list[tuple[str, str, str]]:
    """Declared-schema check (driver-side, metadata only): (table, column, problem) per mismatch.

    A missing column or an unexpected type is reported, and with ``check_nullable`` a nullable
    column declared NOT NULL (tables read from Parquet are always nullable: for them ``not_null``
    looks at the rows).  Extra columns are allowed (the typed load ignores them too).
    """
    problems = []
    for table, df in tables.items():
        actual = {f.name: f for f in df.schema.fields}
        for f in schemas.TABLES[table].fields:
            got = actual.get(f.name)
            if got is None:
                problems.append((table, f.name, "missing"))
            elif got.nullable and not f.nullable and check_nullable:
                problems.append((table, f.name, "nullable"))
            elif got.dataType != f.dataType:
                problems.append((table, f.name, f"type {got.dataType.simpleString()} != {f.dataType.simpleString()}"))
    return problems


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required output columns absent from ``df`` (metadata only)."""
    return [c for c in required if c not in df.columns]


class QualityError(AssertionError):
    pass


def assert_quality(report_df: DataFrame) -> None:
    """Raise when any check has violations (runs one small job over the report)."""
    failing = report_df.where(F.col("violations") > 0).collect()  # a row a declared check at most
    if failing:
        detail = ", ".join(f"{r['check']} {r['table']}.{r['column']}={r['violations']}" for r in failing)
        raise QualityError(f"data quality violations: {detail}")
