"""Exact order statistics of groups that never meet in one task.

``ROW_NUMBER() OVER (PARTITION BY g ORDER BY day, id)`` sends every row of a group to one task, and a
group may hold a third of all rows.  ``number_by_day`` numbers on two levels instead.  Rows are counted
by (group, day) first, combined before the shuffle; a window over a group's days, of which the calendar
has few, gives each day the number of rows before it.  Only rows of one day are then ranked.  A day with
more rows than two average partitions is cut by ranges of the id: by its first characters, a few beyond
those that all ids of the day share, and the rows of the ranges before are counted likewise.  Nothing is
sampled and nothing is written: the numbers follow from the rows alone, however often a task is repeated.

``median_by_digits`` selects the middle values of a group from counts of its distinct values: by their
high digits first, then, inside the one or two parts that hold the middle, by the digits below.  A task
holds the counts of a group's high parts, or of one part, never a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import hot_keys, salted_join, shuffle_partitions

LOW_BITS = 20  # of a value, left to the second step of a selection: about a million values a part


def _shared_start(a: Column, b: Column) -> Column:
    """Number of leading characters that two strings have in common."""
    at = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.array_max(F.filter(at, lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)))


def number_by_day(rows: DataFrame, by: str, day: str, key: str, out: str = "row_number", first: str = "first_day",
                  within: int | None = None) -> DataFrame:
    """``rows`` with the ``first`` day of each row's group and its number ``out`` by (day, key) in the group.

    ``key`` is a unique string.  With ``within`` only rows of a group's first ``within`` days stay.
    Rows without a group are left out.
    """
    p = shuffle_partitions(rows)
    counted = rows.where(F.col(by).isNotNull()).groupBy(by, day).agg(
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_least"), F.max(key).alias("_most"))
    group = Window.partitionBy(by)
    days = counted.select(
        by, day, "_n", "_least", "_most", F.min(day).over(group).alias(first), F.sum("_n").over(group).alias("_of_group"),
        F.coalesce(F.sum("_n").over(group.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    if within is not None:
        days = days.where(F.col(day) < F.date_add(F.col(first), within))
    # Fewer than P / 2 days have more than two average partitions; the others are one range each.
    share = F.col("_n") * F.lit(p) / days.agg(F.sum("_n")).scalar()
    deep = F.when(share > 2, _shared_start(F.col("_least"), F.col("_most")) + F.ceil(F.log10(share)).cast("int") + 1)
    days = days.select(by, day, first, "_of_group", "_before", "_n", F.coalesce(deep, F.lit(0)).alias("_deep"))
    starts = lambda: F.substring(F.col(key), F.lit(1), F.col("_deep"))

    hot_days = F.broadcast(days.where("_deep > 0").select(by, day, "_deep"))
    ranges = rows.select(by, day, key).join(hot_days, [by, day]).groupBy(by, day, starts().alias("_range")).agg(
        F.count(F.lit(1)).alias("_in_range"))
    earlier = Window.partitionBy(by, day).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(by, day, "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_ranges_before"))

    groups = days.where(F.col(day) == F.col(first)).select(by, "_of_group")
    told = days.select(by, day, first, "_before", "_deep")
    placed = salted_join(rows, told, by, hot_keys(groups, by, "_of_group"), "inner", spread_by=key, also=(day,))
    placed = placed.withColumn("_range", starts()).join(ranges, [by, day, "_range"], "left")
    own = F.row_number().over(Window.partitionBy(by, day, "_range").orderBy(key))
    number = (F.col("_before") + F.coalesce("_ranges_before", F.lit(0)) + own).cast("int")
    return placed.withColumn(out, number).select(*rows.columns, first, out)


def _met(left: DataFrame, right: DataFrame, by: list[str]) -> Column:
    """NULL-safe equality of the columns ``by`` with ``right``'s, which bear a leading underscore."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in by])


def _holding(parts: Column, position: Column) -> Column:
    """struct(part, before) of the part with a 1-based position, from sorted structs (part, n)."""
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("part"),
                     F.lit(0).cast("bigint").alias("before"))
    step = lambda acc, x: F.when(acc["part"].isNull() & (acc["seen"] + x["n"] >= position), F.struct(
        (acc["seen"] + x["n"]).alias("seen"), x["part"].alias("part"), acc["seen"].alias("before"))).otherwise(
        F.struct((acc["seen"] + x["n"]).alias("seen"), acc["part"].alias("part"), acc["before"].alias("before")))
    return F.aggregate(parts, start, step)


def median_by_digits(counted: DataFrame, by: list[str], value: str, n: str) -> DataFrame:
    """``by`` with ``low`` and ``high``, the middle values of each group (equal where its size is odd).

    ``counted`` has a row for each group and distinct ``value`` (bigint), ``n`` times there; rows with a
    null value or without ``n`` don't count, and a group of such rows alone has no result.
    """
    rows = counted.where(F.col(value).isNotNull() & (F.col(n) > 0)).select(
        *by, F.col(value).alias("_value"), F.shiftright(value, LOW_BITS).alias("_part"), F.col(n).cast("bigint").alias("_n"))
    parts = rows.groupBy(*by, "_part").agg(F.sum("_n").alias("_n"))
    tops = parts.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_part").alias("part"), F.col("_n").alias("n")))).alias("_parts"),
        F.sum("_n").alias("_all"))
    places = F.array_distinct(F.array(F.expr("(_all + 1) div 2"), F.expr("_all div 2 + 1")))
    wanted = tops.select(*[F.col(c).alias(f"_{c}") for c in by], "_parts", F.explode(places).alias("_place"))
    wanted = wanted.withColumn("_at", _holding(F.col("_parts"), F.col("_place"))).select(
        *[f"_{c}" for c in by], F.col("_at.part").alias("_wanted"), (F.col("_place") - F.col("_at.before")).alias("_nth"))
    inside = rows.join(wanted, _met(rows, wanted, by) & (F.col("_part") == F.col("_wanted")))
    found = inside.groupBy(*by, "_nth", "_wanted").agg(F.sort_array(F.collect_list(F.struct(
        F.col("_value").alias("part"), F.col("_n").alias("n")))).alias("_values"))
    middle = found.select(*by, _holding(F.col("_values"), F.col("_nth"))["part"].alias("_middle"))
    return middle.groupBy(*by).agg(F.min("_middle").alias("low"), F.max("_middle").alias("high"))
