"""Reusable metric layer: named measures evaluated under any grouping of the star's attributes.

Each measure is defined once, in ``MEASURES``, over sums and counts of one or two facts.  A fact
is aggregated on those of the requested attributes that filter it: its own columns, or columns of
a dimension above it (an order has its prospect's attributes, a delivery its order's).  As in a
star model, an attribute that does not reach a fact does not filter it: prospects by carrier are
all prospects, under each carrier.  Rows are the attribute values of the facts that every
requested attribute reaches.  Without attributes the result is the grand total.

Facts are aggregated separately, so none is multiplied by another (no fan-out); aggregates are
united and grouped, which keeps a NULL attribute value one row.  Division is null-safe.  Prospects
and orders are counted as rows: their keys are checked when a warehouse is built.

``metric_layer_subtotals`` gives every coarser grouping, down to the grand total, in one call.  Each
fact is aggregated once, to its finest grouping; the lattice of coarser ones is rolled up from that
small table.  ``grouping_id`` tells a total (NULL, bit set) from a NULL attribute value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import mean_of, ratio, round_money, single_row

DEFAULT_KEYS = ("market", "acquisition_channel")

# Sums and counts that a fact contributes: name -> (fact, aggregate).
PARTS = {
    "eligible": ("prospects", lambda: F.count(F.lit(1))),
    "converted": ("prospects", lambda: F.sum("_converted")),
    "revenue": ("orders", lambda: F.sum("net_revenue")),
    "margin": ("orders", lambda: F.sum("contribution_margin")),
    "on_time": ("deliveries", lambda: F.sum("on_time")),
    "judged": ("deliveries", lambda: F.count("on_time")),
}


def _number(part: str) -> Column:
    return F.coalesce(F.col(part), F.lit(0))


# The measures over these parts.
MEASURES = {
    "eligible_prospects": lambda: _number("eligible").cast("bigint"),
    "converted_prospects": lambda: _number("converted").cast("bigint"),
    "conversion_rate": lambda: ratio(F.col("converted"), _number("eligible")),
    "net_revenue": lambda: round_money(F.col("revenue")),
    "contribution_margin": lambda: round_money(F.col("margin")),
    "contribution_margin_pct": lambda: ratio(F.col("margin"), F.col("revenue")),
    "margin_per_eligible_prospect": lambda: ratio(F.col("margin"), _number("eligible")),
    "on_time_delivery_rate": lambda: mean_of(F.col("on_time"), F.col("judged")),
}


def _joined(fact: DataFrame, above: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    return fact.join(above.select(key, *wanted), key, "left") if wanted else fact


def _facts(prospects: DataFrame, orders: DataFrame, deliveries: DataFrame, keys: list[str],
           assignments: DataFrame | None) -> dict[str, DataFrame]:
    """Each fact with those requested attributes that tables above it have.

    Deliveries meet their orders first, on the key both are stored by, and prospects after that.
    """
    if assignments is not None and "treatment" in keys:
        prospects = prospects.join(assignments.select("prospect_id", "treatment"), "prospect_id", "left")
    people = prospects.where(F.col("prospect_id").isNotNull()).withColumn("_converted", (F.col("converted") == 1).cast("int"))
    of_prospect = [k for k in keys if k not in orders.columns and k in prospects.columns]
    bought = _joined(orders, prospects, "prospect_id", of_prospect)
    of_order = [k for k in keys if k not in deliveries.columns and k in orders.columns]
    of_prospect = [k for k in of_prospect if k not in deliveries.columns]
    shipped = _joined(deliveries, orders, "order_id", [*of_order, *["prospect_id"] * bool(of_prospect)])
    shipped = _joined(shipped, prospects, "prospect_id", of_prospect)
    return {"prospects": people, "orders": bought, "deliveries": shipped}


def _aggregated(facts: dict[str, DataFrame], name: str, keys: list[str]) -> tuple[list[str], list[str], DataFrame]:
    """A fact's reach among ``keys``, its parts, and its finest aggregate."""
    reach = [k for k in keys if k in facts[name].columns]
    parts = {p: make() for p, (fact, make) in PARTS.items() if fact == name}
    return reach, list(parts), facts[name].groupBy(*reach).agg(*[c.alias(p) for p, c in parts.items()])


def _wide(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and all parts; those that ``df`` lacks are NULL."""
    parts = [F.col(p) if p in df.columns else F.lit(None).cast("decimal(38,2)").alias(p) for p in PARTS]
    return df.select(*columns, *parts)


def metric_layer(prospects: DataFrame, orders: DataFrame, deliveries: DataFrame,
                 keys: tuple[str, ...] = DEFAULT_KEYS, assignments: DataFrame | None = None) -> DataFrame:
    """The measures by ``keys``."""
    keys = list(keys)
    facts = _facts(prospects, orders, deliveries, keys, assignments)
    done = [_aggregated(facts, name, keys) for name in facts]
    whole = [df for reach, _, df in done if reach == keys]  # facts that every attribute reaches
    if not whole:
        raise ValueError(f"no fact has all of {keys}")
    rows = reduce(DataFrame.union, [_wide(df, keys) for df in whole])
    out = rows.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in PARTS])
    for reach, parts, mine in done:  # facts that only some attributes reach: their value repeats
        if reach == keys:
            continue
        if reach:
            side = mine.select(*[F.col(k).alias(f"_{k}") for k in reach], *parts)
            met = [out[k].eqNullSafe(side[f"_{k}"]) for k in reach]
            out = out.drop(*parts).join(side, met, "left")
        else:
            total = single_row(mine)
            out = out.select(*[c for c in out.columns if c not in parts], *[total[p].alias(p) for p in parts])
    return out.select(*keys, *[make().alias(m) for m, make in MEASURES.items()])


def metric_layer_subtotals(prospects: DataFrame, orders: DataFrame, deliveries: DataFrame,
                           keys: tuple[str, ...] = DEFAULT_KEYS, assignments: DataFrame | None = None) -> DataFrame:
    """The measures by every subset of ``keys``; ``grouping_id`` has a bit for each key that is totalled,
    the last key's lowest, as in SQL.  Rows of a subset are those of ``metric_layer`` by it; without any
    prospect, order and delivery there are none."""
    keys = list(keys)
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    facts = _facts(prospects, orders, deliveries, keys, assignments)
    lattice = []
    for name in facts:
        reach, parts, detail = _aggregated(facts, name, keys)
        beyond = sum(bit[k] for k in keys if k not in reach)  # never grouped by in this fact
        totalled = F.lit(beyond)
        for k in reach:
            totalled = totalled + F.grouping(k) * bit[k]
        rolled = detail.cube(*reach).agg(totalled.cast("int").alias("grouping_id"), *[F.sum(p).alias(p) for p in parts]) \
            if reach else detail.select(totalled.cast("int").alias("grouping_id"), *parts)
        lattice.append((reach, parts, beyond, rolled))
    if not any(reach == keys for reach, *_ in lattice):
        raise ValueError(f"no fact has all of {keys}")
    rows = reduce(DataFrame.union, [
        _wide(df.select("grouping_id", *[F.col(k) if k in reach else F.lit(None).cast("string").alias(k) for k in keys], *parts),
              ["grouping_id", *keys]) for reach, parts, _, df in lattice])
    out = rows.groupBy("grouping_id", *keys).agg(*[F.sum(p).alias(p) for p in PARTS])
    for reach, parts, beyond, rolled in lattice:  # under finer groupings a fact's value repeats
        if reach == keys:
            continue
        side = rolled.select(F.col("grouping_id").alias("_id"), *[F.col(k).alias(f"_{k}") for k in reach], *parts)
        met = [(out["grouping_id"].bitwiseOR(F.lit(beyond))) == side["_id"], *[out[k].eqNullSafe(side[f"_{k}"]) for k in reach]]
        out = out.drop(*parts).join(side, met, "left").select("grouping_id", *keys, *PARTS)
    return out.select(*keys, "grouping_id", *[make().alias(m) for m, make in MEASURES.items()])
