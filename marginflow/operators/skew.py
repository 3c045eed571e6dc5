"""Salted joins for hot keys.

A fact joined to a one-row-per-key table (orders to their customer's attributes, orders to
the customer's first order) shuffles both sides on the key, so every row of a key meets in
one task.  If one customer holds a third of all orders, that task holds a third of the job.
AQE can split such a partition only when both join inputs are plain shuffles; here the
per-key side is usually an aggregate, so the split has to be planned explicitly:

* ``hot_keys`` keeps the keys with more rows than two average shuffle partitions.  There are
  fewer than ``P / 2`` of them (``P`` = shuffle partitions), which bounds the table that is
  broadcast.  Each hot key gets ``ceil(rows * P / total)`` salts (at most ``P``).
* ``salted_join`` gives every left row of a hot key a salt from a hash of a unique left
  column and replicates the matching right rows once per salt; all other keys keep salt 0.
  The join then shuffles on ``(key, salt)``, which spreads a hot key over its salts.

``also`` names further columns both sides must agree in (a day, say).  The result is exactly the unsalted join: each left row still meets every right row of its
key, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return partitions or shuffle_partitions(df)


def hot_keys(counts: DataFrame, key: str, count_col: str, partitions: int | None = None) -> DataFrame:
    """Keys whose row count exceeds two average partitions, with their salt count.

    ``counts`` has one row per key.  At most ``P / 2`` keys qualify, so the result is small
    by construction (safe to broadcast).
    """
    p = _partitions(counts, partitions)
    total = counts.agg(F.sum(count_col)).scalar()  # scalar subquery, evaluated once
    share = F.col(count_col) * F.lit(p)
    hot = counts.where(share > F.lit(2) * total)
    salts = F.least(F.lit(p).cast("bigint"), F.ceil(share / total)).cast("int")
    return hot.select(F.col(key).alias("_hot_key"), salts.alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, how: str = "inner",
                spread_by: str | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """``left.join(right, [key, *also], how)`` with the hot keys of ``left`` spread over salts.

    ``how`` is ``inner`` or ``left``; ``spread_by`` is a left column that is unique per row
    (it fixes each row's salt deterministically, so task retries reproduce it).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    spread = spread_by or key
    # ``hot`` is bounded by P / 2 rows (see hot_keys), so broadcasting it is safe.
    hk = F.broadcast(hot)
    lj = left.join(hk, left[key] == hk["_hot_key"], "left")
    # A NULL key meets nothing: its rows are spread over all partitions.
    spread_hash = F.xxhash64(F.col(spread))
    salt_l = F.when(left[key].isNull(), F.pmod(spread_hash, F.lit(_partitions(left, None))).cast("int")).when(
        F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(spread_hash, F.col("_salts")).cast("int"))
    lsalted = lj.select(*[lj[c] for c in left.columns], salt_l.alias("_salt"))
    rj = right.join(hk, right[key] == hk["_hot_key"], "left")
    copies = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("_salts") - 1))
    rsalted = rj.select(*[rj[c] for c in right.columns], F.explode(copies).alias("_salt"))
    return lsalted.join(rsalted, [key, *also, "_salt"], how).drop("_salt")
