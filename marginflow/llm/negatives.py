"""Hard negatives from STR-packed R-trees.

Vectors of whole numbers are packed by sort-tile-recursive: Spark sorts all rows by (components,
label, first component) and deals them to groups by ranges, and each group's rows of one label are cut
into tiles by one coordinate after another, down to leaves of ``LEAF`` rows.  Leaves are written once.
A group's leaves make an R-tree for each label: a node is the minimum bounding box of its children.

A query's inner product with anything in a box lies in the sum of per-coordinate intervals.  The search
of a tree is best-first: a queue yields the box of the greatest reachable score; boxes wholly outside
the query's score window, or strictly below the k-th score found so far, are never opened.  Scores are
exact: whole numbers below 2**53 in double precision.

Queries meet all groups, each once, in rounds that visit more groups each time (1, 3, 12, ...).  After
a round the k best of each window are kept, and the k-th score so far prunes the next round's boxes, so
that later groups send back only what may still count.  A group and the queries that visit it are
streamed: leaves first, then queries, batch by batch; neither a label, nor a group of equal vectors, nor
all queries meet in one place.  There are about sqrt(rows) / 24 groups, so groups times queries stay a
small multiple of the input, and no group has more than ``GROUP_ROWS`` rows, about.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no
part; vectors with different numbers of components don't meet; a row is no positive or negative of an
anchor of its own id; repeated rows each count, and each repeated anchor is searched (rows of one id
stand by score alone); no anchors, positives or negatives give no rows; columns beside the three named
are not read, whatever their names.  Components of ``BOUND`` and more stop the job.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .centroids import whole_numbers
from .common import Scratch, small_batches

LEAF, FANOUT = 64, 16
GROUP_ROWS = 1 << 19
BOUND = 1 << 22  # inner products stay below 2**53 up to 512 components
GROWTH = 4  # of the number of groups visited, from round to round
LEAVES = "grp int, label int, ids array<long>, v array<int>"
HITS = "query long, slot int, score long, vec_id long"


def pack(vectors: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Sort-tile-recursive order of rows: consecutive runs of ``leaf`` rows are tight boxes."""
    axes = np.argsort(-vectors.var(axis=0), kind="stable") if vectors.shape[1] else np.zeros(0, int)
    tiles = math.ceil(len(vectors) / leaf)
    depth = max(1, min(len(axes), math.ceil(math.log2(max(2, tiles)) / 3)))  # coordinates that cut

    def cut(rows: np.ndarray, level: int) -> list[np.ndarray]:
        if len(rows) <= leaf or level == depth:
            return [rows]
        rows = rows[np.argsort(vectors[rows, axes[level]], kind="stable")]
        slabs = math.ceil(math.ceil(len(rows) / leaf) ** (1 / (depth - level)))
        size = leaf * math.ceil(math.ceil(len(rows) / leaf) / slabs)  # whole leaves a slab
        return [x for at in range(0, len(rows), size) for x in cut(rows[at:at + size], level + 1)]

    return np.concatenate(cut(np.arange(len(vectors)), 0)) if len(axes) else np.arange(len(vectors))


class Tree:
    """R-tree over leaves in packed order; ``levels[0]`` holds the leaves' boxes, the last the root's."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray]]):
        self.leaves = leaves
        low, high = (np.array([f(v, axis=0) for _, v in leaves]) for f in (np.min, np.max))
        self.levels = [(low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((low, high))

    def reach(self, level: int, first: int, stop: int, query: "Query") -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product with anything in the boxes [first, stop) of a level."""
        low, high = (x[first:stop] for x in self.levels[level])
        return low @ query.up + high @ query.down, high @ query.up + low @ query.down


class Query:
    """A query's vector and the scores of the leaves it has opened."""

    def __init__(self, vec_id: int, vector: np.ndarray):
        self.vec_id, self.vector = vec_id, vector
        self.up, self.down = np.maximum(vector, 0), np.minimum(vector, 0)
        self.scores: dict = {}

    def leaf(self, tree: Tree, at: int) -> tuple[np.ndarray, np.ndarray]:
        key = id(tree), at
        if key not in self.scores:
            ids, vectors = tree.leaves[at]
            self.scores[key] = ids, vectors @ self.vector
        return self.scores[key]


def search(query: Query, trees: list[Tree], k: int, low: float, high: float,
           floor: float = -math.inf) -> list[tuple[int, int]]:
    """The ``k`` best (score, id) in the trees with ``low <= score <= high``, none below ``floor``;
    higher scores first, then smaller ids, and an id's rows by their order."""
    best: list[tuple[float, int]] = []  # (score, -id), the worst first
    queue: list[tuple[float, int, int, int]] = []

    def offer(nth: int, level: int, first: int, stop: int) -> None:
        least, greatest = trees[nth].reach(level, first, stop, query)
        for i in np.flatnonzero((greatest >= max(low, floor)) & (least <= high)).tolist():
            heapq.heappush(queue, (-min(float(greatest[i]), high), nth, level, first + i))

    for nth, tree in enumerate(trees):
        offer(nth, len(tree.levels) - 1, 0, 1)
    while queue:
        reachable, nth, level, at = heapq.heappop(queue)
        if -reachable < floor:
            break  # strictly below the k-th, as is all that is left
        if level:
            offer(nth, level - 1, at * FANOUT, min(len(trees[nth].levels[level - 1][0]), (at + 1) * FANOUT))
            continue
        ids, scores = query.leaf(trees[nth], at)
        for i in np.flatnonzero((scores >= max(low, floor)) & (scores <= high) & (ids != query.vec_id)).tolist():
            found = float(scores[i]), -int(ids[i])
            if len(best) < k:
                heapq.heappush(best, found)
            elif found > best[0]:
                heapq.heapreplace(best, found)
            if len(best) == k:
                floor = max(floor, best[0][0])
    return [(int(score), -i) for score, i in sorted(best, reverse=True)]


def _forest(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> dict[tuple[int, int], Tree]:
    """Trees by (components, label), of a group's leaves."""
    by: dict[tuple[int, int], list] = {}
    for label, ids, flat in rows:
        by.setdefault((len(flat) // len(ids), label), []).append((ids, flat.reshape(len(ids), -1).astype(np.float64)))
    return {key: Tree(leaves) for key, leaves in by.items()}


def packed(rows: DataFrame, groups: int, scratch: Scratch) -> DataFrame:
    """Leaves of ``rows`` (``vec_id, label, v``), written; a group is a range of the sorted rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group, kept, n = TaskContext.get().partitionId(), {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (_, label), parts in kept.items():
                ids = np.concatenate([x for x, _ in parts])
                vectors = np.concatenate([x for _, x in parts])
                order = pack(vectors)
                cuts = [order[at:at + LEAF] for at in range(0, len(order), LEAF)]
                for at in range(0, len(cuts), 64):
                    some = cuts[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group] * len(some), pa.int32()), pa.array([label] * len(some), pa.int32()),
                         pa.array([ids[c] for c in some], pa.list_(pa.int64())),
                         pa.array([vectors[c].ravel() for c in some], pa.list_(pa.int32()))], ["grp", "label", "ids", "v"])

        for batch in batches:
            labels, ids = (batch.column(c).to_numpy() for c in ("label", "vec_id"))
            sizes = batch.column("v").value_lengths().to_numpy()
            flat = batch.column("v").flatten().to_numpy()
            ends = sizes.cumsum()
            for size, label in set(zip(sizes.tolist(), labels.tolist(), strict=True)):
                at = np.flatnonzero((sizes == size) & (labels == label))
                vectors = flat[(ends[at] - size)[:, None] + np.arange(size)]
                kept.setdefault((size, label), []).append((ids[at], vectors))
            n += batch.num_rows
            if n >= 2 * GROUP_ROWS:  # whatever the ranges hold, memory has a bound
                yield from flush()
                kept, n = {}, 0
        yield from flush()

    dealt = rows.repartitionByRange(groups, F.size("v"), "label", F.get("v", F.lit(0)), "vec_id")
    return scratch.table("leaves", dealt.mapInArrow(run, LEAVES))


def _visits(leaves: DataFrame, queries: DataFrame, groups: int, k: int, same: bool) -> DataFrame:
    """The hits of ``queries`` (``query, grp, vec_id, label, v, windows, floors``) in the group each names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, forest = None, [], {}
        for batch in batches:
            hits = []
            for r in batch.to_pylist():
                if r["grp"] != group:
                    group, rows, forest = r["grp"], [], {}
                if r["query"] is None:
                    rows.append((r["label"], np.array(r["ids"], np.int64), np.array(r["v"], np.int64)))
                    continue
                if rows:
                    forest, rows = _forest(rows), []
                trees = [t for (size, label), t in forest.items() if size == len(r["v"]) and (label == r["label"]) == same]
                query = Query(r["vec_id"], np.array(r["v"], np.float64))
                for slot, (window, floor) in enumerate(zip(r["windows"], r["floors"], strict=True)):
                    low, high = (x if x is not None else y for x, y in ((window["low"], -math.inf), (window["high"], math.inf)))
                    hits += [(r["query"], slot, s, i) for s, i in search(
                        query, trees, k, low, high, -math.inf if floor is None else floor)]
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*hits, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                    ["query", "slot", "score", "vec_id"])

    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    windows = queries.schema["windows"].dataType
    stream = leaves.select("grp", none("long", "query"), none("long", "vec_id"), "label", "ids", "v",
                           none(windows, "windows"), none("array<long>", "floors")).union(
        queries.select("grp", "query", "vec_id", "label", none("array<long>", "ids"), "v", "windows", "floors"))
    dealt = stream.repartition(groups, "grp").sortWithinPartitions("grp", F.col("query").asc_nulls_first())
    return dealt.mapInArrow(run, HITS)


def best(leaves: DataFrame, queries: DataFrame, groups: int, k: int, same: bool, scratch: Scratch, name: str) -> DataFrame:
    """``query, slot, score, vec_id, rank``: the first ``k`` hits in each window of every query.

    ``queries`` has ``query, vec_id, label, v, windows``; ``same`` asks for rows of the query's label,
    else for rows of the others.
    """
    order = W.partitionBy("query", "slot").orderBy(F.col("score").desc(), "vec_id")
    found, start, nth = None, 0, 0
    while start < groups:
        stop = min(groups, start + max(1, (GROWTH - 1) * start))
        # The groups of a round differ by query, so that every group is visited in every round.
        visits = queries.select("*", F.explode(F.sequence(F.lit(start), F.lit(stop - 1))).alias("_step"))
        at = F.pmod(F.col("_step") + F.xxhash64("query"), F.lit(groups)).cast("int")
        if found is None:
            floors = F.transform("windows", lambda w: F.lit(None).cast("long"))
            visits = visits.select("*", floors.alias("floors"), at.alias("grp"))
        else:
            kth = (found.where(F.col("rank") == k).groupBy("query")
                   .agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth")))  # an entry a window
            floors = F.transform("windows", lambda w, i: F.try_element_at(F.col("kth"), i))
            visits = visits.join(kth, "query", "left").select("*", floors.alias("floors"), at.alias("grp"))
        hits = _visits(leaves, visits, groups, k, same)
        if found is not None:
            hits = hits.union(found.drop("rank"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found = scratch.table(f"{name}{nth}", ranked)
        if nth:
            scratch.drop(f"{name}{nth - 1}")
        start, nth = stop, nth + 1
    return found


def mine(rows: DataFrame, anchors: Column, scale: int = 256, positives: int = 5, negatives: int = 10,
         low_percent: int = 30, high_percent: int = 90, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``vec_id``; a negative's score is ``low_percent`` to ``high_percent``
    of the positive's.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "negatives")
    small_batches(spark)
    sound = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
                        whole_numbers(F.col(vector_col), scale, BOUND).alias("v")).where(
        "vec_id is not null and label is not null and v is not null")
    vectors = scratch.table("vectors", sound)
    n = vectors.count()
    groups = max(1, math.ceil(math.sqrt(n) / 24), math.ceil(n / GROUP_ROWS))
    leaves = packed(vectors, groups, scratch)
    groups = (leaves.agg(F.max("grp")).first()[0] or 0) + 1  # as many as Spark has dealt
    chosen = scratch.table("anchors", vectors.where(anchors).select("*", F.monotonically_increasing_id().alias("query")))
    free = F.array(F.struct(F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    first = best(leaves, chosen.withColumn("windows", free), groups, positives, True, scratch, "positives")
    # Windows in hundredths, rounded inwards, so that whole scores compare exactly.
    score = F.col("score")
    window = F.struct(F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), score.alias("positive_score"),
                      F.ceil(score * low_percent / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
                      F.floor(score * high_percent / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"))
    wanted = first.groupBy("query").agg(F.sort_array(F.collect_list(window)).alias("windows"))  # one a positive
    asked = scratch.table("windows", chosen.join(wanted, "query"))
    found = best(leaves, asked, groups, negatives, False, scratch, "negatives")
    told = asked.select("query", F.col("vec_id").alias("anchor_id"), F.posexplode("windows").alias("slot", "w"))
    return told.join(found, ["query", "slot"]).select(
        "anchor_id", "w.positive_id", "rank", F.col("vec_id").alias("negative_id"), "w.positive_score",
        F.col("score").alias("negative_score"))
