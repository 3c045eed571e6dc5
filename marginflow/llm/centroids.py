"""Centroid clustering of integer vectors by scalar lookup tables.

Components become whole numbers, ``floor(scale * x)``.  Each round tabulates the squared difference
of every dimension, occurring whole number and centroid; a vector's distances are gathers from that
table and a sum over dimensions.  Assigning is one scan without a shuffle: every task adds up its
vectors by cluster, and Spark adds these sums, ``k`` times ``dims`` numbers, which become the next
centroids on the driver.  Vectors never leave their task.

The table of a round has ``dims * occurring numbers * k`` cells and travels to the tasks, so its size
is checked: beyond ``TABLE_CELLS`` each batch of vectors is tabulated by itself, for the numbers
occurring in it, with the same distances.

Defined results: vectors without exactly ``dims`` components, or with a null or non-finite one, are
left out; of equal distances the smaller cluster number wins; repeated rows each count; a null id
can't be drawn as a first centroid but its vector is assigned; vectors of one id stand by their
components; with fewer than ``k`` vectors there are as many clusters; no vectors give no rows; columns
beside the two named are not read, whatever their names.  Components of ``BOUND`` and more, whose
distances could leave the range of a long, stop the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches

TABLE_CELLS = 4_000_000  # of 8 bytes: what one round sends to a task at most
BOUND = 1 << 27  # dims * (2 * BOUND) ** 2 stays within a long up to 128 dimensions


def whole_numbers(vector: Column, scale: int, bound: int = BOUND) -> Column:
    """``floor(scale * x)`` of each component; a null or non-finite one makes it null, one of
    ``bound`` and more stops the job."""
    vector = F.transform(vector, lambda x: x.cast("double"))
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    near = F.forall(vector, lambda x: F.abs(x * F.lit(float(scale))) < bound)
    numbers = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("int"))
    return F.when(sound, F.when(near, numbers).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("array<int>")))


def tabulate(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared differences: dimension x occurring value x centroid."""
    return (values[None, :, None] - centroids.T[:, None, :]) ** 2


def distances(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Rows x centroids: gathers from the table, summed over dimensions; ``codes`` are value numbers."""
    total = np.zeros((len(codes), table.shape[2]), np.int64)
    for dim in range(table.shape[0]):
        total += table[dim][codes[:, dim]]
    return total


class Assigner:
    """Nearest centroid of vectors, under one round's centroids."""

    def __init__(self, centroids: np.ndarray, values: np.ndarray | None):
        self.centroids, self.values = centroids, values
        self.table = None if values is None else tabulate(values, centroids)

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values, table = self.values, self.table
        if values is None:
            values = np.unique(vectors)
            table = tabulate(values, self.centroids)
        total = distances(np.searchsorted(values, vectors), table)
        nearest = total.argmin(axis=1)  # the first of equals
        return nearest, total[np.arange(len(total)), nearest]


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _occurring(vectors: DataFrame, dims: int, k: int) -> np.ndarray | None:
    """The whole numbers that occur; None where a table of them would be too large."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_vectors(batch, dims)), pa.int64())], ["value"])

    found = vectors.select("v").mapInArrow(run, "value long").distinct()
    most = TABLE_CELLS // (dims * k)
    values = [r.value for r in found.limit(most + 1).collect()]
    return np.array(sorted(values), np.int64) if len(values) <= most else None


def _sums(vectors: DataFrame, assign: Assigner, dims: int) -> DataFrame:
    """``cluster, dim, n, total`` over all vectors."""
    k = len(assign.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            rows = _vectors(batch, dims)
            cluster, _ = assign(rows)
            n += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, rows)
        some = np.repeat(np.flatnonzero(n), dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(np.tile(np.arange(dims), len(some) // dims), pa.int32()),
             pa.array(n[some]), pa.array(total[n > 0].ravel())], ["cluster", "dim", "n", "total"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, dim int, n long, total long")
    return parts.groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _assigned(vectors: DataFrame, assign: Assigner, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = assign(_vectors(batch, dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` (squared) of each vector, and the final centroids.

    The first centroids are the ``k`` vectors of least sha256 of ``<seed>:<id>``.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "centroids")
    small_batches(spark)
    sound = (rows.where(F.size(vector_col) == dims)
             .select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col), scale).alias("v"))
             .where("v is not null"))
    vectors = scratch.table("vectors", sound)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.where("vec_id is not null").orderBy(drawn, "v").limit(k).collect()  # k rows
    if not first:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), \
            np.zeros((0, dims), np.int64)
    centroids = np.array([r.v for r in first], np.int64)
    values = _occurring(vectors, dims, len(centroids))
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(vectors, Assigner(centroids, values), dims).collect():  # k * dims rows
            moved[r.cluster, r.dim] = int(r.total) // r.n
        centroids = moved
    return scratch.table("assigned", _assigned(vectors, Assigner(centroids, values), dims)), centroids


def with_totals(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignment with the inertia of each cluster and of all, and each centroid's digest."""
    by = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # a row a cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def told(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster") + 1)

    return assigned.select(
        "vec_id", "cluster", "distance", told([by.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(by.values())).cast("long").alias("inertia"), told(digests, "string").alias("centroid_sha256"))
