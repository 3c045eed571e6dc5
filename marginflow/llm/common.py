"""Shared pieces of the training-data operators: reading, scratch tables, batching, hashing.

Scratch tables live in the folder that the session names in ``spark.checkpoint.dir``; they cut
lineage, so a lost executor re-runs only the step at hand.
"""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Rows and bytes of one Arrow batch: they bound a Python worker's memory where texts are very long.
ROWS_PER_BATCH, BYTES_PER_BATCH = 1024, 16 << 20


def read(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand a Python worker a bounded number of rows and bytes at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text string`` alone: other columns, whatever their names, are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of a column's decimal text, modulo ``modulus`` (null stays null)."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def per_process(key: tuple, build: Callable):
    """What ``build`` gives, made once in a worker process and kept for its later tasks."""
    store = sys.modules.setdefault("marginflow_llm_kept", types.ModuleType("marginflow_llm_kept")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def give_back() -> None:
    """Return to the system what allocators keep of freed memory: a worker lives on, idle or in its next task."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


class Known(dict):
    """Values of a function, kept in bounded memory: keys not asked for while ``size`` others came
    are forgotten and would be computed again."""

    def __init__(self, size: int, compute: Callable):
        super().__init__()
        self.size, self.compute, self.old = size, compute, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Scratch:
    """Tables of one run of one operator, below the session's shared checkpoint folder."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/llm/{operator}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write once, read back."""
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete own tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Rolling:
    """Hashes of any run of a sequence of 64-bit symbols, from one prefix sum modulo 2**64.

    hash(i, n) = sum of symbol[i + j] * base**j for j < n, then mixed; ``base`` is odd, so its
    powers can be divided out and equal runs agree wherever they stand.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self._up = np.ones(1, np.uint64)
        self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            n = max(n, 2 * len(self._up))
            up, down = np.full(n, self.base, np.uint64), np.full(n, self.inverse, np.uint64)
            up[0] = down[0] = 1
            self._up, self._down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self._up, self._down

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        up, _ = self._powers(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[: len(symbols)], out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Mixed hashes of the runs [start, stop)."""
        _, down = self._powers(len(prefix))
        return mix((prefix[stop] - prefix[start]) * down[start])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, raw(batch)
