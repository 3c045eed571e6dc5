"""Parquet access to the driver tables with explicit column lists (pruned at the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RELATIONS: dict[tuple, tuple[tuple, DataFrame]] = {}


def input_state(spark: SparkSession, path: str) -> tuple:
    """(file, length, modification time) of every file of a table; listed by Spark's file system."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<data_dir>/<name>.parquet``; selecting columns here keeps ReadSchema narrow.

    The relation (file listing and footer schema) is resolved once per session, path and state of
    the files and reused by every query that reads the table; the data is read by each query.
    """
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    key, state = (id(spark), spark.sparkContext.applicationId, path), input_state(spark, path)
    if key not in _RELATIONS or _RELATIONS[key][0] != state:
        _RELATIONS[key] = (state, spark.read.parquet(path))
    df = _RELATIONS[key][1]
    return df.select(*columns) if columns else df
