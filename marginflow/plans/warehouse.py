"""Warehouse build (ETL) and the warehouse-backed commerce model the marts read.

The build runs once per session and data directory:

1. orders joined with their aggregated lines are written to the shared scratch folder -
   ``lineitem``, the largest input, is scanned and shuffled exactly once, and the
   written table cuts the lineage, so a lost executor never sends a mart back to
   ``lineitem``; each customer's first order, last date and count are added up from it once;
   the order rows (customer attributes, first-order flag, line totals) are joined once, dealt
   to the buckets of ``order_id`` and written too.  Amounts follow from a row and are not shuffled;
2. the six commerce tables are projections of these rows (customers are the first-order
   rows; prospects join them to the customer attributes) and are written as Parquet with
   their column comments (dimensions first).  The two facts keyed by ``order_id`` are written in
   its buckets, each sorted once: their joins, and the check of their keys, need no shuffle.  The checks of single rows (nulls, domains,
   ranges) and the totals that marts must reconcile with are observed while a table is written;
3. keys are checked before any mart may read them: a duplicate stops the build, so marts
   count rows where they mean keys;
4. what each prospect did (orders, revenue, margin, arm) is added up once and written; channel
   and experiment marts roll it up.

Marts then read the written tables (narrow, column-pruned scans of order-level data).
The build is memoised per session, data directory and state of the input files, so changed
inputs are built anew (``refresh=True`` always rebuilds).  Storage is the folder named by
``spark.checkpoint.dir`` (shared on a cluster); only a local master may do without.
"""

from __future__ import annotations

import hashlib
import re
import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import marts, quality
from ..session import scratch_dir
from ..sources import csv
from ..sources.adapter import CommerceModel, order_key_id
from ..sources.tables import input_state
from . import versions

OUTCOMES = "agg_prospect_outcomes"
INPUTS = ("customer", "nation", "orders", "lineitem", "events")

# Facts stored in buckets of their key, all with one number of buckets.
BUCKETED = {"fct_orders": "order_id", "fct_deliveries": "order_id"}
ROWS_PER_BUCKET, LEAST_ROWS, MOST_BUCKETS = 2_000_000, 20_000, 100_000  # about 200 MB a bucket; Spark's own limit

_LOCK = threading.Lock()
_BUILT: dict[tuple, "WarehouseModel"] = {}


def buckets_for(rows: int, partitions: int) -> int:
    """Buckets of a fact: as many as its size asks for, and enough to keep small clusters busy."""
    wanted = max(-(-rows // ROWS_PER_BUCKET), min(partitions, -(-rows // LEAST_ROWS)), 1)
    return min(wanted, MOST_BUCKETS)


def _registered(path: str) -> str:
    return "marginflow_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` in buckets of ``key``, sorted by it."""
    (df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key).sortBy(key).option("path", path)
     .mode("overwrite").saveAsTable(_registered(path)))


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A bucketed table by its path; told to the session's catalog where it isn't yet."""
    name = _registered(path)
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


@dataclass
class WarehouseModel:
    """Commerce tables read from a built warehouse; same attributes as ``CommerceModel``."""

    spark: SparkSession
    paths: dict[str, str]
    root: str = ""
    buckets: int = 1
    # Per table, what was observed while it was written: check or total -> value.
    observed: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self):
        self._relations: dict[str, DataFrame] = {}
        self._written: dict[str, str] = {}

    def extract(self, name: str) -> str:
        """Folder of a table's CSV extract, written once for this build: columns in reverse
        order and one more, so that only a load by name reads it right."""
        path = f"{self.root}/extracts/{name}"
        if path not in self._written:
            df = self.table(name)
            csv.write_csv_extract(df.select(F.lit("x").alias("unused_extra"), *reversed(df.columns)), path)
            self._written[path] = path
        return path

    def table(self, name: str) -> DataFrame:
        """The written table (relation resolved once; each query reads the files itself)."""
        if name not in self._relations:
            cols = [f.name for f in schemas.TABLES[name].fields]
            df = (read_bucketed(self.spark, self.paths[name], BUCKETED[name], self.buckets) if name in BUCKETED
                  else self.spark.read.parquet(self.paths[name]))
            self._relations[name] = df.select(*cols)
        return self._relations[name]

    @property
    def prospects(self) -> DataFrame:
        return self.table("dim_prospect")

    @property
    def customers(self) -> DataFrame:
        return self.table("dim_customer")

    @property
    def orders(self) -> DataFrame:
        return self.table("fct_orders")

    @property
    def deliveries(self) -> DataFrame:
        return self.table("fct_deliveries")

    @property
    def experiment_assignments(self) -> DataFrame:
        return self.table("fct_experiment_assignments")

    @property
    def marketing_spend(self) -> DataFrame:
        return self.table("fct_marketing_spend")

    @property
    def prospect_outcomes(self) -> DataFrame:
        """What each prospect did, added up once in the build."""
        return self.spark.read.parquet(self.paths[OUTCOMES])


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _slug(data_dir: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "_", data_dir.strip("/"))[-60:]


def build_warehouse(spark: SparkSession, data_dir: str, out_dir: str | None = None,
                    check_keys: bool = True) -> WarehouseModel:
    """Run the ETL for ``data_dir`` and return the model over the written tables."""
    root = out_dir or f"{scratch_dir(spark)}/warehouse/{_slug(data_dir)}-{uuid.uuid4().hex[:12]}"
    lazy = CommerceModel(spark, data_dir)
    # Stage 1: the single pass over lineitem (aggregated per order, joined to orders).
    totals_path = f"{root}/_stage/order_totals"
    totals = _staged(lazy.order_totals, totals_path)
    summed = CommerceModel(spark, data_dir, staged_order_totals=totals)
    # Stage 2: the summary of each customer's orders, read for hot customers as for the join.
    customers = _staged(summed.customer_orders, f"{root}/_stage/customer_orders")
    windowed = CommerceModel(spark, data_dir, staged_order_totals=totals, staged_customer_orders=customers)
    # Stage 3: customer attributes and first-order flag, joined once; each task has the rows of one bucket.
    buckets = buckets_for(totals.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Sorted by the key as a number, which is fast, they are already in the order of the written facts.
    dealt = windowed._order_rows.repartition(buckets, order_key_id(F.col("o_orderkey"))).sortWithinPartitions("o_orderkey")
    rows = _staged(dealt, f"{root}/_stage/order_rows")
    staged = CommerceModel(spark, data_dir, staged_order_rows=rows)
    paths, observed = {}, {}
    for name in schemas.LOAD_ORDER:  # dimensions before facts
        paths[name] = f"{root}/{name}"
        seen = Observation()
        df = schemas.with_comments(staged.table(name), name).observe(seen, *quality.observations(name))
        if name in BUCKETED:
            write_bucketed(df, paths[name], BUCKETED[name], buckets)
        else:
            df.write.mode("overwrite").parquet(paths[name])
        observed[name] = {k: str(v) if v is not None else None for k, v in seen.get.items()}
    built = WarehouseModel(spark, paths, root, buckets, observed)
    if check_keys:
        quality.assert_quality(quality.unique_keys_apart({name: built.table(name) for name in schemas.TABLES}))
    paths[OUTCOMES] = f"{root}/{OUTCOMES}"
    outcomes = marts.prospect_outcomes(built.prospects, built.orders, built.experiment_assignments)
    schemas.with_comments(outcomes, OUTCOMES).write.mode("overwrite").parquet(paths[OUTCOMES])
    return built


def open_warehouse(spark: SparkSession, out_dir: str) -> WarehouseModel:
    """The warehouse of the current version below ``out_dir`` (see ``versions``)."""
    manifest = versions.current(spark, out_dir)
    if manifest is None:
        raise FileNotFoundError(f"{out_dir} has no current version")
    paths = {name: f"{out_dir}/{path}" for name, path in manifest["tables"].items()}
    return WarehouseModel(spark, paths, f"{out_dir}/{manifest['folder']}", manifest["buckets"], manifest["observed"])


def warehouse(spark: SparkSession, data_dir: str, refresh: bool = False) -> WarehouseModel:
    """The warehouse of ``data_dir`` for this session, built on first use."""
    state = tuple(input_state(spark, f"{data_dir.rstrip('/')}/{t}.parquet") for t in INPUTS)
    key = (id(spark), spark.sparkContext.applicationId, data_dir.rstrip("/"), hash(state))
    with _LOCK:
        if refresh or key not in _BUILT:
            _BUILT[key] = build_warehouse(spark, data_dir)
        return _BUILT[key]
