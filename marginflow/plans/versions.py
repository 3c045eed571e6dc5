"""Versioned publishing of a rebuild.

A rebuild writes into a fresh folder below ``<out>/versions`` and ends by creating one manifest,
``<out>/manifests/<number>.json``, at once and whole.  Readers resolve the manifest of the greatest
number, so they see all tables of one rebuild or all of the one before, whatever happened in between: a
stopped run leaves a folder that nothing refers to.  Of two rebuilds at a time each gets a number.
Paths in a manifest are relative to ``<out>``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..sources import files


def fresh_folder(out_dir: str) -> str:
    """Relative name of a version folder that no other run uses."""
    return f"versions/{uuid.uuid4().hex[:16]}"


def _numbers(spark: SparkSession, out_dir: str) -> list[int]:
    found = [n.removesuffix(".json") for n in files.names(spark, f"{out_dir}/manifests") if n.endswith(".json")]
    return sorted(int(n) for n in found if n.isdigit())


def _manifest(spark: SparkSession, out_dir: str, number: int) -> dict:
    return json.loads(files.read_text(spark, f"{out_dir}/manifests/{number:012d}.json"))


def publish(spark: SparkSession, out_dir: str, manifest: dict) -> int:
    """Make ``manifest`` the current one; its number."""
    while True:
        number = max(_numbers(spark, out_dir), default=0) + 1
        if files.create_text(spark, f"{out_dir}/manifests/{number:012d}.json", json.dumps(manifest, indent=1)):
            return number


def current(spark: SparkSession, out_dir: str) -> dict | None:
    """The manifest that readers resolve; None before the first rebuild has ended."""
    numbers = _numbers(spark, out_dir)
    return _manifest(spark, out_dir, numbers[-1]) if numbers else None


def read_mart(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A mart of the current version."""
    manifest = current(spark, out_dir)
    if manifest is None or name not in manifest["marts"]:
        raise KeyError(f"{out_dir} has no current version with a mart {name}")
    return spark.read.parquet(f"{out_dir}/{manifest['marts'][name]}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_tables(spark: SparkSession, out_dir: str, prefix: str = "") -> list[str]:
    """Catalog tables over the current version's tables and marts, with the registry's comments on
    tables and columns; tables of an earlier version by these names are replaced."""
    manifest = current(spark, out_dir)
    if manifest is None:
        raise KeyError(f"{out_dir} has no current version")
    made = []
    for name, path in {**manifest["tables"], **manifest["marts"]}.items():
        schema = spark.read.parquet(f"{out_dir}/{path}").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT {_text(schemas.COLUMN_DOCS.get(f.name, ''))}"
                            for f in schema)
        spark.sql(f"DROP TABLE IF EXISTS `{prefix}{name}`")
        spark.sql(f"CREATE TABLE `{prefix}{name}` ({columns}) USING parquet "
                  f"COMMENT {_text(schemas.MODEL_DOCS.get(name, ''))} LOCATION {_text(f'{out_dir}/{path}')}")
        made.append(prefix + name)
    return made


def expire(spark: SparkSession, out_dir: str, keep: int = 2) -> list[int]:
    """Delete all published versions but the last ``keep`` (one at least); the numbers that went.

    A manifest goes before its folder, so that no reader resolves a version that is half gone.
    """
    gone = _numbers(spark, out_dir)[:-max(1, keep)]
    for number in gone:
        folder = _manifest(spark, out_dir, number)["folder"]
        files.delete(spark, f"{out_dir}/manifests/{number:012d}.json")
        files.delete(spark, f"{out_dir}/{folder}")
    return gone
