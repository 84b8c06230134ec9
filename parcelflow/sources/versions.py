"""Versions of the tables of a run: written beside the earlier ones, and seen by readers once published.

A run writes its tables below a folder of its own version. Publishing adds one small file to the manifest: a row for
each table with its folder and schema. Readers go by the newest version in the manifest, so they see all tables of
one run or all of the run before, never some of each; a run that stops before it publishes changes nothing for them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from parcelflow.sources.layers import read_table

MANIFEST_SCHEMA = (
    "version bigint, batch_id string, layer string, table_name string, folder string, columns string, "
    "batches array<string>, published_at timestamp"
)


class UnknownVersion(LookupError):
    """No such version has been published."""


@dataclass(frozen=True)
class Entry:
    """A published table: its folder below the root, its schema as JSON, the batches whose rows it holds."""

    version: int
    batch_id: str
    layer: str
    table_name: str
    folder: str
    columns: str
    batches: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.columns))


def folder_of(version: int, layer: str, table: str) -> str:
    """Where a version's table lies, below the root."""
    return f"versions/{version}/{layer}/{table}"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All published tables of all versions; no rows before the first."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def newest(spark: SparkSession, root: str) -> int:
    """The newest published version; 0 before the first."""
    return manifest(spark, root).agg(F.max("version").alias("v")).first()["v"] or 0


def entries(spark: SparkSession, root: str, version: int | None = None) -> dict[tuple[str, str], Entry]:
    """The tables of a version (the newest by default) by layer and name; none before the first."""
    listed = manifest(spark, root)
    if version is None:
        listed = listed.join(F.broadcast(listed.agg(F.max("version").alias("version"))), "version")
    else:
        listed = listed.filter(F.col("version") == version)
    # one row for each table
    rows = listed.drop("published_at").collect()
    if version is not None and not rows:
        raise UnknownVersion(f"version {version} of {root} has not been published")
    found = [Entry(**{**r.asDict(), "batches": tuple(r["batches"])}) for r in rows]
    return {(e.layer, e.table_name): e for e in found}


def read(spark: SparkSession, root: str, entry: Entry) -> DataFrame:
    return read_table(spark, f"{root}/{entry.folder}", entry.schema)


def tables(spark: SparkSession, root: str, layer: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a layer in a version (the newest by default)."""
    return {t: read(spark, root, e) for (in_layer, t), e in entries(spark, root, version).items() if in_layer == layer}


def publish(
    spark: SparkSession,
    root: str,
    version: int,
    batch_id: str,
    written: dict[tuple[str, str], StructType],
    batches: dict[str, list[str]],
    published_at: datetime,
    kept: dict[tuple[str, str], str] | None = None,
) -> None:
    """Make a version the newest one, by a single file; a version that is already published is refused by Spark's writer.

    ``written`` has the schema of each table by layer and name, all below the version's folder save those whose folder
    ``kept`` tells, which earlier versions have written; ``batches`` tells of a table of any layer which batches it holds.
    """
    folders = {(layer, table): folder_of(version, layer, table) for layer, table in written} | (kept or {})
    rows = [
        (version, batch_id, layer, table, folders[layer, table], schema.json(), sorted(batches.get(table, [])), published_at)
        for (layer, table), schema in written.items()
    ]
    target = f"{root}/manifest/version={version}"
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(target)
