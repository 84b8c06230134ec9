"""Reading and writing the layers as Parquet folders.

Parquet folders have no transactions, so the writers are built to be repeated:
a full overwrite replaces a table, and a batch of a history table is a folder of
its own that a re-run replaces, also when it has become empty.
"""

from __future__ import annotations

import re
import tempfile
from functools import reduce
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from parcelflow.plans.together import together


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, below the cluster's shared checkpoint folder.

    Only a session on this one machine may do without that setting; it then gets a local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix=f'{name}-')}/{name}"


INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
INSTANTS = ["date", "timestamp_ntz", "timestamp"]


def common_type(kinds: set[str]) -> str:
    """The narrowest type that holds the values of all given ones; text where there is no other."""
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= INTEGERS.keys():
        return max(kinds, key=INTEGERS.__getitem__)
    decimals = [tuple(map(int, re.findall(r"\d+", k))) for k in kinds if k.startswith("decimal")]
    if decimals and all(k in INTEGERS or k.startswith("decimal") for k in kinds):
        whole = max([p - s for p, s in decimals] + [INTEGERS[k] for k in kinds & INTEGERS.keys()])
        scale = max(s for _, s in decimals)
        return f"decimal({min(38, whole + scale)},{min(scale, 38 - min(38, whole))})"
    if all(k in INTEGERS or k.startswith("decimal") or k in ("float", "double") for k in kinds):
        return "double"
    if kinds <= set(INSTANTS):
        return max(kinds, key=INSTANTS.index)
    return "string"


def scan_evolved(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The rows of several written folders whose columns differ in number or type.

    Folders of one schema are read together, under it. A column has the common type of all folders, and is null
    in those that lack it. The driver reads the schema of each folder, from one file.
    """
    schemas = together(spark, {f: lambda f=f: spark.read.option("recursiveFileLookup", True).parquet(f).schema for f in folders})
    alike: dict[str, list[str]] = {}
    for folder, schema in schemas.items():
        alike.setdefault(schema.json(), []).append(folder)
    kinds: dict[str, set[str]] = {}
    for schema in schemas.values():
        for field in schema:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    types = {name: common_type(found) for name, found in kinds.items()}
    parts = []
    for group in alike.values():
        rows = spark.read.schema(schemas[group[0]]).option("recursiveFileLookup", True).parquet(*group)
        parts.append(rows.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in rows.columns]))
    found = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    return found.select(*[f"`{c}`" for c in types])


def scan_layer(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder; folder names do not become columns. Columns may be added or widened over time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    # only the names of the files are listed; one row for each folder
    folders = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).distinct().collect()
    return scan_evolved(spark, sorted(r["folder"] for r in folders) or [path])


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A written table; the schema is given, because a partitioned table without rows has no file to tell it."""
    return spark.read.schema(schema).parquet(path)


# Of the layers behind the raw one; much of them are ids and hashes, which the default leaves nearly as long as they are.
COMPRESSION = "zstd"


def write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the files of a folder."""
    df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by or []).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a table and read it back, so that later steps start from the written files.

    For a partitioned table rows are first rebalanced by the partition columns:
    each folder then holds few files of even size, a large one several.
    """
    write(df.hint("rebalance", *partition_by) if partition_by else df, path, partition_by)
    return read_table(df.sparkSession, path, df.schema)


def batch_folder(path: str, batch_id: str) -> str:
    return f"{path}/batch={quote(batch_id, safe='')}"


def replace_batch(df: DataFrame, path: str, batch_id: str) -> DataFrame:
    """Write one batch of a history table, replacing an earlier attempt; returns the batch as written."""
    write(df, batch_folder(path, batch_id))
    return read_batch(df.sparkSession, path, batch_id)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a history table; columns added over time are null in older batches."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path)


def read_batch(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    return spark.read.parquet(batch_folder(path, batch_id))


def register(spark: SparkSession, name: str, path: str, schema: StructType | None = None, partition_by: list[str] | None = None) -> None:
    """External table over a written folder, created if missing, moved if it lies elsewhere, and refreshed.

    A partitioned folder may be without files, so its columns are given; those of other folders can be inferred.
    """
    if spark.catalog.tableExists(name):
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
        if details["data_type"].removeprefix("file:").rstrip("/") != path.removeprefix("file:").rstrip("/"):
            spark.sql(f"DROP TABLE {name}")  # external: its files stay
    columns = f"({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)})" if schema else ""
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if schema and partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING parquet {layout} LOCATION '{path}'")
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(name))
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(f"REFRESH TABLE {name}")
