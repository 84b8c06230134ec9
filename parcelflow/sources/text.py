"""CSV ingest under a declared schema, and reconciliation of loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelflow.functions.rows import content_sum, row_hash
from parcelflow.model import Contract
from parcelflow.operators.verdicts import typed
from parcelflow.plans.together import together

#: Parts of the key space that are compared as wholes.
BUCKETS = 4_096


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a folder (or one file) by their header: names trimmed and in lower case, in file order.

    The driver reads the first line of each file. Files without a line are left out; a name that a header has
    twice is an error.
    """
    # the files are listed, not read
    files = sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect())

    def header(file: str) -> tuple[str, ...]:
        first = spark.read.option("header", False).csv(file).limit(1).collect()
        return tuple((name or "").strip().lower() for name in first[0]) if first else ()

    found: dict[tuple[str, ...], list[str]] = {}
    for file, names in together(spark, {f: lambda f=f: header(f) for f in files}).items():
        if len(set(names)) < len(names):
            raise ValueError(f"{file} has a column twice: {', '.join(names)}")
        if names:
            found.setdefault(names, []).append(file)
    return found


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, header names trimmed and in lower case.

    Files may have their columns in different order and number: those with the same header are read together, and
    columns meet by name. Quoted line breaks need ``multi_line``, which makes a file one task.
    """
    parts = []
    for names, files in headers(spark, path).items():
        schema = StructType([StructField(name, StringType()) for name in names])
        parts.append(spark.read.schema(schema).option("header", True).option("multiLine", multi_line).csv(files))
    if not parts:
        raise ValueError(f"no file with a header in {path}")
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def read_typed_csv(spark: SparkSession, path: str, contract: Contract, multi_line: bool = False) -> DataFrame:
    """The contract's columns in its types, and ``_bad`` for values that do not convert."""
    return typed(read_csv(spark, path, multi_line), contract).drop("_lacks")


def load_csv(spark: SparkSession, path: str, contract: Contract, target: str, multi_line: bool = False) -> int:
    """Write the typed rows of CSV files as Parquet; returns how many there were, counted on the way."""
    seen = Observation()
    rows = read_typed_csv(spark, path, contract, multi_line)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    return seen.get["n"]


def reconcile(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Rows per table on both sides (table_name, rows) and their difference."""
    source = source_counts.select("table_name", F.col("rows").alias("source_rows"))
    target = target_counts.select("table_name", F.col("rows").alias("target_rows"))
    both = source.join(target, "table_name", "full").fillna(0, ["source_rows", "target_rows"])
    return both.select(
        "table_name", "source_rows", "target_rows", (F.col("source_rows") - F.col("target_rows")).alias("difference")
    )


def reconcile_content(source: DataFrame, target: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ: the key, difference (MISSING, EXTRA or CHANGED), source_rows, target_rows.

    Both sides are first summed up per bucket of keys by number and order-free hash sum, in one pass each. Only the keys
    of buckets that differ are compared one by one, so equal tables cost no shuffle of their rows. The target's
    columns are taken in the types of the source; other columns are an error. A key may have several rows, in any order;
    null is a key like any other.
    """
    if set(source.columns) != set(target.columns):
        raise ValueError(f"columns differ: {', '.join(sorted(set(source.columns) ^ set(target.columns)))}")
    kinds = dict(source.dtypes)
    target = target.select(*[F.col(c).cast(kinds[c]).alias(c) for c in source.columns])
    bucket = F.pmod(row_hash([key]), F.lit(buckets))

    def summed(rows: DataFrame, by: str, side: str) -> DataFrame:
        return rows.groupBy(by).agg(F.count(F.lit(1)).alias(f"{side}_rows"), content_sum(source.columns).alias(f"_{side}"))

    def compared(one: DataFrame, other: DataFrame, by: str) -> DataFrame:
        s, t = summed(one, by, "source"), summed(other, by, "target").withColumnRenamed(by, "_other")
        both = s.join(t, F.col(by).eqNullSafe(F.col("_other")), "full")
        differ = ~F.struct("source_rows", "_source").eqNullSafe(F.struct("target_rows", "_target"))
        return both.filter(differ).withColumn(by, F.coalesce(by, "_other"))

    parts = compared(source.withColumn("_bucket", bucket), target.withColumn("_bucket", bucket), "_bucket")
    # at most as many numbers as there are buckets
    wanted = [r["_bucket"] for r in parts.select("_bucket").collect()]
    inside = bucket.isin(wanted) if wanted else F.lit(False)
    found = compared(source.filter(inside), target.filter(inside), key)
    difference = F.when(F.col("target_rows").isNull(), "MISSING").when(F.col("source_rows").isNull(), "EXTRA").otherwise("CHANGED")
    return found.select(
        key, difference.alias("difference"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("source_rows", "target_rows")]
    )
