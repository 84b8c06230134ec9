"""What the corpus operators share: written intermediate tables, Arrow batches, shipping the package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelflow.sources.layers import scratch_folder

#: Characters that separate words and are stripped from lines: space and \t \n \v \f \r.
ASCII_SPACE = " \t\n\x0b\x0c\r"

_shipped: set[str] = set()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared checkpoint folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    context: SparkContext = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="parcelflow-"), "parcelflow_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers, which keep no freed memory between tasks."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return the memory that this worker has freed to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def texts_as_str(column: pa.Array) -> list[str]:
    """Each text; null counts as empty."""
    return [text or "" for text in column.to_pylist()]


def labelled_texts(docs: DataFrame, labelled: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Labelled documents as _id, label and _hash, one row for each id with the text of the least hash."""
    hashed = docs.select(F.col(doc_id).alias("_id"), text_hash(text)).groupBy("_id").agg(F.min("_hash").alias("_hash"))
    return labelled.join(hashed, "_id").select("_id", "label", "_hash")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_hash")


def sampled_texts(docs: DataFrame, sample: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of a bounded sample of ``labelled_texts`` with _text, one row each, however often documents repeat."""
    texts = docs.select(F.col(doc_id).alias("_id"), text_hash(text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(sample), ["_id", "_hash"]).groupBy(*sample.columns).agg(F.min("_text").alias("_text")).drop("_hash")


def chosen(table: DataFrame, limit: int, *order: str) -> DataFrame:
    """At most ``limit`` rows, by a hash of the given columns: the same ones on every run."""
    return table.orderBy(F.xxhash64(*order), *order).limit(limit)
