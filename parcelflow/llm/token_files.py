"""Token ids as Parquet files for training: list columns, small row groups and pages, in document order.

Documents are range-partitioned and sorted by id, tokenised where they lie, and written by Spark. Ids are
dictionary- or delta-encoded lists. Each row also has its file part, the number of ids before it in the
part and its own number, so that metadata can be read without ids; the page index lets a reader with
a filter on doc_id skip row groups and pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelflow.llm.shared import map_batches
from parcelflow.llm.tokens import blocks, encoder

ROW_GROUP_BYTES = 32 * 2**20
PAGE_ROWS = 1_000
#: Texts of a block, in bytes: the larger, the more seldom the worker looks through the pieces that it remembers.
BLOCK_BYTES = 4_000_000


def write_tokens(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = 2,
    encoding: str = "dictionary",
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the ids of every whole text, each document ending with ``end_id``, in ascending doc_id order.

    Rows: doc_id, part, part_start (ids of this part before the document), n_tokens, ids (array<int>).
    ``encoding`` is "dictionary" or "delta". A null or empty text is its end id alone; a null doc_id
    sorts first; rows with equal doc_id are written in the order of their texts; an empty table gives
    files without rows; other columns of the input do not pass.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding}")
    kind = dict(docs.dtypes)[doc_id]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, byte_level=False).encode
        part, before = TaskContext.get().partitionId(), 0
        for block in blocks(batches, size_limit=BLOCK_BYTES):
            ids, bounds = encode(block.column(1))
            ids = np.insert(ids, bounds[1:], end_id).astype(np.int32)
            bounds = bounds + np.arange(len(bounds))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array(np.full(block.num_rows, part, np.int32)),
                    pa.array(before + bounds[:-1]),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                ],
                ["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            before += int(bounds[-1])

    ordered = docs.select(doc_id, text).repartitionByRange(doc_id).sortWithinPartitions(doc_id, text)
    rows = map_batches(ordered, work, f"doc_id {kind}, part int, part_start bigint, n_tokens bigint, ids array<int>")
    options = {
        "compression": "zstd",
        "parquet.block.size": str(ROW_GROUP_BYTES),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0",
    }
    rows.write.options(**options).parquet(folder)


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens; the ids are not read."""
    rows = spark.read.parquet(folder).select("doc_id", "part", "part_start", "n_tokens")
    return with_starts(rows, rows)


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id and ids of the given documents (all by default); pages without them are skipped."""
    rows = spark.read.parquet(folder).select("doc_id", "ids")
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def with_starts(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Replace part and part_start by ``start``, from the sizes of the parts before (one row per part)."""
    sizes = stored.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_size"))
    bases = sizes.selectExpr(
        "_part", "coalesce(sum(_size) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _base"
    )
    return rows.join(bases, F.col("part") == F.col("_part")).select(
        "doc_id",
        (F.col("_base") + F.col("part_start")).alias("start"),
        *[c for c in rows.columns if c not in ("doc_id", "part", "part_start")],
    )


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit), read from the files."""
    stored = spark.read.parquet(folder)
    kind = dict(stored.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
            crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column(c) for c in ("doc_id", "part", "part_start")]
            sizes = pa.array(np.diff(bounds).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*columns, sizes, pa.array(crc, pa.int64())], ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"]
            )

    rows = map_batches(
        stored.select("doc_id", "part", "part_start", "ids"),
        work,
        f"doc_id {kind}, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return with_starts(rows, stored)
