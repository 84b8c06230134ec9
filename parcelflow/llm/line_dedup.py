"""Removing lines that many documents share, by a sharded minimal perfect hash over line hashes.

1. Every document's lines are hashed (128 bits); documents holding each hash are counted, combined per
   batch and per task before the shuffle.
2. The hashes held by enough documents are dealt to shards. Each shard becomes one row: a minimal perfect
   hash and, by its slots, arrays of fingerprints, counts and the document that keeps the line.
3. Documents send the hashes of their lines to the shards, packed in binary rows, and the shards answer
   which of them the document must drop. No line is joined with another.
4. The answers meet their documents, which leave out the lines.

A line that very many documents hold sends as many questions to its shard. A shard therefore has as many
copies as its questions need, and each batch of documents asks one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from parcelflow.llm.perfect_hash import PerfectHash
from parcelflow.llm.shared import ASCII_SPACE, map_batches, written
from parcelflow.llm.tokens import blocks

#: Aimed at in a shard: distinct hashes indexed, and hashes asked of each copy of it.
KEYS_PER_SHARD, PROBES_PER_SHARD = 200_000, 500_000

NO_DOCUMENT = np.iinfo(np.int64).min


@dataclass
class Lines:
    """The lines of a block of texts; ``row`` is the text of each line that can be dropped."""

    lines: pa.Array
    counts: np.ndarray
    at: np.ndarray  # places of the lines that are long enough
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray


def split(texts: pa.Array, min_chars: int) -> Lines:
    """Lines of each text, and the hashes of the keys of those with at least ``min_chars`` in their key."""
    cut = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    counts = np.diff(cut.offsets.to_numpy()).astype(np.int64)
    lines = cut.flatten()
    keys = pc.ascii_lower(pc.utf8_trim(lines, ASCII_SPACE))
    long_enough = pc.greater_equal(pc.utf8_length(keys), min_chars)
    at = np.flatnonzero(long_enough.to_numpy(zero_copy_only=False))
    hashed = keys.filter(long_enough).cast(pa.binary()).to_pylist()
    both = np.frombuffer(b"".join(map(xxh3_128_digest, hashed)), "<u8").reshape(-1, 2)
    return Lines(lines, counts, at, np.repeat(np.arange(len(counts)), counts)[at], both[:, 0], both[:, 1])


def distinct_per_row(found: Lines) -> np.ndarray:
    """Places (in the hashes) of one line for each hash of each row."""
    order = np.lexsort((found.high, found.low, found.row))
    same = np.zeros(len(order), bool)
    a, b = order[1:], order[:-1]
    same[1:] = (found.row[a] == found.row[b]) & (found.low[a] == found.low[b]) & (found.high[a] == found.high[b])
    return order[~same]


def document_ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NO_DOCUMENT).to_numpy(zero_copy_only=False)


def line_counts(docs: DataFrame, min_chars: int) -> DataFrame:
    """low, high (the hash of a line), n (documents holding it) and keeper (the largest doc_id of these)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = split(block.column(1), min_chars)
            own = distinct_per_row(found)
            low, high = found.low[own], found.high[own]
            ids = document_ids(block.column(0))[found.row[own]]
            order = np.lexsort((ids, high, low))
            low, high, ids = low[order], high[order], ids[order]
            last = np.ones(len(low), bool)
            last[:-1] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            ends = np.flatnonzero(last)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(low[ends].view(np.int64)),
                    pa.array(high[ends].view(np.int64)),
                    pa.array(np.diff(ends, prepend=-1)),
                    pa.array(ids[ends]),
                ],
                ["low", "high", "n", "keeper"],
            )

    parts = map_batches(docs, work, "low bigint, high bigint, n bigint, keeper bigint")
    return parts.groupBy("low", "high").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))


def build_index(repeated: DataFrame, shards: int) -> DataFrame:
    """One row per shard: hash (a serialised PerfectHash), and fingerprints, counts and keepers by slot."""

    def build(part: pa.Table) -> pa.Table:
        low = part["low"].to_numpy().view(np.uint64)
        perfect = PerfectHash.build(low)
        slot = perfect.slots(low)
        arrays = {}
        for name, kind in (("high", "<i8"), ("n", "<i8"), ("keeper", "<i8")):
            by_slot = np.empty(len(low), kind)
            by_slot[slot] = part[name].to_numpy()
            arrays[name] = by_slot.tobytes()
        shard = int(low[0] % np.uint64(shards))
        return pa.table(
            {
                "shard": pa.array([shard], pa.int64()),
                "hash": pa.array([perfect.to_bytes()], pa.binary()),
                "fingerprints": pa.array([arrays["high"]], pa.binary()),
                "counts": pa.array([arrays["n"]], pa.binary()),
                "keepers": pa.array([arrays["keeper"]], pa.binary()),
            }
        )

    # one key per low half; a clash (2**-64 for a given pair) keeps the more frequent hash
    one = repeated.groupBy("low").agg(F.max(F.struct("n", "high", "keeper")).alias("_r"))
    rows = one.select("low", "_r.high", "_r.n", "_r.keeper", unsigned_modulo("low", shards).alias("shard"))
    return rows.groupBy("shard").applyInArrow(
        build, "shard bigint, hash binary, fingerprints binary, counts binary, keepers binary"
    )


def unsigned_modulo(column: str, n: int):
    """column mod n with the column's 64 bits read as unsigned."""
    high = F.shiftrightunsigned(column, 1) % n
    return (high * 2 + F.col(column).bitwiseAND(1)) % n


def copies_of_shards(repeated: DataFrame, shards: int, pairs: int) -> np.ndarray:
    """How many copies each shard has: one for every PROBES_PER_SHARD documents that hold one of its hashes."""
    held = repeated.groupBy(unsigned_modulo("low", shards).alias("shard")).agg(F.sum("n").alias("n")).collect()  # a row for each shard
    asked = np.full(shards, pairs // shards, np.int64)  # hashes that are not indexed spread evenly
    for r in held:
        asked[r["shard"]] += r["n"]
    return 1 + asked // PROBES_PER_SHARD


def probes(docs: DataFrame, min_chars: int, copies: np.ndarray) -> DataFrame:
    """What documents ask: per batch and shard one row of doc ids and hashes, packed, for one of the shard's copies."""
    shards = len(copies)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for block in blocks(batches):
            found = split(block.column(1), min_chars)
            own = distinct_per_row(found)
            low, high = found.low[own], found.high[own]
            shard = (low % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            packed = np.column_stack(
                [document_ids(block.column(0))[found.row[own]].view(np.uint64), low, high]
            )[order].astype("<u8")
            present, starts = np.unique(shard[order], return_index=True)
            ends = [*starts[1:].tolist(), len(packed)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(present, pa.int64()),
                    pa.array(turn % copies[present], pa.int64()),
                    pa.array([packed[s:e].tobytes() for s, e in zip(starts.tolist(), ends)], pa.binary()),
                ],
                ["shard", "copy", "asked"],
            )
            turn += 1

    return map_batches(docs, work, "shard bigint, copy bigint, asked binary")


def answers(asked: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id and drop: hashes (packed pairs) whose lines the document loses."""

    def probe(questions: pa.Table, shard: pa.Table) -> pa.Table:
        ids, hits = [], []
        if shard.num_rows and questions.num_rows:
            perfect = PerfectHash.from_bytes(shard["hash"][0].as_py())
            fingerprints = np.frombuffer(shard["fingerprints"][0].as_py(), "<u8")
            keepers = np.frombuffer(shard["keepers"][0].as_py(), "<i8")
            for packed in questions["asked"].to_pylist():
                rows = np.frombuffer(packed, "<u8").reshape(-1, 3)
                slot = perfect.slots(rows[:, 1])
                known = slot >= 0
                known[known] = fingerprints[slot[known]] == rows[known, 2]
                known[known] = keepers[slot[known]] != rows[known, 0].view(np.int64)
                rows = rows[known]
                rows = rows[np.argsort(rows[:, 0], kind="stable")]
                own, starts = np.unique(rows[:, 0], return_index=True)
                ends = [*starts[1:].tolist(), len(rows)]
                ids += own.view(np.int64).tolist()
                hits += [rows[s:e, 1:].tobytes() for s, e in zip(starts.tolist(), ends)]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "drop": pa.array(hits, pa.binary())})

    at = ["shard", "copy"]
    return asked.groupBy(*at).cogroup(index.groupBy(*at)).applyInArrow(probe, "doc_id bigint, drop binary")


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Texts without the lines that at least ``min_docs`` documents hold, except in the largest doc_id.

    Returns doc_id, n_lines (before), n_dropped, kept (the lines left, joined by line breaks), one row per
    input row. Lines are compared by their key: ASCII white space stripped at both ends, A-Z in lower
    case; keys shorter than ``min_chars`` code points always stay. A null or empty text is one empty line.
    Rows that share a doc_id each count as a document holding the line, and if theirs is the largest
    doc_id all keep it; rows with a null doc_id rank below all others. An empty table gives no rows.
    Whole texts count, however long. doc_id is an integer column. The input's columns named in ``keep`` pass as ``kept_columns``, a struct; others do not.
    """
    inner = [f"_{i}" for i in range(len(keep or []))]
    types = [docs.schema[c].dataType.simpleString() for c in keep or []]
    whole = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *[F.col(c).alias(n) for c, n in zip(keep or [], inner)],
    )
    own = whole.select("doc_id", "text")
    counted = written(line_counts(own, min_chars), "line-counts")
    sums = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.count(F.when(F.col("n") >= min_docs, 1)).alias("keys")
    ).first()
    repeated = counted.filter(F.col("n") >= min_docs)
    shards = 1 + max(sums["keys"] // KEYS_PER_SHARD, sums["pairs"] // PROBES_PER_SHARD)
    copies = copies_of_shards(repeated, shards, sums["pairs"])
    # a small row for each busy shard
    busy = [(int(s), int(copies[s])) for s in np.flatnonzero(copies > 1)]
    numbers = docs.sparkSession.createDataFrame(busy, "shard bigint, copies bigint")
    last = F.coalesce("copies", F.lit(1)).cast("bigint") - 1
    index = build_index(repeated, shards).join(numbers, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("copies")
    replies = answers(probes(own, min_chars, copies), index)
    per_doc = replies.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list("drop").alias("_drop"))
    asked = F.coalesce(whole["doc_id"], F.lit(int(NO_DOCUMENT)))
    met = whole.join(per_doc.hint("shuffle_hash"), asked == per_doc["_doc"], "left").select("doc_id", "text", "_drop", *inner)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = split(block.column(1), min_chars)
            dropped = np.zeros(len(found.lines), bool)
            told = [b"".join(d or []) for d in block.column(2).to_pylist()]
            pairs = np.frombuffer(b"".join(told), "<u8").reshape(-1, 2)
            row = np.repeat(np.arange(len(told)), [len(t) // 16 for t in told])
            listed = set(zip(row.tolist(), pairs[:, 0].tolist(), pairs[:, 1].tolist()))
            for i in np.flatnonzero(np.isin(found.low, pairs[:, 0])).tolist():
                if (int(found.row[i]), int(found.low[i]), int(found.high[i])) in listed:
                    dropped[found.at[i]] = True
            before = np.concatenate([[0], np.cumsum(found.counts)])
            gone = np.concatenate([[0], np.cumsum(dropped)])[before]
            left = found.lines.filter(pa.array(~dropped))
            bounds = (before - gone).astype(np.int32)
            kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), left), "\n")
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(found.counts), pa.array(np.diff(gone)), kept, *block.columns[3:]],
                ["doc_id", "n_lines", "n_dropped", "kept", *inner],
            )

    passed = "".join(f", {n} {t}" for n, t in zip(inner, types))
    result = map_batches(met, work, "doc_id bigint, n_lines bigint, n_dropped bigint, kept string" + passed)
    if not keep:
        return result
    columns = F.struct(*[F.col(n).alias(c) for n, c in zip(inner, keep)])
    return result.select("doc_id", "n_lines", "n_dropped", "kept", columns.alias("kept_columns"))
