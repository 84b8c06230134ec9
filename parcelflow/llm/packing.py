"""Packing of tokenised documents into training sequences by harmonic classes.

A document's ids are cut into pieces: whole sequences first, then of the rest pieces of exactly
capacity // k ids, the largest that fit, until at most capacity // CUT_UNTIL ids are left, which stay
whole. A piece of class k = capacity // length lies in bins of exactly k pieces. Every worker fills the
bins of each class by itself as documents pass. The pieces of bins that are not full at its end, fewer
than k per class, are numbered again within ever larger groups of workers; what remains of all groups
is bounded by the capacity alone and is packed first-fit.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.shared import map_batches, written
from parcelflow.llm.tokens import TOKENISED_BYTES, blocks, encoder

#: Rests of up to capacity // CUT_UNTIL ids are not cut further.
CUT_UNTIL = 8
#: Workers whose open bins are numbered together; a power of this many at each further step.
FAN_IN = 256

PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def cut(tokens: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = -(-capacity // rest)
        piece = rest if rest <= capacity // CUT_UNTIL else capacity // k
        lengths.append(piece)
        rest -= piece
    return lengths


class Bins:
    """The bins of one worker: pieces of a class fill one bin after another."""

    def __init__(self, worker: int, capacity: int):
        self.worker, self.capacity = worker, capacity
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.closed = 0
        self.rows: list[tuple] = []

    def put(self, piece: tuple) -> None:
        """piece: doc_id, start, length, crc, doc_tokens, ids."""
        k = self.capacity // piece[2]
        own = self.open[k]
        own.append(piece)
        if len(own) == k:
            sequence, offset = (self.worker << 32) + self.closed, 0
            for p in own:
                self.rows.append((*p, sequence, offset))
                offset += p[2]
            self.closed += 1
            del self.open[k]

    def end(self) -> None:
        self.rows += [(*p, None, None) for own in self.open.values() for p in own]
        self.open.clear()


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 0,
    with_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` ids.

    Returns per piece doc_id, start (ids of its document before it), length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id, offset, and with
    ``with_ids`` the ids (array<int>). Every id lies in exactly one piece; offsets of a sequence are
    gapless from 0. A null or empty text is its end id alone; repeated rows are packed as often as they
    occur; an empty table gives no pieces; a document of any length becomes as many sequences as it
    needs; other columns of the input do not pass.
    """
    kind = dict(docs.dtypes)[doc_id]
    stored = "array<int>" if with_ids else "void"
    schema = f"doc_id {kind}, {PIECE}, worker int" + (f", ids {stored}" if with_ids else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, byte_level=True).encode
        bins = Bins(TaskContext.get().partitionId(), capacity)
        end = np.array([end_id], "<u4")
        for block in blocks(batches, size_limit=TOKENISED_BYTES):
            ids, bounds = encode(block.column(1))
            for doc, a, b in zip(block.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                own = np.concatenate([ids[a:b], end])
                start = 0
                for length in cut(len(own), capacity):
                    piece = own[start : start + length]
                    crc = zlib.crc32(piece.tobytes())
                    bins.put((doc, start, length, crc, len(own), piece if with_ids else None))
                    start += length
            yield rows(bins, block.column(0).type)
        bins.end()
        yield rows(bins, pa.int64() if kind == "bigint" else None)

    def rows(bins: Bins, id_type: pa.DataType | None) -> pa.RecordBatch:
        columns = list(zip(*bins.rows)) or [()] * 8
        doc, start, length, crc, total, ids, sequence, offset = columns
        n = len(bins.rows)
        bins.rows = []
        types = [id_type, *[pa.int64()] * 6, pa.int32()]
        values = [doc, start, length, crc, total, sequence, offset, [bins.worker] * n]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "worker"]
        if with_ids:
            values, types, names = [*values, ids], [*types, pa.list_(pa.int32())], [*names, "ids"]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    placed = written(map_batches(docs.select(doc_id, text), work, schema), "packed")
    workers = placed.agg(F.coalesce(F.max("worker"), F.lit(0)).alias("n")).first()["n"] + 1
    done, rest = [placed.filter("sequence_id IS NOT NULL")], placed.filter("sequence_id IS NULL")
    step, groups = 0, workers
    while groups > 1:
        step, groups = step + 1, -(-groups // FAN_IN)
        numbered = renumbered(rest, capacity, step)
        if groups > 1:
            numbered = written(numbered, "packed-rest")
        done.append(numbered.filter("sequence_id IS NOT NULL"))
        rest = numbered.filter("sequence_id IS NULL")
    done.append(first_fit(rest, capacity))
    columns = [c for c in placed.columns if c != "worker"]
    result = done[0].select(columns)
    for part in done[1:]:
        result = result.unionByName(part.select(columns))
    return result


def renumbered(rest: DataFrame, capacity: int, step: int) -> DataFrame:
    """Pieces of open bins put into full ones within groups of FAN_IN ** step workers."""
    group, k = f"(worker div {FAN_IN**step})", f"({capacity} div length)"
    order = f"(PARTITION BY {group}, {k} ORDER BY doc_id, start, ids_crc32)"
    in_bin = f"(PARTITION BY {group}, {k}, _bin ORDER BY doc_id, start, ids_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    base = 2**61 + step * 2**57
    return (
        rest.selectExpr("*", f"(row_number() OVER {order} - 1) div {k} AS _bin", f"count(1) OVER (PARTITION BY {group}, {k}) AS _n")
        .selectExpr("*", f"(_bin + 1) * {k} <= _n AS _full", f"coalesce(sum(length) OVER {in_bin}, 0) AS _before")
        .withColumn("sequence_id", F.expr(f"CASE WHEN _full THEN {base} + {group} * {2**43} + {k} * {2**32} + _bin END"))
        .withColumn("offset", F.expr("CASE WHEN _full THEN _before END"))
        .drop("_bin", "_n", "_full", "_before")
    )


def first_fit(rest: DataFrame, capacity: int) -> DataFrame:
    """The last pieces, fewer than k of each class k, by first fit in falling length."""

    def fill(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        used: list[int] = []
        places = []
        for length in pieces["length"].tolist():
            at = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            places.append((2**62 + at, used[at]))
            used[at] += length
        pieces["sequence_id"] = [s for s, _ in places]
        pieces["offset"] = [o for _, o in places]
        return pieces

    return rest.groupBy().applyInPandas(fill, rest.schema)


def sequences(pieces: DataFrame, capacity: int = 1024, pad_id: int = 0) -> DataFrame:
    """The sequences of pieces that carry their ids: sequence_id, length, ids.

    Sequences shorter than ``capacity`` are padded with ``pad_id`` unless their length is a power of two.
    """
    joined = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_pieces")
    )
    ids = F.flatten(F.transform("_pieces", lambda p: p["ids"]))
    padding = F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.col("length").cast("int"))
    padded = F.when(F.bit_count("length") == 1, ids).otherwise(F.concat(ids, padding))
    return joined.select("sequence_id", "length", padded.alias("ids"))
