"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each padded to the 23 bits of the perfect binary Golay
code. Two fingerprints at most two bits apart agree in at least one segment, and differ by at most two
bits in every other. Two words of 23 bits at most two bits apart share a codeword within four bits: the one
nearest to a word between them. A word has one codeword within three bits, and five more at four bits if
that one is three away, so it gets one or six indices. A key is one segment as it is with one
index of the next segment: every pair of fingerprints two bits apart shares a key, and the join on keys verifies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from parcelflow.llm.components import components
from parcelflow.llm.shared import map_batches, texts_as_bytes, written
from parcelflow.llm.tokens import blocks

SEED = 42
#: Widths of the segments of a fingerprint, lowest bits first.
SEGMENTS = (22, 21, 21)
CODE_BITS = 23
#: Fixed value: generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Shingles whose bits are counted at a time.
AT_A_TIME = 200_000
#: The keys find every pair up to this distance.
MOST_BITS = 2


def remainder(word: int) -> int:
    """Remainder of a word's polynomial modulo the generator: its syndrome."""
    for bit in range(CODE_BITS - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@lru_cache(1)
def near_codewords() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bits; and by syndrome the differences to all codewords within four bits, padded with -1."""
    single = np.array([remainder(1 << b) for b in range(CODE_BITS)], np.int64)
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for bits in combinations(range(CODE_BITS), weight):
            syndrome = int(np.bitwise_xor.reduce(single[list(bits)])) if bits else 0
            found[syndrome].append(sum(1 << b for b in bits))
    patterns = np.full((1 << 11, max(map(len, found))), -1, np.int64)
    for syndrome, own in enumerate(found):
        patterns[syndrome, : len(own)] = own
    return single, patterns


def code_indices(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word the indices (12 bits) of the codewords within four bits, padded with -1."""
    single, patterns = near_codewords()
    syndrome = np.zeros(len(words), np.int64)
    for b in range(CODE_BITS):
        syndrome ^= np.where(words >> b & 1, single[b], 0)
    differences = patterns[syndrome]
    # a codeword is told by its top 12 bits
    return np.where(differences >= 0, (words[:, None] ^ differences) >> 11, -1)


def fuzzy_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the fingerprint, key) for all keys of unsigned 64-bit fingerprints."""
    shifts = np.cumsum([0, *SEGMENTS[:-1]])
    parts = [
        (fingerprints >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(shifts.tolist(), SEGMENTS)
    ]
    places, keys = [], []
    for i, exact in enumerate(parts):
        index = code_indices(parts[(i + 1) % len(parts)])
        row, column = np.nonzero(index >= 0)
        places.append(row)
        keys.append((i << 40) + (exact[row] << 12) + index[row, column])
    return np.concatenate(places), np.concatenate(keys)


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a text in UTF-8 over its shingles of ``shingle`` words, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    size = min(shingle, len(words))
    first = starts[: len(words) - size + 1].tolist()
    last = (starts + lengths)[size - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), AT_A_TIME):
        spans = zip(first[at : at + AT_A_TIME], last[at : at + AT_A_TIME])
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint (bigint holding the 64 bits) of every whole text."""
    kind = dict(docs.dtypes)[doc_id]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            own = np.array([fingerprint(t, shingle) for t in texts_as_bytes(block.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(own.view(np.int64))], ["doc_id", "fingerprint"])

    return map_batches(docs.select(doc_id, text), work, f"doc_id {kind}, fingerprint bigint")


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b) of the given distinct fingerprints that differ in at most ``max_bits`` bits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            places, keys = fuzzy_keys(own.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[places])], ["key", "fingerprint"])

    keyed = map_batches(distinct.select("fingerprint"), work, "key bigint, fingerprint bigint")
    other = keyed.withColumnRenamed("fingerprint", "other")
    close = (F.col("fingerprint") < F.col("other")) & (
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= max_bits
    )
    pairs = keyed.join(other, "key").filter(close)
    return pairs.select(F.col("fingerprint").alias("a"), F.col("other").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Groups of documents whose fingerprints are linked, directly or through others.

    Returns doc_id, fingerprint (16 hexadecimal digits) and component_id (the smallest doc_id of the
    group), one row per input row. Texts are lower-cased in A-Z and split at ASCII white space; a text
    with fewer than ``shingle`` words is one shingle, a null or empty text has fingerprint zero and is
    linked like any other. Rows with equal fingerprints, repeated rows among them, are one node of the
    graph. A null doc_id never names a group unless all its rows lack one (component_id is then null). An
    empty table gives no rows; other columns of the input do not pass. ``max_bits`` is at most 2.
    """
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"max_bits must be between 0 and {MOST_BITS}: the keys find pairs no farther apart")
    found = written(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    classes = written(found.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")), "fingerprint-classes")
    grouped = components(links(classes, max_bits))
    placed = classes.join(grouped, classes["fingerprint"] == grouped["node"], "left").select(
        "fingerprint", "smallest", F.coalesce("component", "fingerprint").alias("component")
    )
    names = placed.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = placed.join(names, "component").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
