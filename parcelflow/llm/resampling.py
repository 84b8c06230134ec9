"""Resampling of documents towards the word distribution of a target, by hashed runs of words.

Every run of words falls into one of a fixed number of buckets. The buckets are counted over the whole corpus
and the whole target; the logarithm of a bucket's smoothed ratio is its gain, and a document's weight is the sum
of its gains, looked up in an array. A Gumbel number drawn from the document's id is added, so that taking the
highest scores draws without replacement in proportion to the weights. The scores are ranked by a distributed
radix sort.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.radix_sort import with_ranks
from parcelflow.llm.shared import map_batches, texts_as_bytes, written
from parcelflow.llm.tokens import BLOCK_BYTES, blocks

BUCKETS = 10_000
#: Bytes of a text that are cut into words at a time.
SLICE = 4_000_000
#: Different runs that a worker remembers with their buckets; beyond them it starts anew.
REMEMBERED = 1_000_000

#: A-Z become a-z; all ASCII characters but letters and digits become spaces; other bytes stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Buckets(dict):
    """Bucket, or what an array has for the bucket, of each run of words met so far."""

    def __init__(self, number: int, values: list[int] | None = None):
        super().__init__()
        self.number, self.values = number, values

    def __missing__(self, run: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = zlib.crc32(run) % self.number
        found = self[run] = bucket if self.values is None else self.values[bucket]
        return found


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, some megabytes at a time."""
    plain = text.translate(WORD_BYTES)
    at = 0
    while len(plain) - at > SLICE:
        end = plain.rfind(b" ", at, at + SLICE)
        if end < 0:  # one word longer than a slice
            end = plain.find(b" ", at + SLICE)
            end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end
    yield plain[at:].split()


def run_slices(text: bytes, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of one to ``longest`` consecutive words, joined by a space, with the number of words, slice by slice."""
    held: list[bytes] = []  # the last words of the slice before
    for words in word_slices(text):
        runs = list(words)
        joined = held + words
        for n in range(2, longest + 1):
            first = max(0, len(held) - n + 1)
            runs += [b" ".join(joined[i : i + n]) for i in range(first, len(joined) - n + 1)]
        yield len(words), runs
        held = joined[max(0, len(joined) - longest + 1) :] if longest > 1 else []


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Runs of all whole texts in each bucket; null texts have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for block in blocks(batches, 0, BLOCK_BYTES // 2):
            for t in texts_as_bytes(block.column(0)):
                for _, runs in run_slices(t, longest):
                    counted = Counter(runs)
                    places = np.fromiter(map(known.__getitem__, counted), np.int64, len(counted))
                    np.add.at(total, places, np.fromiter(counted.values(), np.int64, len(counted)))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    counted = map_batches(texts.select(F.col(text).cast("string").alias("_text")), work, "bucket bigint, n bigint")
    # at most one row for each bucket
    sums = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(buckets, np.int64)
    found[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return found


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln ((t+1)(S+B) / ((s+1)(T+B)))) of each of the B buckets."""
    n, all_s, all_t = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = ((target + 1.0) * (all_s + n)) / ((corpus + 1.0) * (all_t + n))
    return [math.floor(1000 * math.log(r)) for r in ratios.tolist()]


def weigh(docs: DataFrame, gains: list[int], text: str = "text", keep: list[str] | None = None, longest: int = 1) -> DataFrame:
    """n_words, n_features, weight and the input's columns ``keep`` (all by default) as a struct ``row``."""
    keep = docs.columns if keep is None else keep
    inner = [f"_{i}" for i in range(len(keep))]
    schema = ", ".join([f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(inner, keep)] + ["_words bigint, _features bigint, _weight bigint"])
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(shared.value), shared.value)
        for block in blocks(batches, len(inner), BLOCK_BYTES // 2):
            found = np.zeros((3, block.num_rows), np.int64)
            for i, t in enumerate(texts_as_bytes(block.column(len(inner)))):
                for words, runs in run_slices(t, longest):
                    found[:, i] += (words, len(runs), sum(map(known.__getitem__, runs)))
            yield pa.RecordBatch.from_arrays([*block.columns[: len(inner)], *map(pa.array, found)], [*inner, "_words", "_features", "_weight"])

    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner)], F.col(text).cast("string").alias("_text"))
    row = F.struct(*[F.col(n).alias(c) for n, c in zip(inner, keep)])
    return map_batches(rows, work, schema).select(
        F.col("_words").alias("n_words"), F.col("_features").alias("n_features"), F.col("_weight").alias("weight"), row.alias("row")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
    longest: int = 1,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The id, n_features, weight, score and rank of every document; the rank of those not drawn is null.

    Of the N documents with ``least_words`` words the floor(percent * N / 100) with the highest scores are drawn; ties go to the
    smaller id, null ids come last and are drawn like an empty one, rows with equal ids and scores go by n_features.
    Whole texts count; a null or empty text has no features and the weight 0. Repeated rows count and are drawn
    each. An empty table gives no rows, an empty target gains from smoothing alone. Other columns do not matter.
    """
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    weighed = weigh(docs, gains, text, [doc_id], longest)
    # 32 bits of a hash of the id as a number inside (0, 1), and from it one of Gumbel's distribution
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"row.{doc_id}").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(F.log(-F.log((h + 0.5) / F.lit(4294967296.0))) * -1000)
    scored = weighed.select(F.col(f"row.{doc_id}").alias(doc_id), "n_features", "weight", (F.col("weight") + noise).alias("score"), "n_words")
    scored = written(scored, "resample-scores")
    able = scored.filter(F.col("n_words") >= least_words).drop("n_words")
    draw = percent * able.count() // 100
    ranked = with_ranks(able, [("score", False), (doc_id, True), ("n_features", True)])
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).drop("n_words").withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest)
