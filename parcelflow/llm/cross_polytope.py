"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A vector is turned by three rounds of random signs and a Walsh-Hadamard transform; the axis (and its sign) that
it then lies nearest to is a hash, and a few such hashes together name a bucket of a table. Every distinct
vector is stored in its bucket and also looks into the buckets that it only just missed. Two vectors that meet
in a bucket are verified by their cosine; a pair that meets in several buckets counts in the first table.

Identical vectors are one class with a number of copies. Buckets are compared in blocks; a block returns for each class the
copies it is linked with and one neighbour of its group, so no list of all pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.components import components
from parcelflow.llm.shared import map_batches, ship, written
from parcelflow.llm.vectors import lengths, matrix, usable

TABLES, HASHES, PROBES = 8, 2, 4
#: Members of a bucket that are compared at a time: larger buckets are cut into parts, every two of which meet.
PART = 1_024
#: Pairs of a block, and pairs whose vectors are held at a time.
PAIRS, AT_A_TIME = 1_000_000, 50_000


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows after rounds of sign changes and fast Walsh-Hadamard transforms; the width is a power of two."""
    for s in signs:
        x = x * s
        step = 1
        while step < x.shape[1]:
            pairs = x.reshape(len(x), -1, 2, step)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), -1)
            step *= 2
    return x


def codes(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = 11) -> np.ndarray:
    """Buckets of unit vectors: for each vector and table its own first, then the ``probes`` it missed by least."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    draw = np.random.default_rng(seed)
    found = np.empty((len(x), tables, 1 + probes), np.int64)
    near = min(probes + 1, width)
    for t in range(tables):
        axes, losses = [], []
        for _ in range(hashes):
            turned = rotated(padded, draw.choice([-1.0, 1.0], (3, width))) / width**1.5
            size = np.abs(turned)
            best = np.argsort(-size, axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(turned, best, 1)
            axes.append(best * 2 + (value < 0))
            losses.append(np.abs(value[:, :1]) - np.abs(value))
        own = sum(a[:, 0] * (2 * width) ** h for h, a in enumerate(axes))
        # another bucket has one of the hashes replaced by its next best axes
        others = [own[:, None] + (a[:, 1:] - a[:, :1]) * (2 * width) ** h for h, a in enumerate(axes)]
        others, loss = np.concatenate(others, axis=1), np.concatenate([x[:, 1:] for x in losses], axis=1)
        chosen = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        found[:, t, 0] = own
        found[:, t, 1:] = np.pad(np.take_along_axis(others, chosen, 1), ((0, 0), (0, probes - chosen.shape[1])), constant_values=-1)
    return found


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pairs_within(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places of the same run; ``ends`` has for each place the end of its run."""
    here = np.arange(len(ends))
    count = ends - here - 1
    before = np.cumsum(count) - count
    a = np.repeat(here, count)
    return a, np.arange(int(count.sum())) - np.repeat(before, count) + a + 1


def linked(block: "Block", threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that are linked and count here."""
    a, b = pairs_within(block.ends)
    # pairs within one part of a larger bucket are found in a block of its own
    met = (block.main[a] | block.main[b]) & ((block.low == block.high)[a] | (block.part[a] != block.part[b]))
    a, b = a[met], b[met]
    near = np.concatenate([cosine(block.x[a[i : i + AT_A_TIME]], block.x[b[i : i + AT_A_TIME]]) for i in range(0, len(a), AT_A_TIME)] or [np.array([])]) >= threshold
    a, b = a[near], b[near]
    if not len(a):
        return a, b
    rows, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    buckets = codes(unit(block.x[rows]))
    left, right = buckets[place[: len(a)]], buckets[place[len(a) :]]
    counts_here = np.ones(len(a), bool)
    for t in range(TABLES):
        own_left, own_right = left[:, t, 0], right[:, t, 0]
        meets = (right[:, t, 1:] == own_left[:, None]).any(axis=1)
        met_by = (left[:, t, 1:] == own_right[:, None]).any(axis=1)
        same = own_left == own_right
        counts_here &= ~((t < block.table[a]) & (same | meets | met_by))
        # each in the other's bucket: counts where the smaller node is stored
        twice = (t == block.table[a]) & ~same & meets & met_by
        counts_here &= ~twice | (block.main[a] == (block.node[a] < block.node[b]))
    return a[counts_here], b[counts_here]


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    dots = np.einsum("ij,ij->i", x, y)
    return dots / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


class Block:
    """Sorted members of whole runs: those of one bucket, or of two parts of it, lie together."""

    def __init__(self, rows: pa.Table):
        self.x = matrix(rows["vector"].combine_chunks())
        self.node, self.copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        self.main = rows["main"].to_numpy()
        self.table, self.part, self.low, self.high = (rows[c].to_numpy() for c in ("table", "part", "low", "high"))
        bounds = run_bounds(rows)
        self.ends = np.repeat(bounds[1:], np.diff(bounds))


def run_bounds(rows: pa.Table) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("table", "label", "bucket", "low", "high"):
        own = rows[name].combine_chunks()
        new[1:] |= pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), rows.num_rows)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of whole runs from sorted batches, with a bounded number of pairs each unless one run has more."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows = pa.concat_tables(held).combine_chunks()
        bounds = run_bounds(rows)
        yield from split(rows, bounds[:-1])  # the last run may go on
        held = [rows.slice(int(bounds[-2]))] if rows.num_rows else []
    if held:
        rows = pa.concat_tables(held).combine_chunks()
        yield from split(rows, run_bounds(rows))


def split(rows: pa.Table, bounds: np.ndarray) -> Iterator[Block]:
    sizes = np.diff(bounds)
    total = np.cumsum(sizes * (sizes - 1) // 2)
    at = 0
    while at < len(sizes):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
        yield Block(rows.slice(int(bounds[at]), int(bounds[to] - bounds[at])))
        at = to


def groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place that it is linked to, directly or through others."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(
    rows: DataFrame, threshold: float = 0.93, row_id: str = "vec_id", vector: str = "embedding", label: str | None = "label"
) -> DataFrame:
    """Links between vectors with a cosine of at least ``threshold`` and equal, non-null labels.

    Returns vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable by links)
    and kept (whether that is the row's own), one row per input row. Vectors that are null, zero, or hold null or
    non-finite components link with nothing, nor do those without a label; they are components of their own. Vectors
    are compared with those of their length. Rows with equal vectors and labels are linked with each other, repeated rows among
    them. A null vec_id names a component only if all its rows lack one; such a row is kept. An empty table
    gives no rows; other columns do not pass. With ``label`` None all rows are compared. Linked pairs are found with a
    probability that grows with their cosine (over 0.99 at a cosine of 0.93 in 64 dimensions); none below the
    threshold is reported.
    """
    ship(rows.sparkSession)
    own = rows.select(
        F.col(row_id).alias("vec_id"), F.col(vector).alias("vector"), (F.lit(0) if label is None else F.col(label)).alias("label")
    )
    able = own.filter(usable("vector") & F.col("label").isNotNull())
    classes = written(
        able.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("smallest"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    # vectors of each length have rotations and buckets of their own
    each = [compared(classes.filter(F.size("vector") == d), threshold) for d in lengths(classes, "vector") or [0]]
    found = written(reduce(DataFrame.unionByName, each), "vector-links")
    grouped = components(found.select(F.col("node").alias("a"), F.col("anchor").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = (
        classes.join(links, "node", "left").join(grouped, "node", "left")
        .select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "smallest", F.coalesce("component", "node").alias("component"))
    )
    names = placed.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = placed.join(names, "component").select("label", "vector", "n_links", "component_id", F.lit(True).alias("found"))
    return own.join(named, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("found"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        F.when(F.col("found"), F.col("vec_id").eqNullSafe(F.col("component_id"))).otherwise(True).alias("kept"),
    )


def compared(classes: DataFrame, threshold: float) -> DataFrame:
    """node, anchor (a node of its group), links (copies linked with): for each class of a block with a link."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = codes(unit(matrix(batch.column(2))))
            n, tables, places = found.shape
            shape = (n, tables, places)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.broadcast_to(np.arange(tables, dtype=np.int32)[None, :, None], shape).ravel()),
                    batch.column(1).take(pa.array(np.repeat(np.arange(n), tables * places))),
                    pa.array(found.ravel()),
                    batch.column(0).take(pa.array(np.repeat(np.arange(n), tables * places))),
                    pa.array(np.broadcast_to((np.arange(places) == 0)[None, None, :], shape).ravel()),
                ],
                ["table", "label", "bucket", "node", "main"],
            )

    kind = dict(classes.dtypes)["label"]
    keys = ["table", "label", "bucket"]
    members = map_batches(
        classes.select("node", "label", "vector"), hashed, f"table int, label {kind}, bucket bigint, node bigint, main boolean"
    ).filter("bucket >= 0")
    # buckets where two can meet
    met = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.count_if("main").alias("stored")).filter("size > 1 AND stored > 0")
    parts = F.ceil(F.col("size") / PART).cast("int")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = (
        members.join(met, keys).withColumn("parts", parts).withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    )
    payload = classes.select("node", "vector", "copies")
    blocks = placed.join(payload, "node").select(*keys, "low", "high", "node", "main", "part", "vector", "copies")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches):
            a, b = linked(block, threshold)
            n = len(block.node)
            links = np.bincount(a, block.copies[b], n) + np.bincount(b, block.copies[a], n)
            hit = np.flatnonzero(links)
            anchor = block.node[groups(n, a, b)[hit]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.node[hit]), pa.array(anchor), pa.array(links[hit].astype(np.int64))], ["node", "anchor", "links"]
            )

    order = [*keys, "low", "high"]
    return map_batches(blocks.repartition(*order).sortWithinPartitions(*order), compare, "node bigint, anchor bigint, links bigint")
