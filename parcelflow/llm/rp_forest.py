"""Nearest neighbours by a forest of random-projection trees.

Each tree halves a bounded sample again and again, along directions that are random and, within a tree, at
right angles. All distinct vectors are filed in one leaf of every tree. A query walks all trees at once
through one priority queue, ordered by the squared distance to a cell that the splits passed so far
prove, and takes leaves until they hold a given share of all vectors. Where leaves meet queries, distances are
exact; only the nearest of each leaf leave it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.shared import chosen, map_batches, ship, written
from parcelflow.llm.vectors import lengths, matrix, usable

#: Bounds of the model: sampled vectors, trees, and levels of a tree.
SAMPLE, TREES, LEVELS = 8_192, 8, 8
#: Share of all vectors that the leaves taken by a query hold. Vectors without any structure need most of them for a
#: recall of 0.9; clustered ones need a few hundredths.
SHARE = 0.75
#: Vectors of a leaf that meet queries at a time.
PART = 20_000


@dataclass
class Forest:
    """Trees as arrays: node n has the children 2n + 1 and 2n + 2; leaves follow the inner nodes."""

    directions: np.ndarray  # trees x levels x dimension
    bounds: np.ndarray  # trees x inner nodes

    @classmethod
    def fit(cls, sample: np.ndarray, trees: int = TREES, levels: int = LEVELS, seed: int = 5) -> "Forest":
        draw = np.random.default_rng(seed)
        d = sample.shape[1]
        levels = max(1, min(levels, d, int(np.log2(max(2, len(sample) / 2)))))
        directions = np.stack([np.linalg.qr(draw.normal(size=(d, d)))[0][:levels] for _ in range(trees)])
        bounds = np.zeros((trees, 2**levels - 1))
        for t in range(trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(levels):
                height = sample @ directions[t, level]
                for n in range(2**level - 1, 2 ** (level + 1) - 1):
                    own = height[node == n]
                    bounds[t, n] = np.median(own) if len(own) else 0.0
                node = 2 * node + 1 + (height > bounds[t, node])
        return cls(directions, bounds)

    @property
    def levels(self) -> int:
        return self.directions.shape[1]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        found = np.empty((len(x), len(self.bounds)), np.int64)
        for t, directions in enumerate(self.directions):
            node = np.zeros(len(x), np.int64)
            for level in range(self.levels):
                node = 2 * node + 1 + (x @ directions[level] > self.bounds[t, node])
            found[:, t] = node - len(self.bounds[t])
        return found

    def search(self, x: np.ndarray, sizes: np.ndarray, share: float, least: int) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) for one query, nearest first, until they hold ``share`` of all vectors and ``least`` of one tree.

        A vector lies in one leaf of each tree; trees are taken to fall independently when the leaves' shares add up.
        """
        heights = np.einsum("tld,d->tl", self.directions, x)
        inner = self.bounds.shape[1]
        totals = np.maximum(sizes.sum(axis=1), 1)
        seen = np.zeros(len(totals))
        queue = [(0.0, t, 0) for t in range(len(totals))]
        taken = []
        while queue:
            proved, t, node = heapq.heappop(queue)
            if node >= inner:
                if sizes[t, node - inner]:
                    taken.append((t, node - inner))
                    seen[t] += sizes[t, node - inner]
                    if seen.max() >= least and 1 - np.prod(1 - seen / totals) >= share:
                        break
                continue
            margin = heights[t, (node + 1).bit_length() - 1] - self.bounds[t, node]
            near = 2 * node + 1 + (margin > 0)
            heapq.heappush(queue, (proved, t, int(near)))
            heapq.heappush(queue, (proved + margin * margin, t, int(4 * node + 3 - near)))
        return taken


def nearest(
    rows: DataFrame,
    queries: Column,
    k: int = 10,
    share: float = SHARE,
    row_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found for every row that ``queries`` (a condition on the input) picks.

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance in double precision), nearest first, ties
    to the smaller id; a query's own row is no candidate. Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do rows without an id; the candidates are the vectors of the query's length. Rows with equal
    vectors are one candidate with its k + 1 smallest ids, which is all that can be asked of it; rows that share an id and a
    vector count once. With fewer than k candidates all are returned; an empty table gives no rows; other columns do not pass.
    ``share`` 1 searches all leaves and is exact.
    """
    ship(rows.sparkSession)
    own = rows.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    able = written(own.filter(usable("vector") & F.col("id").isNotNull()), "vectors")
    found = [nearest_of_length(able.filter(F.size("vector") == d), k, share) for d in lengths(able, "vector")]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionByName, found)


def nearest_of_length(able: DataFrame, k: int, share: float) -> DataFrame:
    """As ``nearest``, for vectors of one length: id, vector, asks."""
    # the smallest ids of each distinct vector; Spark keeps only these of each task before the shuffle
    ranked = able.select("id", "vector").distinct().withColumn("n", F.expr("row_number() OVER (PARTITION BY vector ORDER BY id)"))
    smallest = ranked.filter(F.col("n") <= k + 1)
    distinct = written(smallest.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct-vectors")
    sampled = chosen(distinct.select("vector", F.col("ids")[0].alias("id")), SAMPLE, "id").select("vector").collect()
    forest = Forest.fit(np.array([r["vector"] for r in sampled], np.float64))

    kind = dict(distinct.dtypes)["vector"]
    filed = written(map_batches(distinct, filing(forest), f"tree int, leaf int, vector {kind}, ids array<bigint>"), "leaves")
    sizes = np.zeros((TREES, 2**forest.levels), np.int64)
    for r in filed.groupBy("tree", "leaf").count().collect():  # at most one row per leaf
        sizes[r["tree"], r["leaf"]] = r["count"]
    parts = -(-sizes // PART)

    asking = able.filter("asks")
    asked = written(asking.groupBy("vector").agg(F.min("id").alias("asker")), "asked")
    visits = map_batches(asked, visiting(forest, sizes, parts, share, k + 2), f"tree int, leaf int, part int, asker bigint, vector {kind}")
    placed = filed.withColumn("part", part_of(parts))
    found = visits.groupBy("tree", "leaf", "part").cogroup(placed.groupBy("tree", "leaf", "part")).applyInArrow(
        exact(k), "asker bigint, vec_id bigint, score double"
    )
    best = found.distinct().withColumn("n", F.expr("row_number() OVER (PARTITION BY asker ORDER BY score, vec_id)")).filter(F.col("n") <= k + 1)
    mine = asking.select(F.col("id").alias("query_id"), "vector").join(asked, "vector").select("query_id", "asker").distinct()
    others = mine.join(best, "asker").filter("query_id <> vec_id")
    final = others.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)"))
    return final.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def part_of(parts: np.ndarray) -> Column:
    """Part of its leaf that a row belongs to; only leaves of several parts are listed."""
    listed = {(int(t) << 32) + int(n): int(parts[t, n]) for t, n in zip(*np.nonzero(parts > 1))}
    if not listed:
        return F.lit(0)
    known = F.create_map(*[F.lit(x) for pair in listed.items() for x in pair])
    number = F.coalesce(F.element_at(known, F.shiftleft(F.col("tree").cast("bigint"), 32) + F.col("leaf")), F.lit(1))
    return F.pmod(F.xxhash64(F.col("ids")[0]), number).cast("int")


def filing(forest: Forest):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.leaves(matrix(batch.column(0)))
            n, trees = leaves.shape
            rows = pa.array(np.repeat(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(trees, dtype=np.int32), n)),
                    pa.array(leaves.ravel().astype(np.int32)),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                ],
                ["tree", "leaf", "vector", "ids"],
            )

    return work


def visiting(forest: Forest, sizes: np.ndarray, parts: np.ndarray, share: float, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, x in enumerate(matrix(batch.column(0))):
                found += [(t, leaf, p, i) for t, leaf in forest.search(x, sizes, share, least) for p in range(int(parts[t, leaf]))]
            tree, leaf, part, row = (np.array(c) for c in zip(*found)) if found else [np.array([], np.int64)] * 4
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c.astype(np.int32)) for c in (tree, leaf, part)], batch.column(1).take(taken), batch.column(0).take(taken)],
                ["tree", "leaf", "part", "asker", "vector"],
            )

    return work


def exact(k: int):
    """The k + 1 nearest rows of a part of a leaf for each query that visits it."""

    def work(visits: pa.Table, filed: pa.Table) -> pa.Table:
        askers, ids, scores = [], [], []
        if visits.num_rows and filed.num_rows:
            x, y = matrix(visits["vector"].combine_chunks()), matrix(filed["vector"].combine_chunks())
            lists = filed["ids"].to_pylist()
            square = (y * y).sum(axis=1)
            for asker, q in zip(visits["asker"].to_pylist(), x):
                rough = square - 2 * (y @ q)
                near = min(k + 8, len(y))
                bound = np.partition(rough, near - 1)[near - 1]
                close = np.flatnonzero(rough <= bound + 1e-9 * (abs(bound) + 1))
                distance = np.sqrt(((y[close] - q) ** 2).sum(axis=1))
                own = sorted((d, i) for d, c in zip(distance.tolist(), close.tolist()) for i in lists[c])[: k + 1]
                askers += [asker] * len(own)
                ids += [i for _, i in own]
                scores += [d for d, _ in own]
        return pa.table({"asker": pa.array(askers, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    return work
