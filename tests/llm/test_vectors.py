"""Nearest neighbours and near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import cross_polytope, rp_forest

NAN, INF = float("nan"), float("inf")


def collection(seed, n=300, d=16):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, d)).astype(np.float32)
    for i in range(0, n, 5):  # groups of near copies
        x[i + 1] = x[i] + draw.normal(size=d) * 0.1
        x[i + 2] = x[i + 1] + draw.normal(size=d) * 0.1
    x[40:60] = x[3]  # one vector many times
    rows = [(i, [float(v) for v in row], i // 5 % 3) for i, row in enumerate(x)]
    odd = [None, [0.0] * d, [NAN] + [1.0] * (d - 1), [INF] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0], []]
    rows += [(1_000 + i * 100, v, 0) for i, v in enumerate(odd)] + [(2_000, rows[0][1], None), (2_001, rows[0][1], 0), (None, rows[0][1], 0)]
    return rows + [rows[7]]  # a repeated row


def frame(spark, rows):
    # the columns rank and links clash with those the operators make
    own = [(i, v, y, 1, "x") for i, v, y in rows]
    return spark.createDataFrame(own, "vec_id bigint, embedding array<float>, label int, rank int, links string").repartition(4)


def able(v, d=16):
    return v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_all_leaves_give_the_exact_neighbours(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "PART", 20)  # leaves of several parts
    rows = collection(1)
    found = rp_forest.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=10, share=1.0).collect()
    vectors = {i: np.array(v, np.float64) for i, v, _ in rows if i is not None and able(v)}
    queries = [i for i in vectors if i % 20 == 0]
    expected = {}
    for q in queries:
        near = sorted((float(np.sqrt(((vectors[q] - v) ** 2).sum())), i) for i, v in vectors.items() if i != q)[:10]
        expected |= {(q, n + 1): (i, s) for n, (s, i) in enumerate(near)}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == expected
    assert len(found) == len(expected)


def test_a_share_of_the_leaves_finds_most(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(20, 16)) * 3
    rows = [(i, [float(v) for v in centres[i % 20] + draw.normal(size=16)], 0) for i in range(1_000)]
    exact = {(r[0], r[2]) for r in rp_forest.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, share=1.0).collect()}
    found = {(r[0], r[2]) for r in rp_forest.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, share=0.3).collect()}
    assert len(found & exact) / len(exact) >= 0.9


def test_few_or_no_candidates(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0)]
    found = rp_forest.nearest(frame(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found)] == [(1, 1, math.sqrt(2)), (2, 2, math.sqrt(2))]
    assert rp_forest.nearest(frame(spark, rows[:1]), F.col("vec_id") == 0).count() == 0
    assert rp_forest.nearest(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert rp_forest.nearest(frame(spark, [(0, None, 0)]), F.lit(True)).count() == 0


def plain_links(rows, threshold):
    usable = [able(v) and y is not None for _, v, y in rows]
    x = np.array([v if ok else [1.0] * 16 for (_, v, _), ok in zip(rows, usable)], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 if y is None else y for _, _, y in rows])
    ok = np.array(usable)
    linked = (x @ x.T >= threshold) & (label[:, None] == label) & ok[:, None] & ok
    np.fill_diagonal(linked, False)
    group = np.arange(len(rows))
    while True:
        new = np.minimum(group, np.where(linked, group, len(rows)).min(axis=1))
        if (new == group).all():
            break
        group = new
    names = {}
    for (i, _, _), g in zip(rows, group):
        names[g] = min([v for v in (names.get(g), i) if v is not None], default=None)
    return [(i, int(linked[n].sum()), names[group[n]], i == names[group[n]]) for n, (i, _, _) in enumerate(rows)]


@pytest.mark.parametrize("part", [1_024, 6])
def test_links_are_those_of_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(cross_polytope, "PART", part)  # buckets cut into parts
    monkeypatch.setattr(cross_polytope, "PAIRS", 50)
    rows = collection(2)
    found = cross_polytope.near_duplicates(frame(spark, rows), 0.93).collect()
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, found), key=order) == sorted(plain_links(rows, 0.93), key=order)


def test_pairs_at_the_threshold_meet():
    draw = np.random.default_rng(1)
    x = cross_polytope.unit(draw.normal(size=(2_000, 64)))
    y = draw.normal(size=x.shape)
    y = cross_polytope.unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    a, b = cross_polytope.codes(x), cross_polytope.codes(0.93 * x + math.sqrt(1 - 0.93**2) * y)
    met = (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)
    assert met.any(axis=1).mean() >= 0.999


def test_rotations_keep_lengths():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(5, 32))
    turned = cross_polytope.rotated(x, draw.choice([-1.0, 1.0], (3, 32))) / 32**1.5
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1)) and not np.allclose(turned, x)


def test_no_vectors(spark):
    assert cross_polytope.near_duplicates(frame(spark, collection(1)).limit(0)).count() == 0
    only_odd = cross_polytope.near_duplicates(frame(spark, [(1, None, 0), (2, [0.0], 0), (3, [1.0], None)])).collect()
    assert sorted(map(tuple, only_odd)) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_vectors_of_each_length_are_compared(spark):
    """Two of a rarer length link and are neighbours of each other, whatever the length of the others."""
    rows = [(i, [float(i), 1.0, 2.0, float(i % 7)], 0) for i in range(1, 30)] + [(100, [1.0, 2.0], 0), (101, [1.0, 2.0], 0), (102, [2.0, 4.1], 0), (103, [-1.0], 0)]
    found = {r["vec_id"]: r for r in cross_polytope.near_duplicates(frame(spark, rows), 0.93).collect()}
    assert (found[100]["n_links"], found[102]["n_links"], found[102]["component_id"], found[103]["n_links"]) == (2, 2, 100, 0)
    near = rp_forest.nearest(frame(spark, rows), F.col("vec_id") >= 100, k=5).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in near) == [
        (100, 1, 101), (100, 2, 102), (101, 1, 100), (101, 2, 102), (102, 1, 100), (102, 2, 101)
    ]
