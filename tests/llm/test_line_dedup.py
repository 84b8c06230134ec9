"""Line dedup against plain Python, and the perfect hash under it."""

import random

import numpy as np
import pytest

from parcelflow.llm import line_dedup
from parcelflow.llm.perfect_hash import PerfectHash

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plainly(docs, min_chars=20, min_docs=3):
    lines = [(d, (t or "").split("\n")) for d, t in docs]
    holders = {}
    for row, (d, own) in enumerate(lines):
        for k in {key(x) for x in own if len(key(x)) >= min_chars}:
            holders.setdefault(k, []).append((d is not None, d, row))
    keeper = {k: max(h)[:2] for k, h in holders.items() if len(h) >= min_docs}
    result = []
    for d, own in lines:
        left = [x for x in own if keeper.get(key(x), (d is not None, d)) == (d is not None, d)]
        result.append((d, len(own), len(own) - len(left), "\n".join(left)))
    return result


def random_docs(n, seed):
    draw = random.Random(seed)
    shared = [f"Shared line number {i} of the corpus, É" for i in range(30)] + ["short line"]
    docs = []
    for i in range(n):
        lines = [draw.choice(shared) for _ in range(draw.randrange(6))] + [f"own line {i} {j} long enough" for j in range(draw.randrange(3))]
        lines = [draw.choice(["", "  ", "\t"]) + (x.upper() if draw.random() < 0.2 and "É" not in x else x) + draw.choice(["", " ", "\r"]) for x in lines]
        draw.shuffle(lines)
        docs.append((i * 7 % n, "\n".join(lines)))
    return docs


CORNERS = [
    (100, None), (101, ""), (102, "\n\n"), (103, "The same long line here.\n" * 3 + "end"), (104, "the SAME long line here."),
    (105, " The same long line here.\t"), (105, "The same long line here."), (None, "the same long line here.\nx"),
    (106, "The samé long line here."), (107, "THE SAMÉ long line here."), (108, "x" * 19), (109, "x" * 19), (110, "x" * 19),
]


@pytest.mark.parametrize("small_shards", [False, True])
def test_lines_go_as_in_plain_python(spark, monkeypatch, small_shards):
    if small_shards:
        monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 4)
        monkeypatch.setattr(line_dedup, "PROBES_PER_SHARD", 10)  # shards have copies
    docs = random_docs(90, 1) + CORNERS
    # the column n clashes with one the operator makes
    frame = spark.createDataFrame([(d, t, "n") for d, t in docs], "doc_id bigint, text string, n string").repartition(3)
    found = line_dedup.dedup_lines(frame, keep=["n", "doc_id"]).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r)[:4] for r in found), key=order) == sorted(plainly(docs), key=order)
    assert {tuple(r["kept_columns"]) for r in found} == {("n", d) for d, _ in docs}


def test_busy_shards_have_copies(spark, monkeypatch):
    """A line that a third of all documents hold is answered by its shard, like any other."""
    monkeypatch.setattr(line_dedup, "PROBES_PER_SHARD", 20)
    shared = "this line stands in a third of all documents"
    docs = [(i, f"a line of document {i:06d} alone" + (f"\n{shared}" if i % 3 == 0 else "")) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    counted = line_dedup.line_counts(frame, 20)
    repeated = counted.filter("n >= 3")
    pairs = counted.agg({"n": "sum"}).first()[0]
    copies = line_dedup.copies_of_shards(repeated, 1 + pairs // 20, pairs)
    assert copies.max() >= 5 and copies.sum() < 60
    found = line_dedup.dedup_lines(frame).collect()
    assert sum(r["n_dropped"] for r in found) == 99
    assert [r["doc_id"] for r in found if r["doc_id"] % 3 == 0 and not r["n_dropped"]] == [297]


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.dedup_lines(empty).count() == 0


def test_a_long_text_is_read_whole(spark):
    text = "\n".join(f"line {i:06d} of a very long text" for i in range(20_000)) + "\nthis one is shared by all of them"
    docs = [(1, text), (2, "this one is shared by all of them"), (3, "This one is shared by all of them")]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert (found[1]["n_lines"], found[1]["n_dropped"], found[2]["kept"], found[3]["n_dropped"]) == (20_001, 1, "", 0)


@pytest.mark.parametrize("n", [0, 1, 2, 1_000, 50_000])
def test_perfect_hash_is_minimal_and_survives_storage(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    stored = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    slots = stored.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    others = stored.slots(keys + np.uint64(1))
    assert ((others >= -1) & (others < max(1, len(keys)))).all()
