"""Radix ranks against sorting in Python, and resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import radix_sort, resampling

DOCS = "doc_id bigint, text string"


def nulls_last(value, ascending):
    return (value is None, 0 if value is None else value if ascending else -value)


@pytest.mark.parametrize("top", [0, 1, 1_000, 2**63 - 1])
def test_ranks_against_sorting(spark, top, monkeypatch):
    monkeypatch.setattr(radix_sort, "BLOCK_BITS", 3)  # many blocks
    rng = random.Random(top)
    rows = [(rng.choice([None, rng.randint(-top, top)]), rng.randint(-3, 3) if top < 2**62 else rng.randint(-top, top), i) for i in range(150)]
    found = radix_sort.with_ranks(spark.createDataFrame(rows, "a bigint, b bigint, c int").repartition(3), [("a", False), ("b", True), ("c", True)])
    expected = sorted(rows, key=lambda r: (nulls_last(r[0], False), r[1], r[2]))
    assert [tuple(r)[:3] for r in found.orderBy("rank").collect()] == expected
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 151))


def test_ranks_of_nothing_and_of_equal_rows(spark):
    assert radix_sort.with_ranks(spark.createDataFrame([], "a bigint"), [("a", True)]).count() == 0
    same = spark.createDataFrame([(7,)] * 5, "a bigint")
    assert sorted(r["rank"] for r in radix_sort.with_ranks(same, [("a", True)]).collect()) == [1, 2, 3, 4, 5]
    nulls = spark.createDataFrame([(None,)] * 3, "a bigint")
    assert sorted(r["rank"] for r in radix_sort.with_ranks(nulls, [("a", False)]).collect()) == [1, 2, 3]


def plain(docs, target, percent, least, longest):
    def runs(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    def bucket(run):
        return zlib.crc32(run.encode()) % 10_000

    s = Counter(bucket(r) for _, t in docs for r in runs(t)[1])
    t = Counter(bucket(r) for x in target for r in runs(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    found = []
    for doc_id, text in docs:
        words, own = runs(text)
        weight = sum(gain(bucket(r)) for r in own)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        found.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((r for r in found if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = Counter()
    out = []
    for place, r in enumerate(able, 1):
        out.append((*r[:4], place if place <= percent * len(able) // 100 else None))
    return sorted(out + [(*r[:4], None) for r in found if r[4] < least], key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_against_plain_python(spark, longest, monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 40)
    rng = random.Random(longest)
    words = ["Alpha", "beta,", "GAMMA-delta", "été", "ÉTÉ", "x9", " ", "漢字", "\x00z", "w" * 90, "\n"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)]
    docs += [(None, docs[5][1]), (7, docs[7][1]), (7, docs[8][1]), (100, None), (101, ""), (102, "a " * 3_000)]
    target = ["alpha beta", None, "", "x9 X9 été"]
    frame = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("other")).withColumn("rank", F.lit(1))
    found = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), 30, 5, longest=longest)
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, target, 30, 5, longest)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampling.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "a b c")], DOCS)
    assert [r["rank"] for r in resampling.resample(one, none, percent=100, least_words=3).collect()] == [1]
