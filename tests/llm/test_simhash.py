"""SimHash groups against plain Python, the Golay keys and the components under them."""

import random

import numpy as np
import pytest
import xxhash

from parcelflow.llm import simhash
from parcelflow.llm.components import components


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def plain_groups(docs, bits=2):
    prints = [plain_fingerprint(t) for _, t in docs]
    label = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i in range(len(docs)):
            for j in range(len(docs)):
                if (prints[i] ^ prints[j]).bit_count() <= bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    names = {}
    for (d, _), g in zip(docs, label):
        names[g] = min([x for x in (names.get(g), d) if x is not None], default=None)
    return [(d, f"{p:016x}", names[g]) for (d, _), p, g in zip(docs, prints, label)]


def documents():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(40):
        base = [draw.choice(words) for _ in range(draw.choice([1, 2, 3, 60, 300]))]
        docs.append((i * 3 + 200, " ".join(base)))
        for j in range(draw.randrange(4)):
            near = list(base)
            near[draw.randrange(len(near))] = "other"
            docs.append((i * 3 + 201 + j % 2, "\t".join(near).upper() if j else "\n".join(near)))
    return docs + [(5, None), (6, ""), (7, " \n"), (8, "A b C"), (9, "a B c"), (9, "a B c"), (None, "a b c"), (None, "alone in this")]


def test_groups_are_those_of_plain_python(spark):
    docs = documents()
    frame = spark.createDataFrame([(d, t, "f") for d, t in docs], "doc_id bigint, text string, fingerprint string").repartition(3)
    found = simhash.near_duplicates(frame).collect()
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=order) == sorted(plain_groups(docs), key=order)
    assert len({r["component_id"] for r in found}) < len({r["fingerprint"] for r in found})


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"word{i * i % 977}" for i in range(3_000))
    whole = simhash.fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "AT_A_TIME", 100)
    assert simhash.fingerprint(text.encode(), 3) == whole == plain_fingerprint(text)


def test_words_two_bits_apart_share_a_codeword():
    words = np.random.default_rng(1).integers(0, 2**23, 400)
    own = simhash.code_indices(words)
    assert set((own >= 0).sum(axis=1).tolist()) == {1, 6}
    for a in range(23):
        for b in range(a, 23):
            other = simhash.code_indices(words ^ (1 << a) ^ ((1 << b) if a != b else 0))
            assert ((own[:, :, None] == other[:, None, :]) & (own[:, :, None] >= 0)).any((1, 2)).all()


def test_every_pair_two_bits_apart_is_linked(spark):
    draw = random.Random(9)
    base = [draw.getrandbits(64) for _ in range(40)]
    near = [x ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for x in base for _ in range(5)]
    far = [x ^ (7 << draw.randrange(60)) for x in base]
    values = sorted(set(base + near + far))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    found = {tuple(r) for r in simhash.links(frame, 2).collect()}
    expected = {
        (a, b) for a, x in zip(signed, values) for b, y in zip(signed, values) if a < b and (x ^ y).bit_count() <= 2
    }
    assert found == expected


def test_distances_beyond_the_keys_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string"), max_bits=3)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    edges = chain + star + [(3, 3), (300, 301), (301, 302), (302, 300), (300, 301)]
    draw = random.Random(2)
    draw.shuffle(edges)
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    expected = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {300: 300, 301: 300, 302: 300}
    assert found == expected
