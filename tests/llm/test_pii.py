"""Base spans against plain patterns, the field against summing over all labels, and what it adds."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import pii, queries
from parcelflow.llm.skip_chain import Graph, SkipChain

#: The contract's patterns as they stand, for short texts.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    checks = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        "phone": lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if checks[k](m.group())]
    return sorted(found)


def test_base_spans_against_plain_patterns():
    rng = random.Random(1)
    pieces = ["a@b.c", "x.y@", "@", ".", "1.2.3.4", "256", "0001", "4111 1111-1111 1111", "4465758382889437", " ", "-", "+1 (743) 555-3824", "+", "(", ")", "é", "9", "a%+-", "\n", "..", "@b.c.d"]
    for _ in range(4_000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 12)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "1 " * 200_000, "+1" * 200_000, "1" * 200_000 + ")" * 200_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)
    pii.tokens(text)


def test_marginals_on_a_tree_are_exact():
    rng = np.random.default_rng(4)
    field = SkipChain(np.array([0, 1, 1]), rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), np.array([0.3, 1.7]))
    graph = Graph(np.array([0, 1, 2, 3, 0]), np.array([2, 1, 1, 1]), np.array([[0, 1], [1, 2]]), np.array([[0], [3]]))
    marginal, near, far = field.infer(graph, rounds=60)
    own, weights, pair = field.scores(graph), {}, np.zeros((3, 3))
    for y in itertools.product(range(3), repeat=4):
        score = sum(own[i, y[i]] for i in range(4)) + field.near[y[0], y[1]] + field.near[y[1], y[2]] + field.far()[y[0], y[3]]
        weights[y] = np.exp(score)
        pair[y[0], y[3]] += weights[y]
    total = sum(weights.values())
    for i in range(4):
        exact = [sum(w for y, w in weights.items() if y[i] == label) / total for label in range(3)]
        assert np.allclose(marginal[i], exact, atol=1e-6)
    assert np.allclose(far, pair / total, atol=1e-6)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)

    def words(n):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))

    def card():
        digits = "4" + "".join(rng.choices("0123456789", k=14))
        return digits + next(d for d in "0123456789" if luhn(digits + d))

    texts = []
    for i in range(80):
        form = [
            lambda: f"{words(1)}.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com",
            lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
            card,
            lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        ][i % 4]()
        texts.append(f"{words(20)} {form} {words(20)}")
    return texts + [f"{words(10)} {rng.randint(1, 99999)} {words(5)} {rng.random():.3f} {words(10)}" for _ in range(40)]


@pytest.fixture(scope="module")
def model(corpus):
    return pii.learn(corpus)


def added(model, text):
    return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.with_added(pii.base_spans(text), model.label([pii.Document.of(text)])[0]) if (a, k, b) not in pii.base_spans(text)]


def test_links_carry_the_kind_to_shortened_forms(model):
    far = " some other words stand here " * 50
    assert added(model, f"call +1 (743) 555-3824 now{far}and 743-555-3824 or 555-3824 again") == [("phone", "743-555-3824"), ("phone", "555-3824")]
    assert added(model, f"mail ab.19@mail5.example.com{far}or ab.19[at]mail5.example.com please") == [("email", "ab.19[at]mail5.example.com")]
    assert added(model, f"host 152.143.12.31{far}is 152[.]143[.]12[.]31 there") == [("ip", "152[.]143[.]12[.]31")]
    assert added(model, "pay 4465758382889437 4465758382889437 twice") == [("card", "4465758382889437")] * 2


def test_the_same_forms_without_a_complete_one_stay_clean(model):
    for text in ("order 555-3824 and part 743-555-3824 here", "section 10-20-30-40 of it", "version 1.2.3 of 2024-05-06, 99.5% of 1,000,000", "ab.19[at]mail5"):
        assert added(model, text) == [], text


def test_added_spans_leave_base_spans_alone():
    assert pii.with_added([(5, 0, 9), (5, 1, 7), (20, 2, 30)], [(0, 3, 5), (8, 3, 12), (9, 3, 12), (29, 1, 31)]) == [
        (0, 3, 5), (5, 0, 9), (5, 1, 7), (9, 3, 12), (20, 2, 30)
    ]


def test_scan_and_corner_cases(spark, corpus, model):
    texts = [*corpus[:8], "", None, "é " * 3 + "a.1@b.co", corpus[0], "1 2 3 " * 9_000 + corpus[2]]
    frame = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumn("spans", F.lit(1)).withColumn("_base", F.lit(2))
    found = pii.scan(frame, model).select("row.*", F.col("base").alias("b"), F.col("spans").alias("found"), "masked").collect()
    assert len(found) == len(texts)
    for r in found:
        text = r["text"] or ""
        assert [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["b"]] == plain_spans(text)
        assert set(r["b"]) <= set(r["found"])
        assert not any(text[s["start"] : s["end"]] in r["masked"] for s in r["b"])
    assert pii.scan(frame.limit(0), model).count() == 0
    assert pii.train(frame.limit(0)) is None
    assert [r["spans"] for r in pii.scan(spark.createDataFrame([("a@b.c",)], "text string"), None).collect()] == [[("email", 0, 5)]]


def test_query_against_plain_patterns(as_deployed):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(as_deployed, sf, "documents").collect()}
    found = queries.op12_pii(as_deployed, sf).collect()
    assert {r["doc_id"] for r in found} == set(texts) and len(found) == len(texts)
    for r in found:
        base = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(texts[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
