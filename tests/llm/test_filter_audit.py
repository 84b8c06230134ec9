"""Orders of filters against a plain simulation, and the flags of documents by hand."""

import random
from itertools import permutations

from pyspark.sql import functions as F

from parcelflow.llm import filter_audit

SCHEMA = "part string, A boolean, B boolean, C boolean, good boolean"


def simulated(rows, names):
    """Every order applied document by document."""
    found = {}
    for part in {r[0] for r in rows}:
        docs = [(dict(zip(names, r[1:])), r[-1]) for r in rows if r[0] == part]
        for order in permutations(names):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if d[0][name]]
                failing = [d for d in docs if d[0][name]]
                left = [d for d in left if not d[0][name]]
                only = sum(1 for f, _ in failing if sum(bool(f[n]) for n in names) == 1)
                found[part, "".join(order), step] = (len(left), len(gone), len(failing) - len(gone), only, sum(bool(g) for _, g in gone))
    return found


def test_lehmer_ranks_are_dictionary_order():
    for n in (1, 3, 4):
        assert [filter_audit.lehmer_rank(p, n) for p in permutations(range(n))] == list(range(len(list(permutations(range(n))))))


def test_intervals_hold_each_order_of_a_mask_once():
    for mask in range(1, 32):
        own = [(a, b) for m, _, a, b in filter_audit.removal_intervals(5) if m == mask]
        assert sorted(r for a, b in own for r in range(a, b)) == list(range(120))


def test_all_orders_against_simulation(spark):
    rng = random.Random(5)
    flags = [True, False, None]
    rows = [(rng.choice(["x", "y", ""]), *[rng.choice(flags) for _ in range(4)]) for _ in range(200)] + [("clean", False, None, False, True)]
    found = filter_audit.audit_orders(spark.createDataFrame(rows, SCHEMA), "ABC", "part", ["good"]).collect()
    expected = simulated(rows, "ABC")
    assert {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"]) for r in found} == expected
    assert len(found) == len(expected)
    for r in found:
        letter = r["filter_order"][r["step"] - 1]
        assert r["shapley"] == sum(v[1] for (p, order, step), v in expected.items() if p == r["part"] and order[step - 1] == letter)


def test_no_documents_no_rows(spark):
    assert filter_audit.audit_orders(spark.createDataFrame([], SCHEMA), "ABC", "part", ["good"]).count() == 0


def test_flags_of_documents(spark):
    long = " ".join(f"w{i}" for i in range(200))
    docs = [
        (2, long, "en"), (1, long, "en"), (3, long + " |", None), (None, long, "en"), (4, None, ""), (4, "", "de"),
        (5, "AAA\x0bB c" * 2_000, "de"), (2, long, "fr"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumn("_digest", F.lit(1)).withColumn("A", F.lit("x"))
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (5, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = filter_audit.flag_documents(frame, labels, "lang").collect()
    flags = sorted((r["part"], "".join(c for c in "ABCDE" if r[c]), bool(r["good"]), bool(r["toxic"])) for r in found)
    assert flags == sorted([
        ("en", "E", False, False),  # doc 2 repeats doc 1
        ("en", "", True, False),
        ("", "D", False, False),
        ("en", "", False, False),  # a null id has no smaller one
        ("", "A", False, False),
        ("de", "A", False, False),  # shares its id with the other empty text
        ("de", "BC", False, True),
        ("fr", "E", False, False),
    ])


def test_a_third_of_all_rows_equal(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same words").otherwise(F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang")
    )
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = filter_audit.flag_documents(docs, labels, "lang")
    assert found.filter("E").count() == 299
