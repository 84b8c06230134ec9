"""Toxicity and quality: exact neighbours, right gradients, held-out accuracy, and corner cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from parcelflow.llm import quality, toxicity

SMALL = "/root/testdata/sf0.001"
CORNERS = [(900, None), (901, ""), (902, "   \n"), (903, "!!! ... ???"), (904, "x" * 200_000), (905, "fine words here " * 20_000)]


def corpus(bad, seed):
    """Documents and labels; every third one is spoilt by ``bad`` (a function of its words)."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randrange(3, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(150):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(30, 200))]
        spoilt = i % 3 == 0
        docs.append((i, " ".join(bad(words, draw) if spoilt else words)))
        labels.append((i, int(spoilt)))
    return docs, labels


def insulted(words, draw):
    for _ in range(1 + len(words) // 30):
        words.insert(draw.randrange(len(words)), draw.choice(["blockhead", "nitwit", "dullard"]))
    return words


def garbled(words, draw):
    at = draw.randrange(len(words) // 2 + 1)
    return words[:at] + [w.upper() + "!!" for w in words[at:]]


def frames(spark, docs, labels, name):
    rows = [(d, t, 0.5, ["e"]) for d, t in docs]
    # columns that clash with those the operators make
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, score double, evidence array<string>").repartition(3)
    return documents, spark.createDataFrame(labels, f"doc_id bigint, {name} int")


def test_nearest_examples_are_exact():
    draw = np.random.default_rng(0)
    idf = draw.uniform(1, 3, 60)
    vectors = [toxicity.unit_vector({int(t): int(draw.integers(1, 5)) for t in draw.choice(60, draw.integers(0, 9), False)}, idf) for _ in range(500)]
    index = toxicity.BlockMaxIndex.build(list(range(500)), [0] * 500, vectors, 60)
    dense = np.zeros((500, 60))
    for place, i in enumerate(index.ids):
        dense[place, vectors[i][0]] = vectors[i][1]
    for terms, weights in vectors[:60]:
        query = np.zeros(60)
        query[terms] = weights
        cosines = dense @ query
        places, found = index.nearest(terms, weights, 7)
        expected = np.sort(cosines[cosines > 0])[::-1][:7]
        assert np.allclose(found, expected) and np.allclose(cosines[places], found)


def test_toxic_documents_are_found(spark):
    docs, labels = corpus(insulted, 1)
    docs += CORNERS + [(None, docs[0][1]), (1, docs[1][1])]
    documents, labelled = frames(spark, docs, labels + [(None, 1), (5, None), (3, 0), (9_999, 1)], "toxic")
    model = toxicity.train(documents, labelled.filter("doc_id < 100 OR doc_id IS NULL OR doc_id = 9999"))
    rows = toxicity.score(documents, model).collect()
    assert len(rows) == len(docs) and rows[0]["row"].__fields__ == documents.columns
    assert all(0 <= r["score"] <= 1 for r in rows)
    truth = dict(labels)
    for r in rows:
        d = r["row"]["doc_id"]
        if d in truth and d >= 100:
            assert (r["score"] >= 0.5) == bool(truth[d])
        if d in (900, 901, 902, 903):
            assert r["score"] < 0.5 and r["evidence"] == []
        if r["evidence"]:
            assert {e["label"] for e in r["evidence"]} <= {0, 1} and r["evidence"][0]["cosine"] <= 1 + 1e-9


def test_labelled_toxic_documents_and_their_copies_are_rejected(spark):
    docs = corpus_pipeline.table(spark, SMALL, "documents")
    labels = corpus_pipeline.table(spark, SMALL, "labels").filter(corpus_pipeline.fold("doc_id", 5) != 0)
    toxic = {r["doc_id"] for r in labels.filter("toxic = 1").join(docs, "doc_id", "left_semi").collect()}
    copies = docs.filter(docs["doc_id"].isin(toxic)).withColumn("doc_id", docs["doc_id"] + 1_000_000)
    kept = {r["doc_id"] for r in corpus_pipeline.without_toxic(spark, docs.unionByName(copies), SMALL).collect()}
    assert toxic and not kept & (toxic | {d + 1_000_000 for d in toxic})


def test_every_word_of_the_examples_is_a_term(spark):
    docs, labels = corpus(insulted, 4)
    documents, labelled = frames(spark, docs, labels, "toxic")
    model = toxicity.train(documents, labelled)
    assert set(model.terms) == {w for _, t in docs for w in toxicity.term_counts(t)}


def test_documents_that_share_long_words_stay_examples(spark):
    footer = " supercalifragilistic extraordinarily unmistakeable"
    docs = [(i, f"word{i} here{footer}") for i in range(40)] + [(40, "one more"), (41, "one more"), (42, "one more"), (42, "other words"), (43, None)]
    documents, labelled = frames(spark, docs, [(i, i % 2) for i in range(40)] + [(40, 1), (41, 1), (42, 0), (43, 0)], "toxic")
    rows = toxicity.sample(documents, labelled.toDF("_id", "label"), "doc_id", "text").collect()
    ids = sorted(r["_id"] for r in rows)
    assert ids == [*range(41), 42, 43]


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(3)
    features, bounds = draw.normal(size=(7, quality.FEATURES)), np.array([0, 2, 3, 7])
    labels, network = np.array([1.0, 0.0, 1.0]), quality.Network.fresh(np.zeros(quality.FEATURES), np.ones(quality.FEATURES))

    def loss():
        p = network.forward(features, bounds)["score"]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).sum()

    state = network.forward(features, bounds)
    assert np.allclose(np.add.reduceat(state["attention"], bounds[:-1]), 1)
    for name, gradient in network.gradients(state, state["score"] - labels).items():
        weight = network.weights[name]
        at = tuple(draw.integers(0, n) for n in weight.shape)
        before = weight[at]
        weight[at] = before + 1e-6
        up = loss()
        weight[at] = before - 1e-6
        down = loss()
        weight[at] = before
        assert gradient[at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-6), name


def test_passages_cover_the_whole_text():
    texts = ["one two two THREE!! 4", None, "", " \n ", "é " * 70, "ab " * 10_000]
    features, bounds = quality.encode(pa.array(texts, pa.string()))
    assert np.diff(bounds).tolist() == [1, 1, 1, 1, 2, 157] and features.shape[1] == quality.FEATURES
    mean, _, distinct, most, bare, count = features[0, -6:]
    assert np.allclose([mean * 10, distinct, most, bare], [(3 + 3 + 3 + 7 + 1) / 5, 4 / 5, 2 / 5, 1 / 5])
    assert not features[1].any() and np.allclose(np.expm1(features[bounds[5]:, -1] * 5).sum(), 10_000)
    together, _ = quality.encode(pa.array(texts[::-1], pa.string()))
    assert np.allclose(together[-1], features[0])


def test_long_texts_have_passages_of_one_length(monkeypatch):
    draw = random.Random(5)
    texts = ["", None, " \n "] + [" ".join(draw.choice(["ab", "C!", "foo12", "é"]) for _ in range(n)) for n in (1, 64, 65, 20_000)]
    column = pa.array(texts, pa.string())
    network = quality.Network.fresh(np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    features, bounds = quality.encode(column)
    expected = network.forward(features, bounds)
    assert np.diff(bounds).tolist() == [1, 1, 1, 1, 1, 2, 313]
    own, labels = np.arange(7), np.array([0, 1, 0, 1, 0, 1, 0.0])
    whole = network.learnt(features, bounds, own, labels, np.full(7, 1 / 7))
    monkeypatch.setattr(quality, "SLICE_BYTES", 2_000)
    monkeypatch.setattr(quality, "SLICE_PASSAGES", 50)
    parts = list(quality.encode_slices(column))
    _, scores, attention, place = network.score(parts, len(texts))
    assert len(parts) > 10 and np.array_equal(np.concatenate([p[0] for p in parts]), features)
    assert np.allclose(scores, expected["score"]) and np.allclose(attention, expected["attention"])
    assert np.array_equal(np.searchsorted(place, np.arange(len(texts) + 1)), bounds)
    sliced = network.learnt(features, bounds, own, labels, np.full(7, 1 / 7))
    assert all(np.allclose(sliced[name], gradient) for name, gradient in whole.items())


@pytest.mark.parametrize("trained", [True, False])
def test_every_passage_of_a_long_document_is_weighed(spark, trained):
    documents, _ = frames(spark, [(1, "fine words here " * 2_000)], [], "quality")
    model = quality.Network.fresh(np.zeros(quality.FEATURES), np.ones(quality.FEATURES)) if trained else 0.5
    assert len(quality.score(documents, model).first()["attention"]) == 94


def test_garbled_documents_are_found(spark):
    docs, labels = corpus(garbled, 2)
    docs += CORNERS + [(None, docs[0][1]), (1, docs[1][1])]
    documents, labelled = frames(spark, docs, [(d, 1 - y) for d, y in labels] + [(None, 1), (5, None)], "quality")
    network = quality.train(documents, labelled.filter("doc_id < 100 OR doc_id IS NULL"))
    rows = quality.score(documents, network).collect()
    assert len(rows) == len(docs) and rows[0]["row"].__fields__ == documents.columns
    assert all(0 <= r["score"] <= 1 and sum(r["attention"]) == pytest.approx(1, abs=1e-4) for r in rows)
    truth = dict(labels)
    right = [(r["score"] < 0.5) == bool(truth[r["row"]["doc_id"]]) for r in rows if (r["row"]["doc_id"] or 0) in range(100, 150)]
    assert np.mean(right) >= 0.95


@pytest.mark.parametrize("operator, name", [(toxicity, "toxic"), (quality, "quality")])
def test_without_labels_or_documents(spark, operator, name):
    documents, labelled = frames(spark, [(1, "some words"), (2, None)], [(1, 1), (2, 1)], name)
    unlabelled = operator.train(documents, labelled.limit(0))
    assert [r["score"] for r in operator.score(documents, unlabelled).collect()] == [0.5, 0.5]
    one_class = operator.train(documents, labelled)
    assert all(r["score"] > 0.9 for r in operator.score(documents, one_class).collect())
    assert operator.score(documents.limit(0), one_class).count() == 0
    assert operator.score(documents.limit(0), operator.train(documents.limit(0), labelled)).count() == 0


def test_toxicity_with_ids_that_are_text(spark):
    docs = [(f"d{i}", "kind words of a calm day " + str(i % 7)) for i in range(40)] + [(f"t{i}", "vile rotten words " + str(i % 5)) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    labels = spark.createDataFrame([(d, int(d[0] == "t")) for d, _ in docs], "doc_id string, toxic int")
    found = toxicity.score(frame, toxicity.train(frame, labels), keep=["doc_id"]).collect()
    assert all((r["score"] >= 0.5) == (r["row"]["doc_id"][0] == "t") for r in found)
    assert all(isinstance(e["doc_id"], str) for r in found for e in r["evidence"])


def test_quality_sample_is_bounded_in_rows(spark, monkeypatch):
    """A third of all rows share one labelled id: the driver still gets EXAMPLES rows of a class at most."""
    monkeypatch.setattr(quality, "EXAMPLES", 5)
    docs = [(i, f"plain words of document {i} " * 9) for i in range(20)] + [(3, f"copy {i} of a text " * 7) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(20)], "doc_id bigint, quality int")
    held = []
    real = quality.written
    monkeypatch.setattr(quality, "written", lambda df, name: held.append(out := real(df, name)) or out)
    quality.train(frame, labels)
    assert held[0].count() == 10
