"""Toxicity by the nearest labelled examples under exact cosine of class-weighted TF-IDF.

Examples are a bounded sample of the labelled documents, with every word of theirs. A word weighs
(1 + ln count) * idf * (1 + chi-squared): idf by the documents that have it among all documents, and
chi-squared by how well it tells the classes of the examples apart. The examples lie in blocks of an
inverted index that also keeps, for every term and block, the largest weight: a document's products with
these maxima bound its cosine with every example of a block, and blocks whose bound is below the cosines
already found are not opened. The k nearest are exact. Their votes, weighted by cosine, are turned to a
probability by a logistic curve fitted on votes of examples that were left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from parcelflow.llm.shared import chosen, labelled_texts, map_batches, sampled_texts, texts_as_str
from parcelflow.llm.tokens import blocks

#: Bounds of the sample: examples of each label, and further documents of either.
EXAMPLES, CALIBRATION = 1_500, 2_000
#: Parts of the sample, each voted on by the others, for the curve.
PARTS = 4
NEAREST = 8
BLOCK = 64
#: Terms that more than one of so many examples have are held as rows of 32-bit numbers; what their sums may be off.
DENSE_SHARE, ROUNDING = 16, 1e-5
#: Rows that Spark hands to a worker at a time, and bytes of texts of a block: beside the model they take little.
ROWS, BLOCK_BYTES = 2_000, 2_000_000
WORD = re.compile(r"\w+")


def term_counts(text: str) -> Counter:
    """Words of a whole text in lower case, with their numbers."""
    return Counter(WORD.findall(text.lower()))


@dataclass
class BlockMaxIndex:
    """Examples as unit vectors over terms; postings by (term, block) with the largest weight of each."""

    ids: list[int]
    labels: np.ndarray
    term_first: np.ndarray  # entries of a term: from term_first[t] to term_first[t + 1]
    entry_block: np.ndarray
    entry_max: np.ndarray  # 32 bits, as the weights of postings: they only narrow the choice
    entry_first: np.ndarray  # postings of an entry
    example: np.ndarray
    weight: np.ndarray
    dense_row: np.ndarray  # of a term that many examples have its row in ``dense``, else -1; such a term has no entries
    dense: np.ndarray  # weights of these terms in every example, rounded to 32 bits
    own_first: np.ndarray  # the examples as they are: terms and weights of one after another
    own_term: np.ndarray
    own_weight: np.ndarray
    given: np.ndarray  # weights of the document being searched, by term; zeros in between

    @classmethod
    def build(cls, ids: list[int], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> "BlockMaxIndex":
        # examples that share their heaviest term lie together, which makes the bounds of blocks tight
        heaviest = [int(t[np.argmax(w)]) if len(t) else terms for t, w in vectors]
        order = sorted(range(len(ids)), key=lambda i: (heaviest[i], ids[i]))
        sizes = [len(vectors[i][0]) for i in order]
        example = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
        term = np.concatenate([np.array([], np.int32), *[vectors[i][0] for i in order]]).astype(np.int32)
        weight = np.concatenate([np.array([]), *[vectors[i][1] for i in order]])
        own_term, own_weight = term, weight
        frequent = np.flatnonzero(np.bincount(term, minlength=terms) * DENSE_SHARE > len(order))
        dense_row = np.full(terms, -1, np.int32)
        dense_row[frequent] = np.arange(len(frequent))
        dense = np.zeros((len(frequent), len(order)), np.float32)
        many = dense_row[term] >= 0
        dense[dense_row[term[many]], example[many]] = weight[many]
        term, example, weight = term[~many], example[~many], weight[~many]
        by = np.lexsort((example, term))
        term, example, weight = term[by], example[by], weight[by]
        block = example // BLOCK
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        term_first = np.searchsorted(term[first], np.arange(terms + 1))
        entry_max = np.maximum.reduceat(weight, first) if len(first) else np.array([])
        return cls(
            [ids[i] for i in order],
            np.array([labels[i] for i in order], np.float64),
            term_first.astype(np.int32),
            block[first].astype(np.int32),
            np.nextafter(entry_max.astype(np.float32), np.float32(2)),
            np.append(first, len(term)).astype(np.int32),
            example,
            weight.astype(np.float32),
            dense_row,
            dense,
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            own_term,
            own_weight,
            np.zeros(terms),
        )

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k examples nearest to a unit vector, ties to the earlier; only positive cosines.

        Frequent terms are added up for all examples at once. With what the other terms can add at most in a block,
        these sums tell in which blocks postings must be opened. The examples whose sum then reaches the k-th, less
        what rounding may have cost, are compared by the cosines of their whole vectors.
        """
        n, rows = len(self.ids), self.dense_row[terms]
        if not n:
            return np.array([], np.int64), np.array([])
        frequent = rows >= 0
        sums = (weights[frequent].astype(np.float32) @ self.dense[rows[frequent]]).astype(np.float64) + ROUNDING
        rare = terms[~frequent]
        firsts, stops = self.term_first[rare], self.term_first[rare + 1]
        entries = stretches(firsts, stops)
        if len(entries):
            factor = np.repeat(weights[~frequent], stops - firsts)
            block = self.entry_block[entries]
            most = np.bincount(block, factor * self.entry_max[entries], minlength=-(-n // BLOCK))
            least = np.partition(sums, n - k)[n - k] if n > k else 0.0
            best = np.maximum.reduceat(sums, np.arange(0, n, BLOCK))
            here = np.flatnonzero((best + most + 2 * ROUNDING >= least)[block])
            begin, end = self.entry_first[entries[here]], self.entry_first[entries[here] + 1]
            postings = stretches(begin, end)
            sums += np.bincount(self.example[postings], np.repeat(factor[here], end - begin) * self.weight[postings], minlength=n)
        least = np.partition(sums, n - k)[n - k] if n > k else 0.0
        left = np.flatnonzero((sums + 2 * ROUNDING >= least) & (sums > 0))
        begin, end = self.own_first[left], self.own_first[left + 1]
        own = stretches(begin, end)
        self.given[terms] = weights
        products = self.given[self.own_term[own]] * self.own_weight[own]
        self.given[terms] = 0
        cosines = np.bincount(np.repeat(np.arange(len(left)), end - begin), products, minlength=len(left))
        left, cosines = left[cosines > 0], cosines[cosines > 0]
        found = np.lexsort((left, -cosines))[:k]
        return left[found], cosines[found]


def stretches(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    sizes = stops - starts
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


@dataclass
class Model:
    terms: dict[str, int]
    weights: np.ndarray  # of a word that occurs once
    index: BlockMaxIndex
    prior: float  # share of label 1 among labelled documents
    id_type: DataType  # of the examples' ids
    slope: float = 0.0
    offset: float = 0.0

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = np.fromiter(map(self.terms.get, counts, repeat(-1)), np.int64, len(counts))
        met = terms >= 0
        return unit(terms[met], np.fromiter(counts.values(), np.float64, len(counts))[met], self.weights)

    def vote(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of label 1 among the neighbours by cosine, drawn to the prior by a tenth of a neighbour."""
        places, cosines = self.index.nearest(terms, weights, k)
        share = (cosines @ self.index.labels[places] + 0.1 * self.prior) / (cosines.sum() + 0.1)
        return float(share), places, cosines

    def probability(self, share: float) -> float:
        return 1 / (1 + np.exp(-(self.slope * share + self.offset)))

    def judge(self, counts: Counter, k: int) -> tuple[float, np.ndarray, np.ndarray]:
        """Score, and the neighbours' places and cosines; a copy of examples, word by word, has their mean label."""
        share, places, cosines = self.vote(*self.vector(counts), k)
        same = places[cosines >= 1 - 1e-9]
        if len(same) and all(w in self.terms for w in counts):
            return float(self.index.labels[same].mean()), places, cosines
        return self.probability(share), places, cosines


def unit_vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return unit(np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.float64, len(counts)), idf)


def unit(terms: np.ndarray, numbers: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms in order and their weights (1 + ln count) * idf (or another weight of the term), of length 1."""
    order = np.argsort(terms)
    terms = terms[order]
    weights = (1 + np.log(numbers[order])) * idf[terms]
    return terms, weights / np.sqrt(weights @ weights) if len(terms) else weights


def class_weights(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """idf * (1 + chi-squared) of every term, by the examples of each label that have it (Yates's correction)."""
    term = np.concatenate([np.array([], np.int32), *[v[0] for v in vectors]]).astype(np.int32)
    toxic = np.repeat(labels, [len(v[0]) for v in vectors])
    a = np.bincount(term, toxic, minlength=len(idf))
    b = np.bincount(term, 1 - toxic, minlength=len(idf))
    n, n1, n0 = len(labels), labels.sum(), len(labels) - labels.sum()
    off = np.maximum(np.abs(a * (n0 - b) - b * (n1 - a)) - n / 2, 0)
    return idf * (1 + n * off**2 / np.maximum((a + b) * (n - a - b) * n1 * n0, 1))


def fit_curve(shares: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, with the targets of the classes drawn in (Platt)."""
    n1, n0 = weights @ labels, weights @ (1 - labels)
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([shares, np.ones(len(shares))])
    fitted = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ fitted))
        gradient = x.T @ (weights * (p - target)) + 1e-3 * fitted * [1, 0]
        curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(curvature, gradient)
        fitted -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return (float(fitted[0]), float(fitted[1])) if fitted[0] >= 0 else (0.0, float(np.log((n1 + 1) / (n0 + 1))))


def hand_over_few(spark: SparkSession) -> None:
    """Let this session hand ROWS rows to a worker at a time, if it handed over more."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS:
        spark.conf.set(name, ROWS)


def sample(docs: DataFrame, labelled: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Term counts of the sampled documents: _id, label, role (0 example, 1 curve), terms, counts.

    Copies would pass off the words of one document as those of many: of equal texts with equal labels the
    one with the smallest id can be drawn, and of a repeated id one text.
    """
    labelled = labelled_texts(docs, labelled, doc_id, text).groupBy("label", "_hash").agg(F.min("_id").alias("_id"))
    spare = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4)) == 0  # a quarter of the labelled documents is left for the curve
    examples = [chosen(labelled.filter(~spare & (F.col("label") == y)), EXAMPLES, "_id").withColumn("role", F.lit(0)) for y in (0, 1)]
    curve = chosen(labelled.filter(spare), CALIBRATION, "_id").withColumn("role", F.lit(1))
    ids = examples[0].unionByName(examples[1]).unionByName(curve)
    texts = sampled_texts(docs, ids, doc_id, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [term_counts(t) for t in texts_as_str(batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([list(c) for c in counted], pa.list_(pa.string())),
                    pa.array([list(c.values()) for c in counted], pa.list_(pa.int64())),
                ],
                ["_id", "label", "role", "terms", "counts"],
            )

    kind = dict(docs.dtypes)[doc_id]
    return map_batches(
        texts.select("_id", "label", "role", "_text"),
        work,
        f"_id {kind}, label int, role int, terms array<string>, counts array<bigint>",
    )


def document_frequencies(docs: DataFrame, terms: dict[str, int], text: str) -> tuple[int, np.ndarray]:
    """The number of all documents, and of those with each term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = shared.value, 0
        found = np.zeros(len(known), np.int64)
        for block in blocks(batches, 0, BLOCK_BYTES):
            rows += block.num_rows
            for t in texts_as_str(block.column(0)):
                found[[known[w] for w in set(WORD.findall(t.lower())) if w in known]] += 1
        seen = np.flatnonzero(found)
        numbers = [np.append(seen, -1), np.append(found[seen], rows)]  # term -1: documents
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()) for n in numbers], ["term", "n"])

    counted = map_batches(docs.select(F.col(text).cast("string").alias("_text")), work, "term bigint, n bigint")
    sums = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(terms) + 1, np.int64)
    total[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return int(total[-1]), total[:-1]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from labelled documents: at most EXAMPLES of each label and CALIBRATION others, with all their words.

    ``labels`` has doc_id and a 0/1 column; rows without either are left out, a document labelled both
    ways counts as 1. Without examples of both labels there are no terms, and every score is the prior
    (0.5 without any labels).
    """
    labelled = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
        .filter("_id IS NOT NULL AND label IN (0, 1)").groupBy("_id").agg(F.max("label").alias("label"))
    )
    kind = docs.schema[doc_id].dataType
    hand_over_few(docs.sparkSession)
    share = labelled.agg(F.avg("label").alias("prior")).first()["prior"]
    prior = 0.5 if share is None else float(share)
    rows = sample(docs, labelled, doc_id, text).toArrow().sort_by([("_id", "ascending"), ("role", "ascending")])
    ids = rows["_id"].to_pylist()
    known = rows["label"].to_numpy().astype(np.float64)
    if not 0 < known.sum() < len(known):
        nothing = BlockMaxIndex.build([], [], [], 0)
        return Model({}, np.array([]), nothing, prior, kind, offset=float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    ends = np.cumsum(pc.list_value_length(rows["terms"]).to_numpy())
    coded = pa.chunked_array(pc.list_flatten(rows["terms"]).chunks, pa.string()).combine_chunks().dictionary_encode()
    terms = {w: i for i, w in enumerate(coded.dictionary.to_pylist())}
    numbers = pc.list_flatten(rows["counts"]).to_numpy().astype(np.int32)
    vectors = list(zip(np.split(coded.indices.to_numpy().astype(np.int32), ends[:-1]), np.split(numbers, ends[:-1])))
    del rows, coded, numbers
    number, df = document_frequencies(docs, terms, text)
    idf = np.log((1 + number) / (1 + df)) + 1

    def of(own: np.ndarray) -> Model:
        weights = class_weights([vectors[i] for i in own], known[own], idf)
        units = [unit(*vectors[i], weights) for i in own]
        index = BlockMaxIndex.build([ids[i] for i in own], [int(known[i]) for i in own], units, len(terms))
        return Model(terms, weights, index, prior, kind)

    # the parts hold each label in equal numbers
    shuffled = np.random.default_rng(7).permutation(len(ids))
    part = np.empty(len(ids), np.int64)
    part[shuffled[np.argsort(known[shuffled], kind="stable")]] = np.arange(len(ids)) % PARTS
    shares = np.empty(len(ids))
    for p in range(PARTS):
        others = of(np.flatnonzero(part != p))
        for i in np.flatnonzero(part == p):
            shares[i] = others.vote(*unit(*vectors[i], others.weights), NEAREST)[0]
        del others
    model = of(np.arange(len(ids)))
    # the sample's labels count as in all labels
    weights = np.where(known > 0, prior / known.mean(), (1 - prior) / (1 - known.mean()))
    model.slope, model.offset = fit_curve(shares, known, weights)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, k: int = NEAREST) -> DataFrame:
    """score (0 to 1), evidence, and the input's columns ``keep`` (all by default) as a struct ``row``, one row per input row.

    The score is the probability of label 1; ``evidence`` lists the nearest examples: doc_id, cosine,
    label. A text without known terms, an empty or a null one, has no neighbours and the score of such
    texts. Whole texts count, however long; ids may be of any type. Of equally near examples those count that come
    first in the index (by heaviest term, then id). Repeated rows give repeated results; an empty table gives none.
    """
    keep = docs.columns if keep is None else keep
    hand_over_few(docs.sparkSession)
    inner = [f"_{i}" for i in range(len(keep))]
    types = [docs.schema[c].dataType.simpleString() for c in keep]
    schema = ", ".join([f"{n} {t}" for n, t in zip(inner, types)] + ["_score double", f"_evidence array<struct<doc_id:{model.id_type.simpleString()},cosine:double,label:int>>"])
    shape = pa.list_(pa.struct([("doc_id", to_arrow_type(model.id_type)), ("cosine", pa.float64()), ("label", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for block in blocks(batches, len(inner), BLOCK_BYTES):
            scores, evidence = [], []
            for t in texts_as_str(block.column(len(inner))):
                value, places, cosines = own.judge(term_counts(t), k)
                scores.append(value)
                evidence.append([
                    {"doc_id": own.index.ids[p], "cosine": c, "label": int(own.index.labels[p])}
                    for p, c in zip(places.tolist(), cosines.tolist())
                ])
            yield pa.RecordBatch.from_arrays(
                [*block.columns[: len(inner)], pa.array(scores, pa.float64()), pa.array(evidence, shape)], [*inner, "_score", "_evidence"]
            )

    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner)], F.col(text).cast("string").alias("_text"))
    scored = map_batches(rows, work, schema)
    row = F.struct(*[F.col(n).alias(c) for n, c in zip(inner, keep)])
    return scored.select(F.col("_score").alias("score"), F.col("_evidence").alias("evidence"), row.alias("row"))
