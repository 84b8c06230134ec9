"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages that cover its whole text. Every passage is encoded by what its
characters and words look like; a learnt layer embeds it, learnt gated attention weighs the passages of a
document against each other, and the weighted embedding is classified. Only documents have labels; the
network finds by itself which passages decide them. It is trained on a bounded sample, on the driver;
all documents are scored where they lie.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.shared import chosen, labelled_texts, map_batches, sampled_texts, written
from parcelflow.llm.tokens import blocks

#: Words of a passage.
PASSAGE_WORDS = 64
#: Bytes of a slice by which long texts are encoded, and passages by which a group of documents is learnt.
SLICE_BYTES, SLICE_PASSAGES = 4_000_000, 50_000
#: Bound of the sample: labelled documents of each class.
EXAMPLES = 1_500
HIDDEN, ATTENTION = 24, 16
EPOCHS, BAGS, RATE, DECAY = 40, 64, 5e-3, 1e-4

#: Class of each byte: lower case, upper case, digit, bytes of other scripts, each ASCII mark by itself, the rest.
BYTE_CLASS = np.array(
    [0 if chr(b).islower() else 1 if chr(b).isupper() else 2 if chr(b).isdigit() else b - 33 + 5 if 33 <= b < 127 else 4 for b in range(128)]
    + [3] * 128
)
CLASSES = 5 + 94
MARKS = np.unique(BYTE_CLASS)  # classes that occur
FEATURES = len(MARKS) + 6


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of each text, and where those of each text begin and end.

    Every passage has PASSAGE_WORDS words, the last one of a text fewer. Per passage: square roots of the shares of the byte classes, mean and spread of word lengths, shares of
    distinct words, of the most frequent word, and of words without letters, and the logarithm of their
    number. A text without words is one passage of zeros.
    """
    stored = pc.fill_null(texts.cast(pa.large_binary()), b"")
    sizes = pc.binary_length(stored).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b" ".join(stored.to_pylist()) + b" ", np.uint8)
    bounds = np.cumsum(sizes + 1)  # the space after each text
    spaces = (data == 32) | ((data >= 9) & (data <= 13))
    dark = np.flatnonzero(~spaces)
    starts = dark[np.diff(dark, prepend=-2) > 1]
    word_ends = np.searchsorted(starts, bounds)
    words = np.diff(word_ends, prepend=0)
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    ends = np.cumsum(passages)
    text = np.repeat(np.arange(len(words)), words)
    passage = (ends - passages)[text] + (np.arange(len(starts)) - (word_ends - words)[text]) // PASSAGE_WORDS
    n = int(ends[-1]) if len(ends) else 0

    word = np.searchsorted(starts, dark, side="right") - 1
    kinds = BYTE_CLASS[data[dark]]
    counts = np.bincount(passage[word] * CLASSES + kinds, minlength=n * CLASSES).reshape(n, CLASSES)[:, MARKS]
    shares = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))

    size = np.bincount(word, minlength=len(starts)).astype(np.float64)
    letters = np.bincount(word, (kinds <= 1) | (kinds == 3), minlength=len(starts))
    per = np.bincount(passage, minlength=n)
    safe = np.maximum(per, 1)
    mean = np.bincount(passage, size, minlength=n) / safe
    spread = np.sqrt(np.maximum(np.bincount(passage, size**2, minlength=n) / safe - mean**2, 0))
    # a hash of each word: its bytes weighted by their place in it
    if len(starts):
        place = np.uint64(0x9E3779B97F4A7C15) * (dark - starts[word] + 1).astype(np.uint64)
        mixed = (place ^ (place >> np.uint64(29))) * (data[dark].astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        named = np.add.reduceat(mixed, np.flatnonzero(np.diff(word, prepend=-1)))
    else:
        named = np.array([], np.uint64)
    order = np.lexsort((named, passage))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (named[order][1:] != named[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    first = np.flatnonzero(fresh)
    distinct = np.bincount(passage[order][first], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, passage[order][first], np.diff(np.append(first, len(order))).astype(np.float64))
    rest = [mean / 10, spread / 10, distinct / safe, most / safe, np.bincount(passage, letters == 0, minlength=n) / safe, np.log1p(per) / 5]
    return np.column_stack([shares, *rest]).astype(np.float32), np.concatenate([[0], ends])


#: PASSAGE_WORDS words, each with the white space after it.
PASSAGE = re.compile(rb"[ \t-\r]*(?:[^ \t-\r]+[ \t-\r]+){%d}" % PASSAGE_WORDS)


def slices(text: bytes) -> Iterator[bytes]:
    """A text in parts of whole passages, of SLICE_BYTES or little more unless a passage is longer."""
    at = start = 0
    while len(text) - start > SLICE_BYTES and (found := PASSAGE.match(text, at)):
        at = found.end()
        if at - start >= SLICE_BYTES:
            yield text[start:at]
            start = at
    if start < len(text) or not text:
        yield text[start:]


def encode_slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features of the passages of all texts, their bounds, and the text of each bag: long texts come in several bags."""
    held, place, size = [], [], 0
    for i, text in enumerate(pc.fill_null(texts, "").cast(pa.large_binary())):
        for part in slices(text.as_py()):
            if held and size + len(part) > 2 * SLICE_BYTES:
                yield *encode(pa.array(held, pa.large_binary())), np.array(place)
                held, place, size = [], [], 0
            held.append(part)
            place.append(i)
            size += len(part)
    if held:
        yield *encode(pa.array(held, pa.large_binary())), np.array(place)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Embedding, gated attention and classifier; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, mean: np.ndarray, scale: np.ndarray, seed: int = 7) -> "Network":
        draw = np.random.default_rng(seed)
        shapes = {"embed": (FEATURES, HIDDEN), "tanh": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION), "attend": (ATTENTION,), "out": (HIDDEN,)}
        weights = {name: draw.normal(0, shape[0] ** -0.5, shape) for name, shape in shapes.items()}
        return cls(mean, scale, weights | {"embed_bias": np.zeros(HIDDEN), "out_bias": np.zeros(1)})

    def forward(self, features: np.ndarray, bounds: np.ndarray | None) -> dict[str, np.ndarray]:
        w = self.weights
        x = (features - self.mean) / self.scale
        hidden = np.tanh(x @ w["embed"] + w["embed_bias"])
        tanh, gate = np.tanh(hidden @ w["tanh"]), sigmoid(hidden @ w["gate"])
        raw = (tanh * gate) @ w["attend"]
        state = {"x": x, "hidden": hidden, "tanh": tanh, "gate": gate, "raw": raw}
        return state if bounds is None else state | self.pooled(raw, hidden, bounds)

    def pooled(self, raw: np.ndarray, hidden: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        bag = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        e = np.exp(raw - np.maximum.reduceat(raw, bounds[:-1])[bag])
        attention = e / np.add.reduceat(e, bounds[:-1])[bag]
        pooled = np.add.reduceat(attention[:, None] * hidden, bounds[:-1])
        score = sigmoid(pooled @ w["out"] + w["out_bias"])
        return {"bag": bag, "attention": attention, "pooled": pooled, "score": score}

    def score(self, parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pooled embeddings and scores of n documents, and the raw attention and document of every passage.

        Documents come in parts: bags of passages and the document of each bag. Of each document only the
        largest raw attention, the sum of its weights and the weighted embedding are held, so that no
        number of passages is too large.
        """
        top, total, summed = np.full(n, -np.inf), np.zeros(n), np.zeros((n, HIDDEN))
        raws, places = [], []
        for features, bounds, document in parts:
            state = self.forward(features, None)
            place = np.repeat(document, np.diff(bounds))
            before = top.copy()
            np.maximum.at(top, place, state["raw"])
            seen = before > -np.inf
            shrink = np.ones(n)
            shrink[seen] = np.exp(before[seen] - top[seen])
            e = np.exp(state["raw"] - top[place])
            total = total * shrink + np.bincount(place, e, minlength=n)
            summed *= shrink[:, None]
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            np.add.at(summed, place[starts], np.add.reduceat(e[:, None] * state["hidden"], starts))
            raws.append(state["raw"])
            places.append(place)
        pooled = summed / total[:, None]
        raw, place = np.concatenate([[], *raws]), np.concatenate([np.array([], np.int64), *places])
        attention = np.exp(raw - top[place]) / total[place]
        return pooled, sigmoid(pooled @ self.weights["out"] + self.weights["out_bias"]), attention, place

    def gradients(self, s: dict[str, np.ndarray], error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the loss; ``error`` is its derivative by each document's output before the sigmoid."""
        w = self.weights
        to_pooled = error[:, None] * w["out"]
        to_attention = (s["hidden"] * to_pooled[s["bag"]]).sum(axis=1)
        centred = to_attention - (s["pooled"] * to_pooled).sum(axis=1)[s["bag"]]
        to_raw = s["attention"] * centred
        to_tanh = to_raw[:, None] * w["attend"] * s["gate"] * (1 - s["tanh"] ** 2)
        to_gate = to_raw[:, None] * w["attend"] * s["tanh"] * s["gate"] * (1 - s["gate"])
        to_hidden = s["attention"][:, None] * to_pooled[s["bag"]] + to_tanh @ w["tanh"].T + to_gate @ w["gate"].T
        to_embed = to_hidden * (1 - s["hidden"] ** 2)
        return {
            "embed": s["x"].T @ to_embed, "embed_bias": to_embed.sum(axis=0), "tanh": s["hidden"].T @ to_tanh,
            "gate": s["hidden"].T @ to_gate, "attend": (s["tanh"] * s["gate"]).T @ to_raw, "out": s["pooled"].T @ error,
            "out_bias": np.array([error.sum()]),
        }

    def learnt(self, features: np.ndarray, bounds: np.ndarray, own: np.ndarray, labels: np.ndarray, shares: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of a group of documents, by slices of SLICE_PASSAGES when it has more passages."""
        sizes = bounds[own + 1] - bounds[own]
        rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in own])
        if len(rows) <= SLICE_PASSAGES:
            state = self.forward(features[rows], np.concatenate([[0], np.cumsum(sizes)]))
            return self.gradients(state, (state["score"] - labels) * shares)
        bag = np.repeat(np.arange(len(own)), sizes)
        cuts = [slice(at, at + SLICE_PASSAGES) for at in range(0, len(rows), SLICE_PASSAGES)]
        pooled, score, attention, _ = self.score(((features[rows[c]], np.arange(len(bag[c]) + 1), bag[c]) for c in cuts), len(own))
        error, total = (score - labels) * shares, {}
        for c in cuts:
            state = self.forward(features[rows[c]], None) | {"bag": bag[c], "attention": attention[c], "pooled": pooled}
            for name, gradient in self.gradients(state, error).items():
                # those of the last layer come from the whole documents each time
                total[name] = gradient + (0 if name in ("out", "out_bias") else total.get(name, 0))
        return total

    def fit(self, features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, importance: np.ndarray, seed: int = 7) -> None:
        """Adam on the weighted cross-entropy, over shuffled groups of BAGS documents."""
        draw = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        steps = 0
        for _ in range(EPOCHS):
            order = draw.permutation(len(labels))
            for at in range(0, len(order), BAGS):
                own = order[at : at + BAGS]
                gradients = self.learnt(features, bounds, own, labels[own], importance[own] / importance[own].sum())
                steps += 1
                for name, gradient in gradients.items():
                    gradient = gradient + DECAY * self.weights[name]
                    m, v = moments[name]
                    m += 0.1 * (gradient - m)
                    v += 0.001 * (gradient**2 - v)
                    self.weights[name] -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Network | float:
    """A network from at most EXAMPLES labelled documents of each class, weighted to the classes' shares.

    ``labels`` has doc_id and a 0/1 column; rows without either are left out, a document labelled both
    ways counts as 1, and of documents that share an id one text counts. Without documents of both classes the result is a constant score: the share of label
    1, or 0.5 without labels.
    """
    labelled = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
        .filter("_id IS NOT NULL AND label IN (0, 1)").groupBy("_id").agg(F.max("label").alias("label"))
    )
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    known = labelled_texts(docs, labelled, doc_id, text)
    ids = chosen(known.filter("label = 0"), EXAMPLES, "_id").unionByName(chosen(known.filter("label = 1"), EXAMPLES, "_id"))
    texts = sampled_texts(docs, ids, doc_id, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            bags = [bytearray() for _ in range(batch.num_rows)]
            for features, bounds, document in encode_slices(batch.column(1)):
                for i, a, b in zip(document, bounds, bounds[1:]):
                    bags[i] += features[a:b].astype("<f4").tobytes()
            bags = [bytes(b) for b in bags]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bags, pa.binary())], ["_id", "label", "bag"])

    kind = dict(docs.dtypes)[doc_id]
    rows = map_batches(texts.select("_id", "_text", "label"), work, f"_id {kind}, label int, bag binary")
    # the driver holds the passages in a file, and in memory those of a group
    with tempfile.TemporaryFile() as file:
        known, lengths = [], []
        for r in written(rows, "quality-sample").orderBy("_id", "bag").toLocalIterator():
            known.append(float(r["label"]))
            lengths.append(len(r["bag"]) // (4 * FEATURES))
            file.write(r["bag"])
        file.flush()
        known = np.array(known)
        if not 0 < known.sum() < len(known):
            total = sum(sizes.values())
            return sizes.get(1, 0) / total if total else 0.5
        features = np.memmap(file, "<f4", "r", shape=(sum(lengths), FEATURES))
        return fitted(features, np.concatenate([[0], np.cumsum(lengths)]), known, sizes)


def fitted(features: np.ndarray, bounds: np.ndarray, known: np.ndarray, sizes: dict[int, int]) -> Network:
    """A network from the passages of labelled documents; ``sizes`` has the number of all labels of each class."""
    parts = [features[at : at + SLICE_PASSAGES] for at in range(0, len(features), SLICE_PASSAGES)]
    mean = sum(p.sum(axis=0, dtype=np.float64) for p in parts) / len(features)
    variance = sum(((p - mean) ** 2).sum(axis=0) for p in parts) / len(features)
    network = Network.fresh(mean, np.sqrt(variance) + 1e-2)
    share = np.where(known > 0, sizes[1] / known.sum(), sizes[0] / (len(known) - known.sum()))
    network.fit(features, bounds, known, share / share.mean())
    return network


def score(docs: DataFrame, model: Network | float, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """score (0 to 1), attention, and the input's columns ``keep`` (all by default) as a struct ``row``, one row per input row.

    ``attention`` has the weight of each passage of the text. A null or empty text is one passage without
    words. Repeated rows give repeated results, an empty table gives none.
    """
    keep = docs.columns if keep is None else keep
    inner = [f"_{i}" for i in range(len(keep))]
    types = [docs.schema[c].dataType.simpleString() for c in keep]
    schema = ", ".join([f"{n} {t}" for n, t in zip(inner, types)] + ["_score double", "_attention array<float>"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, len(inner)):
            parts = encode_slices(block.column(len(inner)))
            if isinstance(model, Network):
                _, scores, attention, place = model.score(parts, block.num_rows)
                bounds = np.searchsorted(place, np.arange(block.num_rows + 1))
            else:
                passages = np.zeros(block.num_rows, np.int64)
                for _, within, document in parts:
                    np.add.at(passages, document, np.diff(within))
                bounds = np.concatenate([[0], np.cumsum(passages)])
                scores, attention = np.full(block.num_rows, model), np.repeat(1 / passages, passages)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(attention.astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*block.columns[: len(inner)], pa.array(scores), lists], [*inner, "_score", "_attention"])

    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner)], F.col(text).cast("string").alias("_text"))
    scored = map_batches(rows, work, schema)
    row = F.struct(*[F.col(n).alias(c) for n, c in zip(inner, keep)])
    return scored.select(F.col("_score").alias("score"), F.col("_attention").alias("attention"), row.alias("row"))
