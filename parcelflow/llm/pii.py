"""Personal data in texts: mail and network addresses, card and phone numbers.

Complete forms are found by patterns and checks. Beyond them a skip-chain random field labels the tokens with
digits or an @: a shortened or disguised form is ambiguous by itself, but a link to the complete form elsewhere in
the document carries that form's kind over. The field is trained on documents whose complete forms are known by
the patterns and into which shortened ones were put: those of their own forms as positive cases, altered ones of
other documents as negative cases.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.shared import chosen, map_batches, texts_as_str
from parcelflow.llm.skip_chain import Graph, SkipChain
from parcelflow.llm.tokens import blocks

KINDS = ("email", "ip", "card", "phone")
#: Labels of tokens: outside, then for each kind the first token of a span and the further ones.
LABEL_KINDS = [0, 1, 1, 2, 2, 3, 3, 4, 4]

#: Bounds of the sample for training: documents, and characters of each.
EXAMPLES, EXAMPLE_CHARS = 500, 8_000
#: Tokens that are inferred at once; a document is not cut.
GRAPH_TOKENS = 20_000
LEAST_PROBABILITY = 0.5

# The patterns of complete forms. A run that no match can leave is taken whole.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TELLING = re.compile(r"[0-9@]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
LEADING = re.compile(r"[^A-Za-z0-9+(]*+")
DISGUISED_AT = re.compile(r"[\[({]at[\])}]", re.I)
NOT_ALNUM = re.compile(r"[^a-z0-9]+")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, number of the kind from 0, end


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def is_octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, least = text.find("@"), 0
    while at >= 0:
        # characters of a local part stand right before the @, after the last match and the last @
        start = least + len(text[least:at].rstrip(LOCAL))
        host = HOST.match(text, at + 1) if start < at else None
        least = host.end() if host else at + 1
        if host:
            yield start, least
        at = text.find("@", least)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        if text.count(".", run.start(), run.end()) < 3:
            continue
        parts, at = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(map(is_octet, four)):
                yield at, at + length
            at += length + 1


def numbers(pattern: re.Pattern, text: str, fewest: int, most: int) -> Iterator[tuple[int, int, str]]:
    for found in pattern.finditer(text):
        digits = NOT_DIGIT.sub("", found.group())
        if fewest <= len(digits) <= most:
            yield found.start(), found.end(), digits


def base_spans(text: str) -> list[Span]:
    """Complete forms by start, then kind; each kind's are leftmost and do not overlap. Time is linear in the text."""
    if not TELLING.search(text):
        return []
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(a, 1, b) for a, b in addresses(text)]
    spans += [(a, 2, b) for a, b, digits in numbers(CARD, text, 14, 19) if passes_luhn(digits)]
    if "+" in text:
        spans += [(a, 3, b) for a, b, _ in numbers(PHONE, text, 10, 15)]
    return sorted(spans)


def tokens(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an @, without the punctuation around them."""
    found = []
    for word in TOKEN.finditer(text):
        a = LEADING.match(text, word.start(), word.end()).end()
        b = word.end()
        opened = text.find("(", a, b) >= 0
        while b > a and not (text[b - 1].isalnum() or (text[b - 1] == ")" and opened)):
            b -= 1
        if b > a and TELLING.search(text, a, b):
            found.append((a, b))
    return found


def shape(word: str) -> str:
    """Digits, small and capital letters by one sign each, with the lengths of digit runs, of the first characters."""
    word = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", word[:48]))
    return re.sub(r"[0-9]+", lambda m: f"<{len(m.group())}>", word)


def features(word: str) -> list[str]:
    digits = NOT_DIGIT.sub("", word)
    groups = [g for g in re.split(r"[^0-9A-Za-z]+", word) if g]
    said = ["any", "shape=" + shape(word), f"digits={min(len(digits), 20)}", "loose=" + re.sub(r"<[0-9]+>", "0", shape(word))]
    if 13 <= len(digits) <= 19 and not re.search("[A-Za-z]", word):
        said.append(f"luhn={passes_luhn(digits)}")
    if len(groups) == 4 and all(g.isdigit() and is_octet(g) for g in groups):
        said.append("octets")
    if "@" in word or DISGUISED_AT.search(word):
        said.append(f"at, dots={min(2, word.partition('@')[2].count('.'))}")
    if len(word) >= 16 and len(groups) == 1 and digits and len(digits) < len(word):
        said.append("mixed")
    if word[0] in "+(":
        said.append("first=" + word[0])
    whole = base_spans(word)
    if whole and whole[0][0] == 0 and whole[0][2] == len(word):
        said.append(f"complete={KINDS[whole[0][1]]}")
    return said


def keys(word: str) -> set[str]:
    """What similar tokens have in common: their letters and digits, the last digits, the side of an @."""
    plain = DISGUISED_AT.sub("@", word.lower())
    local, _, host = plain.partition("@")
    digits = NOT_DIGIT.sub("", word)
    found = {"=" + NOT_ALNUM.sub("", plain), "l" + local}
    if host:
        found.add("h" + host)
    elif "." in plain:
        found.add("h" + plain)
    if len(digits) >= 7:
        found.add("d" + digits[-7:])
    return found


@dataclass
class Document:
    """The tokens of a text with what the field needs; links are pairs of token numbers."""

    places: list[tuple[int, int]]
    features: list[list[str]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]

    @classmethod
    def of(cls, text: str) -> "Document":
        places = tokens(text)
        words = [text[a:b] for a, b in places]
        near = [i for i in range(len(places) - 1) if places[i + 1][0] - places[i][1] == 1]
        said = [features(w) for w in words]
        loose = [s[3] for s in said]
        follows = set(near)
        for i, own in enumerate(said):
            own.append("before " + (loose[i - 1] if i - 1 in follows else "nothing"))
            own.append("after " + (loose[i + 1] if i in follows else "nothing"))
        # tokens that share a key are linked one to the next, so a key of n tokens has n - 1 links
        last: dict[str, int] = {}
        skip = set()
        for i, word in enumerate(words):
            for key in keys(word):
                before = last.get(key)
                if before is not None and not (before + 1 == i and before in follows):
                    skip.add((before, i))
                last[key] = i
        return cls(places, said, [(i, i + 1) for i in near], sorted(skip))


def joined(documents: list[Document], known: dict[str, int]) -> Graph:
    """One graph; features that training has not seen are left out, the first one of a token is always known."""
    at, chain, skip, numbers_, sizes = 0, [], [], [], []
    for d in documents:
        for said in d.features:
            own = [known[f] for f in said if f in known]
            numbers_ += own
            sizes.append(len(own))
        chain += [(a + at, b + at) for a, b in d.chain]
        skip += [(a + at, b + at) for a, b in d.skip]
        at += len(d.places)
    pairs = lambda links: np.array(links, np.int64).reshape(-1, 2).T
    return Graph(np.array(numbers_, np.int64), np.array(sizes, np.int64), pairs(chain), pairs(skip))


@dataclass
class Model:
    known: dict[str, int]
    field: SkipChain

    def label(self, documents: list[Document]) -> list[list[Span]]:
        """Spans of each document by the most probable labels of its tokens."""
        graph = joined(documents, self.known)
        if not len(graph):
            return [[] for _ in documents]
        marginal = self.field.infer(graph)[0]
        best = marginal.argmax(axis=1)
        kind = self.field.kinds
        inside = np.stack([marginal[:, kind == k].sum(axis=1) for k in range(len(KINDS) + 1)], axis=1)
        found, at = [], 0
        for d in documents:
            spans: list[Span] = []
            follows = {b for _, b in d.chain}
            for i, (a, b) in enumerate(d.places):
                label = best[at + i]
                k = int(kind[label])
                if not k or inside[at + i, k] < LEAST_PROBABILITY:
                    continue
                first = label % 2 == 1
                if not first and i in follows and spans and spans[-1][1] == k - 1 and spans[-1][2] == d.places[i - 1][1]:
                    spans[-1] = (spans[-1][0], k - 1, b)
                else:
                    spans.append((a, k - 1, b))
            found.append(spans)
            at += len(d.places)
        return found


def truth(text: str, places: list[tuple[int, int]], planted: list[Span]) -> list[int]:
    """Labels of tokens by the complete forms in the text, those that are complete by themselves, and planted spans."""
    labels = [0] * len(places)
    spans = base_spans(text) + planted
    for i, (a, b) in enumerate(places):
        alone = base_spans(text[a:b])
        if alone and alone[0][0] == 0 and alone[0][2] == b - a:
            labels[i] = 2 * alone[0][1] + 1
    for start, kind, end in spans:
        inside = [i for i, (a, b) in enumerate(places) if start <= a and b <= end]
        for n, i in enumerate(inside):
            labels[i] = 2 * kind + 1 + (n > 0)
    return labels


def shortened(kind: int, form: str, rng: random.Random) -> str:
    """A form that the patterns of complete forms do not find by itself."""
    digits = NOT_DIGIT.sub("", form)
    if kind == 0:
        local, _, host = form.partition("@")
        return rng.choice([f"{local}[at]{host}", f"{local}(at){host}", f"{local}@{host.split('.')[0]}", f"{local} at {host}"])
    if kind == 1:
        return rng.choice(["[.]", "(.)", "-", "_"]).join(form.split("."))
    if kind == 2:
        return rng.choice([".", "/", "_"]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{b}-{c}", f"{a}.{b}.{c}", f"{a}{b}{c}", f"{a} {b} {c}"])


def altered(kind: int, form: str, rng: random.Random) -> str:
    """Another form of the same look."""
    if kind == 1:
        return re.sub("[0-9]+", lambda _: str(rng.randint(0, 255)), form)
    return re.sub("[0-9]", lambda _: str(rng.randint(0, 9)), form)


def insert(text: str, pieces: list[tuple[int, str]], rng: random.Random) -> tuple[str, list[Span]]:
    """Pieces (kind, words) put between words, and where they are."""
    spaces = [m.start() for m in re.finditer(r"(?<=[a-z,.])\x20(?=[A-Za-z])", text)]
    chosen_places = sorted(zip((rng.choice(spaces) for _ in pieces), pieces)) if spaces else [(len(text), p) for p in pieces]
    out, spans, at, length = [], [], 0, 0
    for place, (kind, words) in chosen_places:
        out += [text[at:place], " ", words]
        length += place - at + 1 + len(words)
        spans.append((length - len(words), kind, length))
        at = place
    return "".join([*out, text[at:]]), spans


def training_texts(texts: list[str], seed: int = 3) -> Iterator[tuple[str, list[Span]]]:
    """Each text as it is, with shortened copies of its own forms, and with shortened altered forms of others."""
    rng = random.Random(seed)
    forms = [[(k, t[a:b]) for a, k, b in base_spans(t)] for t in texts]
    everywhere = sorted({f for own in forms for f in own})
    for text, own in zip(texts, forms):
        yield text, []
        if own:
            some = rng.sample(own, min(3, len(own)))
            yield insert(text, [(k, shortened(k, f, rng)) for k, f in some], rng)
        if everywhere:
            # one alone, and one more than once: links between shortened forms alone say nothing
            others = [(k, altered(k, f, rng)) for k, f in rng.choices(everywhere, k=2)]
            yield insert(text, [(k, shortened(k, f, rng)) for k, f in [*others, others[0]]], rng)[0], []


def learn(texts: list[str]) -> Model | None:
    """A field from texts; none where no text has a complete form."""
    documents, labels = [], []
    if not any(map(base_spans, texts)):
        return None
    for text, planted in training_texts(texts):
        d = Document.of(text)
        documents.append(d)
        labels += truth(text, d.places, planted)
    counted: dict[str, int] = {}
    for d in documents:
        for said in d.features:
            for f in said:
                counted[f] = counted.get(f, 0) + 1
    known = {f: i for i, f in enumerate(sorted(f for f, n in counted.items() if n > 2 or f == "any"))}
    field = SkipChain.empty(LABEL_KINDS, len(known))
    field.fit(joined(documents, known), np.array(labels))
    return Model(known, field)


def train(docs: DataFrame, text: str = "text") -> Model | None:
    """A field from at most EXAMPLES different texts that have complete forms by their signs and EXAMPLE_CHARS characters at most."""
    column = F.col(text).cast("string")
    telling = docs.select(column.alias("_text")).filter((F.length("_text") <= EXAMPLE_CHARS) & F.col("_text").rlike(r"@[A-Za-z0-9]|[0-9]\.[0-9]|\+[0-9]|[0-9]{6}"))
    # hashes are drawn first, so that texts travel for the sample alone
    drawn = chosen(telling.select(F.xxhash64("_text").alias("_hash")).distinct(), EXAMPLES, "_hash")
    found = telling.withColumn("_hash", F.xxhash64("_text")).join(F.broadcast(drawn), "_hash").groupBy("_hash").agg(F.min("_text").alias("_text"))
    return learn([r["_text"] for r in found.orderBy("_hash").collect()])


def masked(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if end > at:
            out += [text[at : max(at, start)], f"<{KINDS[kind].upper()}>"]
            at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``base`` and ``spans`` (all), ``masked`` text, and the input's columns ``keep`` (all by default) as a struct ``row``.

    Spans are structs of kind, start and end (code points, end exclusive) by start, then kind. ``base`` holds the
    complete forms; ``spans`` holds them too, and those that the field adds where no base span lies. Whole texts of any
    length count; a null or empty text has no spans and the masked text ''. Repeated rows give repeated results, an
    empty table none. Memory grows with the tokens that hold a digit or @ in the longest document, about 2 KB each.
    """
    keep = docs.columns if keep is None else keep
    inner = [f"_{i}" for i in range(len(keep))]
    listed = "array<struct<kind:string,start:bigint,end:bigint>>"
    schema = ", ".join([f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(inner, keep)] + [f"_base {listed}, _spans {listed}, _masked string"])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def arrow(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in own] for own in spans], kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for block in blocks(batches, len(inner)):
            texts = texts_as_str(block.column(len(inner)))
            base = [base_spans(t) for t in texts]
            spans = [list(b) for b in base]
            waiting, size = {}, 0
            for i, t in enumerate(texts):
                if own is not None and TELLING.search(t):
                    waiting[i] = Document.of(t)
                    size += len(waiting[i].places)
                if waiting and (size >= GRAPH_TOKENS or i + 1 == len(texts)):
                    for j, added in zip(waiting, own.label(list(waiting.values()))):
                        spans[j] = with_added(base[j], added)
                    waiting, size = {}, 0
            yield pa.RecordBatch.from_arrays(
                [*block.columns[: len(inner)], arrow(base), arrow(spans), pa.array([masked(t, s) for t, s in zip(texts, spans)], pa.string())],
                [*inner, "_base", "_spans", "_masked"],
            )

    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner)], F.col(text).cast("string").alias("_text"))
    row = F.struct(*[F.col(n).alias(c) for n, c in zip(inner, keep)])
    return map_batches(rows, work, schema).select(
        F.col("_base").alias("base"), F.col("_spans").alias("spans"), F.col("_masked").alias("masked"), row.alias("row")
    )


def with_added(base: list[Span], added: list[Span]) -> list[Span]:
    """Base spans, and those added that overlap none of them."""
    free, at, reach = [], 0, 0
    for span in added:
        while at < len(base) and base[at][0] < span[2]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= span[0]:
            free.append(span)
    return sorted(base + free)


def listed(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
