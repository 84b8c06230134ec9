"""Finding secrets in texts with DataFrame functions only.

Three kinds have fixed patterns. Beyond them, tokens long enough to be keys are scored by two character
Markov models, one of random strings and one of ordinary identifiers: the log-likelihood ratio of a
token tells how much more likely the first makes it. The models are counted from labelled samples; the
table of ratios has one entry per pair of characters and is part of the query's expressions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.shared import chosen

# The patterns and least lengths of the base kinds, in the order in which they are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# runs long enough are the matches of HEX that fit, since it takes every run whole
HEX_RUN = HEX.replace("+", f"{{{LEAST['hex']},}}")

#: Tokens that the models score, and characters that they tell apart (all others count as one).
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
WIDTH = len(ALPHABET) + 1
#: A token is a secret if its log-likelihood ratio is at least this: odds of 1 in 10,000 turned round.
LEAST_RATIO = math.log(10_000)

#: Different characters in a token that may be a secret.
LEAST_DISTINCT = 8

#: Bounds of the labelled samples: documents whose words and base secrets are used, and random strings added.
SAMPLE_DOCS, RANDOM_STRINGS = 2_000, 2_000

#: Matches whose positions are summed up at a time.
BLOCK = 256

MARK = "[SECRET]"
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def running(numbers: Column) -> Column:
    """0 and the running sums of an array."""
    return F.aggregate(
        numbers, F.array(F.lit(0)), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
    )


def sums_before(numbers: Column) -> Column:
    """For each element of a non-empty array the sum of those before it, in blocks, so that long arrays are not copied per element."""
    starts = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int"))
    blocks = F.transform(starts, lambda b: running(F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))))
    bases = running(F.transform(blocks, lambda sums: F.element_at(sums, -1)))
    placed = F.zip_with(
        blocks,
        F.slice(bases, F.lit(1), F.size(blocks)),
        lambda sums, base: F.transform(F.slice(sums, F.lit(1), F.size(sums) - 1), lambda s: s + base),
    )
    return F.flatten(placed)


def spans(text: Column, pattern: str, matches: Column, kind: str, rank: int, fits: Column) -> Column:
    """start, rank, end, kind of the matches of a pattern that fit (an array of booleans), in code points."""
    # between the matches lie the pieces of a split by the same pattern
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    lengths = F.transform(matches, F.length)
    before = sums_before(F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), lengths, lambda g, n: g + n))
    starts = F.zip_with(before, F.slice(gaps, F.lit(1), F.size(matches)), lambda b, g: b + g)
    ends = F.zip_with(starts, lengths, lambda s, n: s + n)
    both = F.arrays_zip(starts.alias("start"), ends.alias("end"), fits.alias("fits"))
    found = F.transform(
        F.filter(both, lambda x: x["fits"]),
        lambda x: F.struct(
            x["start"].cast("int").alias("start"), F.lit(rank).alias("rank"), x["end"].cast("int").alias("end"), F.lit(kind).alias("kind")
        ),
    )
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(SPANS))


def matches(text: Column) -> dict[str, Column]:
    """All matches of each base pattern, too short ones among them; for assign also their values."""
    return {
        "_assign": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)),
        "_value": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
        "_access": F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        "_hex": F.regexp_extract_all(text, F.lit(HEX_RUN), F.lit(0)),
    }


def base_spans() -> Column:
    """Spans of the base kinds, from the columns that matches() gives and _text."""
    text = F.col("_text")

    def of(kind: str, pattern: str, rank: int, measured: str) -> Column:
        fits = F.transform(F.col(measured), lambda m: F.length(m) >= LEAST[kind])
        return spans(text, pattern, F.col(f"_{kind}"), kind, rank, fits)

    return F.concat(
        of("assign", ASSIGN, 0, "_value"), of("access", ACCESS, 1, "_access"), of("hex", HEX_RUN, 2, "_hex")
    )


def samples(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Labelled samples (sample, secret): base secrets and random strings against words of ordinary text.

    At most SAMPLE_DOCS documents, chosen by a hash of their id, and RANDOM_STRINGS strings.
    """
    ids = chosen(docs.select(F.col(doc_id).alias("_id")).filter("_id IS NOT NULL").distinct(), SAMPLE_DOCS, "_id")
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(ids), "_id")
    found = texts.select("_text", *[c.alias(n) for n, c in matches(F.col("_text")).items()])
    secret = found.select(F.explode(F.concat("_value", "_access", "_hex")).alias("sample")).filter("length(sample) >= 16")
    words = reduce(lambda t, p: F.regexp_replace(t, p, " "), (ASSIGN, ACCESS, HEX_RUN), F.col("_text"))
    ordinary = texts.select(F.explode(F.regexp_extract_all(words, F.lit(r"[A-Za-z][A-Za-z0-9_-]{5,}"), F.lit(0))).alias("sample"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = docs.sparkSession.range(RANDOM_STRINGS).select(
        F.when(F.col("id") % 2 == 0, F.substring(F.base64(F.unhex(digest)), 1, 40)).otherwise(F.substring(digest, 1, 40)).alias("sample")
    )
    labelled = secret.unionByName(random).select("sample", F.lit(1).alias("secret"))
    return labelled.unionByName(ordinary.select("sample", F.lit(0).alias("secret")))


def codes(token: Column) -> Column:
    """Numbers of the characters of a token; 0 stands for its start and for other characters."""
    own = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.concat(F.array(F.lit(0)), own)


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character after each other one, from samples (sample, secret).

    Steps are counted with one added to each. Null and empty samples count nothing; without any samples all
    ratios are 0. The counts collected are at most two per pair of characters.
    """
    coded = labelled.filter("length(sample) > 0").select("secret", codes(F.col("sample")).alias("_c"))
    steps = coded.select(
        "secret", F.explode(F.transform(F.sequence(F.lit(1), F.size("_c") - 1), lambda i: F.get("_c", i - 1) * WIDTH + F.get("_c", i))).alias("step")
    )
    counts = [[1] * (WIDTH * WIDTH) for _ in range(2)]
    for row in steps.groupBy("secret", "step").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["secret"]][row["step"]] += row["n"]
    rows = [[sum(c[a * WIDTH : (a + 1) * WIDTH]) for a in range(WIDTH)] for c in counts]
    return [
        math.log(counts[1][s] / rows[1][s // WIDTH]) - math.log(counts[0][s] / rows[0][s // WIDTH])
        for s in range(WIDTH * WIDTH)
    ]


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token under the two models."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    own = codes(token)
    steps = F.zip_with(F.slice(own, F.lit(1), F.size(own) - 1), F.slice(own, F.lit(2), F.size(own) - 1), lambda a, b: a * WIDTH + b)
    return F.aggregate(steps, F.lit(0.0), lambda sum_, step: sum_ + F.get(table, step))


def scanned(docs: DataFrame, model: list[float], text: str, least_ratio: float) -> DataFrame:
    """The input rows as ``_row`` with their text and spans: ``_text``, ``_base`` and ``_all``, each in order."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    found = rows.select("*", *[c.alias(n) for n, c in matches(F.col("_text")).items()])
    based = found.select(
        "_row", "_text", F.array_sort(base_spans()).alias("_base"), F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0)).alias("_tokens")
    )
    # runs of a few characters are no random strings, however rare they are in words
    varied = lambda t: F.size(F.array_distinct(F.split(t, ""))) >= LEAST_DISTINCT
    likely = F.transform("_tokens", lambda t: varied(t) & (ratio(t, model) >= least_ratio))
    markov = spans(F.col("_text"), CANDIDATE, F.col("_tokens"), "markov", 3, likely)
    apart = F.filter(markov, lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return based.select("_row", "_text", "_base", F.array_sort(F.concat("_base", apart)).alias("_all"))


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", least_ratio: float = LEAST_RATIO
) -> DataFrame:
    """Secrets of every whole text: doc_id, base and spans (arrays of start, rank, end, kind), one row per input row.

    ``base`` has the spans of the three patterns, ``spans`` also those of kind ``markov``: candidate tokens
    that overlap no base span, have LEAST_DISTINCT different characters, and whose ratio is at least ``least_ratio``. Positions are code points, ends
    exclusive; spans are in order of start, then kind. ``labelled`` (sample, secret 0/1) trains the models;
    by default the samples are taken from the documents. A null text counts as empty and has no spans;
    repeated rows give repeated results; an empty table gives none; other columns do not pass.
    """
    model = train(samples(docs, doc_id, text) if labelled is None else labelled)
    return scanned(docs.select(doc_id, text), model, text, least_ratio).select(
        F.col(f"_row.{doc_id}").alias("doc_id"), F.col("_base").alias("base"), F.col("_all").alias("spans")
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows, all columns, with each secret in the text replaced by MARK; overlapping ones by one.

    Texts without secrets pass as they are, null ones among them.
    """
    model = train(samples(docs, doc_id, text) if labelled is None else labelled)
    found = scanned(docs, model, text, LEAST_RATIO)
    whole = F.col("_text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        clear = F.substr(whole, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(span["end"], state["at"]).alias("at"),
            F.when(inside, state["parts"]).otherwise(F.concat(state["parts"], F.array(clear, F.lit(MARK)))).alias("parts"),
        )

    masked = F.aggregate(
        "_all", start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(whole, s["at"] + 1, F.length(whole) - s["at"]))
    )
    kept = F.when(F.size("_all") == 0, F.col(f"_row.{text}")).otherwise(masked)
    return found.select(*[(kept if c == text else F.col(f"_row.{c}")).alias(c) for c in docs.columns])


def listed(array: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
