"""Literal lookups as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def translate(code: Column | str, names: dict[str, str]) -> Column:
    """Name of a code; unknown or null codes give null."""
    code = F.col(code) if isinstance(code, str) else code
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])[code]


def classify(text: Column | str, words: dict[str, str], other: str) -> Column:
    """Class of the first word contained in the text, ignoring case; null is ``other``."""
    text = F.lower(text)
    hits = [F.when(text.contains(word), F.lit(label)) for word, label in words.items()]
    return F.coalesce(*hits, F.lit(other))
