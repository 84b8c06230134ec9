"""Byte-level BPE encoding by an index of pair occurrences, and decoding.

The distinct words of a block of documents lie in one array of symbols. An index maps every mergeable
pair to all its positions; the active ranks are taken in ascending order, each merge is applied at all
positions of its pair at once, and only the lists of the pairs that the merge made are extended.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from parcelflow.llm.shared import map_batches
from parcelflow.llm.tokens import (
    BYTE_LEVEL_PATTERN, TOKENISED_BYTES, Ids, Memory, blocks, byte_level_pieces, ids_of_pieces, is_plain,
)

#: Stands between words, and where a symbol has been merged into the one before it.
BOUNDARY, GONE = -1, -2


def byte_characters() -> list[str]:
    """The character by which byte-level vocabularies write each byte: printable ones stand for
    themselves, the others for the characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PairIndexBpe:
    """A vocabulary file of byte-level BPE and the merging of words under it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        vocab = stored["model"]["vocab"]
        alphabet = byte_characters()
        byte_of = {c: bytes([b]) for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.first_symbol = np.array([vocab[c] for c in alphabet], np.int64)
        self.spelling = [b""] * (max(chain(vocab.values(), self.special.values())) + 1)
        for token, i in vocab.items():
            self.spelling[i] = b"".join(map(byte_of.__getitem__, token))
        for token, i in self.special.items():
            self.spelling[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in stored["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = len(self.spelling)
        keys = self.left * self.width + self.right
        self.rank_order = np.argsort(keys, kind="stable")
        self.sorted_keys = keys[self.rank_order]
        self.memory = Memory()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; -1 where there is no merge."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.sorted_keys) - 1)
        hit = (self.sorted_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank_order[at], -1)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (little-endian unsigned 32-bit)."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1)
        symbols = np.full(int(ends[-1]) + 1, BOUNDARY, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[0] = False
        inside[ends] = False
        symbols[inside] = self.first_symbol[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, len(symbols) + 1)
        before = np.arange(-1, len(symbols) - 1)
        after[-1] = len(symbols) - 1

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def extend(positions: np.ndarray) -> None:
            ranks = self.ranks(symbols[positions], symbols[after[positions]])
            mergeable = ranks >= 0
            ranks, positions = ranks[mergeable], positions[mergeable]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for rank, a, b in zip(ranks[starts[:-1]].tolist(), starts, starts[1:]):
                lists = index.get(rank)
                if lists is None:
                    index[rank] = lists = []
                    heapq.heappush(active, rank)
                lists.append(positions[a:b])

        extend(np.arange(len(symbols) - 1))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            here = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b = self.left[rank], self.right[rank]
            here = here[(symbols[here] == a) & (symbols[after[here]] == b)]
            if a == b:
                here = left_to_right(here, after)
            if not len(here):
                continue
            taken = after[here]
            follow = after[taken]
            symbols[here] = self.merged[rank]
            symbols[taken] = GONE
            after[here] = follow
            before[follow] = here
            extend(np.unique(np.concatenate([before[here], here])))

        left = symbols[symbols != GONE]
        bounds = np.flatnonzero(left == BOUNDARY)
        ids = left.astype("<u4").tobytes()
        starts, stops = ((bounds[:-1] + 1) * 4).tolist(), (bounds[1:] * 4).tolist()
        return [ids[s:e] for s, e in zip(starts, stops)]

    def encode(self, texts: pa.Array) -> Ids:
        """Ids of each text of a block; words met in earlier blocks are not merged again."""
        texts = pc.fill_null(texts, "")
        pieces, counts = byte_level_pieces(texts)
        alone = np.zeros(len(texts), bool)
        for token in self.special:
            alone |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        return ids_of_pieces(
            texts, pieces, counts, self.memory, self._ids_of_pieces, self._ids_alone, alone, skip=1
        )

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes | None]:
        words = [self._words_of_piece(p) if is_plain(p) else None for p in pieces]
        merged = self._merged(w for own in words if own for w in own)
        return [None if own is None else b"".join(map(merged.__getitem__, own)) for own in words]

    def _words_of_piece(self, piece: str) -> list[str]:
        spelled = piece if piece[0] == "\n" else " " + piece
        end = len(spelled) - 1
        # most pieces are one word of letters, perhaps with a mark after it
        if spelled[1:].isalpha() and spelled[0] == " " and piece.isascii():
            return [spelled]
        if spelled[0] == " " and spelled[1:end].isalpha() and spelled.isascii() and spelled[end] in ".,":
            return [spelled[:end], spelled[end]]
        return BYTE_LEVEL_PATTERN.findall(spelled)

    def _merged(self, words: Iterable[str]) -> dict[str, bytes]:
        distinct = list(set(words))
        return dict(zip(distinct, self.merge_words([w.encode() for w in distinct])))

    def _ids_alone(self, text: str) -> bytes:
        """A whole text after a line break, with the strings of special tokens as their ids."""
        ids: list[bytes] = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]:
            if part in self.special:
                ids.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                words = BYTE_LEVEL_PATTERN.findall(part)
                ids.append(b"".join(map(self._merged(words).__getitem__, words)))
        return np.array([self.first_symbol[10]], "<u4").tobytes() + b"".join(ids)

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids spell; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.spelling.__getitem__, ids.tolist())).decode("utf-8", "replace")


def left_to_right(positions: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping pairs of one symbol with itself, those that a scan from the left merges."""
    kept: list[int] = []
    blocked = -1
    for p in np.sort(positions).tolist():
        if p != blocked:
            kept.append(p)
            blocked = int(after[p])
    return np.array(kept, np.int64)


@lru_cache(2)
def vocabulary(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every whole text and the text decoded from them.

    Returns doc_id, ids (binary: little-endian unsigned 32-bit) and decoded (string), one row per input
    row. A null text counts as empty and has no ids; repeated rows give repeated results; an empty table
    gives none; other columns of the input do not pass. The strings of special tokens within a text
    become their ids, as in the library. Documents are encoded in blocks of about ``TOKENISED_BYTES``,
    so a task holds one block (or one longer document) and the words it has seen.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for block in blocks(batches, size_limit=TOKENISED_BYTES):
            ids, bounds = bpe.encode(block.column(1))
            spans = list(zip(bounds.tolist(), bounds[1:].tolist()))
            encoded = pa.array([ids[s:e].tobytes() for s, e in spans], pa.binary())
            decoded = pa.array([bpe.decode(ids[s:e]) for s, e in spans], pa.string())
            yield pa.RecordBatch.from_arrays([block.column(0), encoded, decoded], ["doc_id", "ids", "decoded"])

    kind = dict(docs.dtypes)[doc_id]
    return map_batches(docs.select(doc_id, text), work, f"doc_id {kind}, ids binary, decoded string")
