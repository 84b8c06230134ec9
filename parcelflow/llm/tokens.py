"""Token ids of the ``tokenizers`` library, with each distinct piece of text encoded once per block.

A block of texts is cut into pieces that the tokenizer treats independently of their neighbours. The
distinct pieces that the worker has not met yet are encoded by the library, and the ids of a text are
those of its pieces in order. Pieces of byte-level tokenizers begin with the one space or line break
before a word; a text with other white space, or several in a row, is encoded by itself.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from parcelflow.llm.shared import give_back

#: Distinct pieces that a worker remembers (about 50 bytes each); beyond them it forgets the long ones, which recur least.
REMEMBERED = 1_000_000
SHORT = 8

#: Signs that no splitting pattern keeps with the letters before them, and how many runs of them a worker remembers.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
MARKS = 100_000

#: Texts of a block, in bytes; tokenising holds some fifty times as many for a while and takes smaller blocks.
BLOCK_BYTES = 8_000_000
TOKENISED_BYTES = 2_000_000

#: Fixed value: the pattern by which byte-level BPE splits text before its merges.
BYTE_LEVEL_PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Separators that Arrow's white space has and the tokenizers' patterns do not.
CONTROL_SEPARATORS = "[\x1c-\x1f]"

Ids = tuple[np.ndarray, np.ndarray]  # all ids of a block, and where those of each text begin and end


def blocks(batches, column: int = 1, size_limit: int = BLOCK_BYTES):
    """The rows of record batches in blocks of about ``size_limit`` bytes of texts; a longer text is a block of its own."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, batch.num_rows * size_limit // max(size_limit, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            held.append(part)
            size += part.column(column).nbytes
            if size >= size_limit:
                yield joined(held)
                held, size = [], 0
                give_back()
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class Memory:
    """Pieces met by this worker and their ids, as arrays; ``sizes`` is -1 for a piece without ids of its own."""

    def __init__(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.ids = np.array([], "<u4")
        self.starts = np.array([], np.int64)
        self.sizes = np.array([], np.int64)

    def add(self, pieces: pa.Array, ids: list[bytes | None]) -> None:
        sizes = np.fromiter((-1 if i is None else len(i) // 4 for i in ids), np.int64, len(ids))
        held = np.maximum(sizes, 0)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(held) - held])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(i or b"" for i in ids), "<u4")])
        self.pieces = pa.concat_arrays([self.pieces, pieces])

    def forget_long(self) -> None:
        """Thin out a memory that has grown too large."""
        if len(self.pieces) <= REMEMBERED:
            return
        kept = pc.less_equal(pc.utf8_length(self.pieces), SHORT).to_numpy(zero_copy_only=False)
        if kept.sum() > REMEMBERED // 2:
            self.__init__()
            return
        starts, held = self.starts[kept], np.maximum(self.sizes[kept], 0)
        self.ids = self.ids[spread(starts, held)]
        self.pieces, self.sizes = self.pieces.filter(pa.array(kept)), self.sizes[kept]
        self.starts = np.cumsum(held) - held

    def places(self, pieces: pa.Array, encode: Callable[[list[str]], list[bytes | None]]) -> np.ndarray:
        """Where each of the distinct pieces lies; those not met before are encoded and added."""
        at = pc.index_in(pieces, value_set=self.pieces)
        new = pc.is_null(at)
        found = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        fresh = pieces.filter(new)
        if len(fresh):
            found[found < 0] = len(self.pieces) + np.arange(len(fresh))
            self.add(fresh, encode(fresh.to_pylist()))
        return found


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of several stretches, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def byte_level_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of each text as if a line break stood before it, and their number.

    A word comes without the space before it, a word after a line break with the break.
    """
    led = pc.binary_join_element_wise(pa.scalar("\n"), texts, "")
    cut = pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " ")
    counts = np.diff(cut.offsets.to_numpy())
    pieces = cut.flatten()
    first = np.zeros(len(pieces), bool)
    first[np.cumsum(counts) - counts] = True  # the empty piece before the break
    return pieces.filter(pa.array(~first)), counts - 1


def is_plain(piece: str) -> bool:
    """Whether a byte-level piece is one word, perhaps after one line break, so that neighbours do not matter."""
    word = piece[1:] if piece[:1] == "\n" else piece
    return word.split() == [word]


def ids_of_pieces(
    texts: pa.Array,
    pieces: pa.Array,
    counts: np.ndarray,
    memory: Memory,
    encode: Callable[[list[str]], list[bytes | None]],
    ids_alone: Callable[[str], bytes],
    alone: np.ndarray,
    skip: int = 0,
) -> Ids:
    """Ids of texts from those of their pieces, without the first ``skip`` ids of a text.

    Texts marked ``alone``, and those with a piece that has no ids of its own, are encoded whole.
    """
    memory.forget_long()
    coded = pieces.dictionary_encode()
    chosen = memory.places(coded.dictionary, encode)[coded.indices.to_numpy()]
    ids, starts, sizes = memory.ids, memory.starts, memory.sizes
    row = np.repeat(np.arange(len(counts)), counts)
    alone = alone | (counts == 0)
    alone[row[sizes[chosen] < 0]] = True
    if alone.any():
        # such a text becomes one piece of its own
        own = np.flatnonzero(alone)
        whole = [np.frombuffer(ids_alone(texts[int(i)].as_py()), "<u4") for i in own]
        lengths = np.fromiter(map(len, whole), np.int64, len(whole))
        starts = np.concatenate([starts, len(ids) + np.cumsum(lengths) - lengths])
        ids = np.concatenate([ids, *whole])
        kept = ~alone[row]
        places = np.concatenate([row[kept], own])
        both = np.concatenate([chosen[kept], len(sizes) + np.arange(len(own))])
        sizes = np.concatenate([sizes, lengths])
        chosen = both[np.argsort(places, kind="stable")]
        counts = np.where(alone, 1, counts)
    length = sizes[chosen]
    found = ids[spread(starts[chosen], length)]
    bounds = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])]
    if skip:
        found = np.delete(found, (bounds[:-1, None] + np.arange(skip)).ravel())
        bounds = bounds - skip * np.arange(len(bounds))
    return found, bounds


class Encoder:
    """A vocabulary file and the pieces that this worker has encoded with it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memory = Memory()
        self.marks: dict[str, bytes] = {}

    def by_library(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def word(self, word: str) -> list[int]:
        """Ids of a word of letters, which no pattern splits, by the merges alone."""
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def encode_new(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of distinct pieces.

        A word of ASCII letters and the signs after it are encoded apart by every splitting pattern used here;
        each word and each run of signs is encoded once. All other pieces go to the library together.
        """
        found: list[bytes | None] = [None] * len(pieces)
        words: dict[str, bytes] = {}
        others: list[int] = []
        texts: list[str] = []
        for i, piece in enumerate(pieces):
            stem = piece.rstrip(SIGNS)
            if stem.isascii() and stem.isalpha():
                ids = words.get(stem)
                if ids is None:
                    ids = words[stem] = as_bytes(self.word(self.written(stem)))
                found[i] = ids if len(stem) == len(piece) else ids + self.signs(piece[len(stem) :])
            else:
                spelled = self.spelled(piece)
                if spelled is not None:
                    others.append(i)
                    texts.append(spelled)
        for i, coded in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found[i] = as_bytes(coded.ids)
        return found

    def signs(self, run: str) -> bytes:
        ids = self.marks.get(run)
        if ids is None:
            ids = as_bytes(self.by_library(run))
            if len(self.marks) < MARKS:
                self.marks[run] = ids
        return ids


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class ByteLevelEncoder(Encoder):
    """For tokenizers that keep white space and attach one space to the word after it."""

    def __init__(self, path: str):
        super().__init__(path)
        (self.line_break,) = self.by_library("\n")

    def written(self, word: str) -> str:
        return "\u0120" + word  # the byte-level character of the space before it

    def spelled(self, piece: str) -> str | None:
        if not is_plain(piece):
            return None
        return piece if piece[0] == "\n" else " " + piece

    def encode(self, texts: pa.Array) -> Ids:
        texts = pc.fill_null(texts, "")
        pieces, counts = byte_level_pieces(texts)
        alone = np.zeros(len(texts), bool)
        return ids_of_pieces(texts, pieces, counts, self.memory, self.encode_new, self.alone, alone, skip=1)

    def alone(self, text: str) -> bytes:
        """A whole text, after the line break that every text here begins with."""
        return as_bytes([self.line_break, *self.by_library(text)])


class WordEncoder(Encoder):
    """For tokenizers that drop white space and lower-case words."""

    def written(self, word: str) -> str:
        return word.lower()

    def spelled(self, piece: str) -> str:
        return piece

    def encode(self, texts: pa.Array) -> Ids:
        texts = pc.fill_null(texts, "")
        cut = pc.utf8_split_whitespace(texts)
        alone = pc.match_substring_regex(texts, CONTROL_SEPARATORS).to_numpy(zero_copy_only=False)
        counts = np.diff(cut.offsets.to_numpy()).astype(np.int64)
        return ids_of_pieces(texts, cut.flatten(), counts, self.memory, self.encode_new, self.alone, alone)

    def alone(self, text: str) -> bytes:
        return as_bytes(self.by_library(text))


@lru_cache(4)
def encoder(path: str, byte_level: bool) -> Encoder:
    """The encoder of a vocabulary file; a worker opens it once."""
    return ByteLevelEncoder(path) if byte_level else WordEncoder(path)
