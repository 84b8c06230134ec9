"""A minimal perfect hash over distinct 64-bit keys, built and probed with whole arrays.

Level by level, every key left hashes to a bit of a field twice the number of keys left; bits hit
once are set and hold their key, the other keys go on to the next level. The slot of a key is the number
of set bits before its own over all levels. The few keys left after the last level are listed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEVELS = 24


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes (a multiply-xorshift finaliser)."""
    x = keys ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class PerfectHash:
    fields: list[np.ndarray]  # bits of each level, packed
    sizes: list[int]
    ranks: list[np.ndarray]  # set bits before each byte of a level, over all levels
    listed: np.ndarray  # sorted keys without a bit of their own
    first_listed: int

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        fields, sizes, ranks, before = [], [], [], 0
        left = keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = 2 * len(left) + 8
            at = mixed(left, level) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            field = np.packbits(alone, bitorder="little")
            in_byte = np.bitwise_count(field).astype(np.int64)
            fields.append(field)
            sizes.append(size)
            ranks.append(before + np.cumsum(in_byte) - in_byte)
            before += int(in_byte.sum())
            left = left[~alone[at.astype(np.int64)]]
        return cls(fields, sizes, ranks, np.sort(left), before)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that was not among those built gets any slot, or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (field, size, rank) in enumerate(zip(self.fields, self.sizes, self.ranks)):
            at = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            byte, bit = field[at >> 3], (at & 7).astype(np.uint8)
            hit = ((byte >> bit) & 1).astype(bool)
            below = np.bitwise_count(byte & ((np.uint8(1) << bit) - np.uint8(1)))
            found[open_[hit]] = (rank[at >> 3] + below)[hit]
            open_ = open_[~hit]
        if len(self.listed) and len(open_):
            at = np.minimum(np.searchsorted(self.listed, keys[open_]), len(self.listed) - 1)
            hit = self.listed[at] == keys[open_]
            found[open_[hit]] = self.first_listed + at[hit]
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), self.first_listed, len(self.listed), *self.sizes], "<i8")
        return head.tobytes() + b"".join(f.tobytes() for f in self.fields) + self.listed.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, stored: bytes) -> "PerfectHash":
        levels, first, listed = np.frombuffer(stored, "<i8", 3).tolist()
        sizes = np.frombuffer(stored, "<i8", levels, 24).tolist()
        at, before, fields, ranks = 24 + 8 * levels, 0, [], []
        for size in sizes:
            fields.append(np.frombuffer(stored, np.uint8, -(-size // 8), at))
            at += len(fields[-1])
            in_byte = np.bitwise_count(fields[-1]).astype(np.int64)
            ranks.append(before + np.cumsum(in_byte) - in_byte)
            before += int(in_byte.sum())
        return cls(fields, sizes, ranks, np.frombuffer(stored, "<u8", listed, at), first)
