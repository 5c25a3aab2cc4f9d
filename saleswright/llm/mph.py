"""A minimal perfect hash over distinct 64-bit hashes, as a cascade of bit arrays.

Each level maps the keys left over to a bit array about twice their number. A key alone
at its place sets its bit and is done; the others go on to the next level. The number of
set bits before a key's bit is its slot, so n keys get the slots 0 to n - 1. Keys that were
not in the build set may get any slot or -1; the caller compares a stored key or
fingerprint.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
LEVELS = 48


def mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """A good 64-bit mix of each hash with a salt (the splitmix64 finaliser)."""
    add = np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = hashes + add
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalPerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = []
        start = 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(start + np.cumsum(counts) - counts)
            start += int(counts.sum())
        self.size = start

    @classmethod
    def build(cls, hashes: np.ndarray) -> MinimalPerfectHash:
        """From distinct hashes; repeated ones raise."""
        left = np.asarray(hashes, dtype=np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("the hashes of a minimal perfect hash must be distinct")
        levels = []
        for level in range(LEVELS):
            if not len(left):
                break
            words = (GAMMA * len(left) + 63) // 64
            place = (mixed(left, level) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(place, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            left = left[~alone[place]]
        if len(left):
            raise ValueError("the hashes could not be separated")
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1 where no level has its bit."""
        hashes = np.asarray(hashes, dtype=np.uint64)
        out = np.full(len(hashes), -1, dtype=np.int64)
        open_at = np.arange(len(hashes))
        for level, words in enumerate(self.levels):
            if not len(open_at):
                break
            place = mixed(hashes[open_at], level) % np.uint64(len(words) * 64)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            found = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot = self.before[level][word] + np.bitwise_count(below)
            out[open_at[found]] = slot[found]
            open_at = open_at[~found]
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype="<u4")
        return sizes.tobytes() + b"".join(w.astype("<u8").tobytes() for w in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> MinimalPerfectHash:
        count = int(np.frombuffer(data, "<u4", 1)[0])
        at, levels = 4 + 4 * count, []
        for size in np.frombuffer(data, "<u4", count, 4).tolist():
            levels.append(np.frombuffer(data, "<u8", size, at).astype(np.uint64))
            at += 8 * size
        return cls(levels)
