"""A cuckoo filter over 128-bit keys, with inserts in bulk and deletions."""

from __future__ import annotations

import numpy as np

from saleswright.llm.mph import mixed

SLOTS = 4
LOAD = 0.8
ROUNDS = 500


class Full(Exception):
    """The filter has no room for the keys; a larger one must be built."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a fingerprint may stand in one of two buckets.

    Keys are given as two 64-bit halves. Only keys that were inserted may be deleted.
    """

    def __init__(self, table: np.ndarray):
        self.table = table  # one row per bucket, 0 for an empty slot
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2").astype(np.uint16).reshape(-1, SLOTS))

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @staticmethod
    def prints(low: np.ndarray) -> np.ndarray:
        """Fingerprints from 1 to 65535."""
        return (low.astype(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def first(self, high: np.ndarray) -> np.ndarray:
        return high.astype(np.uint64) & self.mask

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ mixed(prints.astype(np.uint64), 7)) & self.mask

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        prints, here = self.prints(low), self.first(high)
        there = self.other(here, prints)
        own = prints[:, None]
        return (self.table[here] == own).any(1) | (self.table[there] == own).any(1)

    def insert(self, high: np.ndarray, low: np.ndarray) -> None:
        """All keys, or none and ``Full``."""
        table, random = self.table.copy(), np.random.default_rng(len(high))
        prints = self.prints(low)
        at = self.first(high)
        for turn in range(ROUNDS):
            if not len(prints):
                self.table = table
                return
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            new = np.concatenate([[True], at[1:] != at[:-1]])
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            used = (table[at] != 0).sum(1)
            fits = used + place < SLOTS
            # Free slots are always the last ones of a bucket.
            table[at[fits], (used + place)[fits]] = prints[fits]
            prints, at, place = prints[~fits], at[~fits], (used + place - SLOTS)[~fits]
            if turn and len(prints):
                # The first that is left over in a bucket takes a slot; its holder moves on.
                kick = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                slot = random.integers(0, SLOTS, len(kick))
                held = table[at[kick], slot]
                table[at[kick], slot] = prints[kick]
                prints[kick] = held
            at = self.other(at, prints)
        raise Full

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        self.table = self.table.copy()
        prints, here = self.prints(low), self.first(high)
        there = self.other(here, prints)
        for own, *places in zip(prints.tolist(), here.tolist(), there.tolist(), strict=True):
            for bucket in places:
                row = self.table[bucket].tolist()
                if own in row:
                    row.remove(own)
                    self.table[bucket] = [*row, 0]
                    break
            else:
                raise KeyError("a key that is not in the filter cannot be deleted")
