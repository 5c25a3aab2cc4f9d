"""Sharding by a keyed permutation of row numbers (operator 4).

All rows get a number in a given order. A Feistel network over the pairs (left, right)
with left below a and right below b, where a * b is the first such product not below the
number of rows, permutes the numbers; numbers that land outside are permuted again (cycle
walking) until they land inside. The permuted number p gives shard p mod n and slot p div n,
so shard sizes differ by one row at most and slots have no gaps. Both directions are a
computation: the row behind a shard and slot is found without any table.

Rows stay as they are, null values, empty texts and repeated rows too; equal rows are
interchangeable. Null keys come first in the order. An empty table gives an empty table.
Existing columns named like the results are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import fresh, numbered
from saleswright.llm.mph import mixed

ROUNDS = 8


class FeistelPermutation:
    """A permutation of 0 .. n - 1 that n and a seed fix."""

    def __init__(self, n: int, seed: int):
        self.n = n
        self.a = max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.b = max(1, -(-n // self.a))
        self.keys = [(seed * ROUNDS + r) & 0x7FFFFFFF for r in range(ROUNDS)]

    def _round(self, half: np.ndarray, key: int, size: int) -> np.ndarray:
        return (mixed(half.astype(np.uint64), key) % np.uint64(size)).astype(np.int64)

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x % self.a, x // self.a
        for r, key in enumerate(self.keys):
            if r % 2 == 0:
                left = (left + self._round(right, key, self.a)) % self.a
            else:
                right = (right + self._round(left, key, self.b)) % self.b
        return right * self.a + left

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x % self.a, x // self.a
        for r in reversed(range(ROUNDS)):
            if r % 2 == 0:
                left = (left - self._round(right, self.keys[r], self.a)) % self.a
            else:
                right = (right - self._round(left, self.keys[r], self.b)) % self.b
        return right * self.a + left

    def _walk(self, x, step) -> np.ndarray:
        out = step(np.asarray(x, dtype=np.int64))
        while (outside := out >= self.n).any():
            out[outside] = step(out[outside])
        return out

    def forward(self, x) -> np.ndarray:
        return self._walk(x, self._once)

    def inverse(self, x) -> np.ndarray:
        return self._walk(x, self._back)


def shard_rows(
    df: DataFrame, order: list[str], n_shards: int, seed: int = 0, rows: int | None = None
) -> DataFrame:
    """Add ``row_number``, ``shard`` and ``slot`` to every row.

    ``order`` should name a key; rows that tie there are ordered by where they were read.
    Columns that the shards need not carry should be dropped before, as rows are sorted.
    """
    names = [c for c in df.columns if c.lower() not in ("row_number", "shard", "slot")]
    placed = numbered(df.select(*(df[c] for c in names)), order)
    n = placed.count() if rows is None else rows
    permutation = FeistelPermutation(n, seed)

    def permuted(number: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(number.to_numpy()))

    at = fresh(placed.columns, "permuted")
    return (
        placed.withColumn(at, F.pandas_udf(permuted, "long")("row_number"))
        .withColumn("shard", F.pmod(F.col(at), F.lit(n_shards)).cast("int"))
        .withColumn("slot", F.floor(F.col(at) / F.lit(n_shards)).cast("long"))
        .drop(at)
    )


def row_behind(shard: int, slot: int, n_shards: int, rows: int, seed: int = 0) -> int:
    """The row number that ``shard_rows`` put at a shard and slot."""
    return int(FeistelPermutation(rows, seed).inverse(np.array([slot * n_shards + shard]))[0])
