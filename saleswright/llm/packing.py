"""Best-fit packing with swap-based local search (operator 9).

Pieces of tokens are packed into sequences of at most ``capacity`` tokens. Pieces that fill a
sequence alone need no packing. The others are dealt evenly into groups, so that a task
holds a bounded number of lengths, and each group is packed on its own: best fit by falling
length first, then a local search between the sequences that are not full. It takes the
emptiest sequence and moves a piece out, exchanges one piece for a smaller one, two for one or
one for two, always so that the sum of squared fills grows, until the sequence is
empty or nothing helps; then the next emptiest.

Lengths must be 1 to ``capacity``; others raise. Equal lengths, repeated rows and null keys
are placed like any others. An empty table gives an empty table. Existing columns named
like the results are replaced; all others are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import column, fresh
from saleswright.llm.tokenizer import encoder, read_tokenizer
from saleswright.scale import settled

# Pieces that one task packs, about. A group wastes less than one sequence.
GROUP_PIECES = 20_000
GROUP_SHIFT = 32
# Pieces that a task hands on at once.
OUT_ROWS = 2048


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Pieces by number in bins, longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    with_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s: some bin has s free
    for number in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[number]
        fits = spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = with_space[free].pop()
            if not with_space[free]:
                spaces &= ~(1 << free)
            bins[chosen].append(number)
        else:
            free, chosen = capacity, len(bins)
            bins.append([number])
        free -= length
        if free:
            with_space[free].append(chosen)
            spaces |= 1 << free
    return bins


class LocalSearch:
    """Empties bins by moves and exchanges that raise the sum of squared fills."""

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.free = [capacity - sum(lengths[i] for i in own) for own in bins]
        # What a bin could give back for a larger piece: nothing, one piece or two.
        # By the sum given back: the bins that can, and how much they have free.
        self.offers: list[dict[int, int]] = [{} for _ in range(capacity + 1)]
        self.most = np.full(capacity + 1, -1, np.int64)
        for b, free in enumerate(self.free):
            if free:
                self._offer(b)

    def _sums(self, b: int) -> set[int]:
        sizes = [self.lengths[i] for i in self.bins[b]]
        return {0, *sizes, *map(sum, combinations(sizes, 2))}

    def _offer(self, b: int) -> None:
        for given in self._sums(b):
            self.offers[given][b] = self.free[b]
            if self.free[b] > self.most[given]:
                self.most[given] = self.free[b]

    def _withdraw(self, b: int) -> None:
        for given in self._sums(b):
            held = self.offers[given].pop(b, None)
            if held is not None and held == self.most[given]:
                self.most[given] = max(self.offers[given].values(), default=-1)

    def _target(self, source: int, taken: int) -> tuple[int, int] | None:
        """A bin that takes ``taken`` and gives back as little as can be."""
        given = np.arange(taken)
        fits = np.flatnonzero(self.most[:taken] >= taken - given)
        if not len(fits):
            return None
        back = int(fits[0])
        need = taken - back
        # The bin that this leaves fullest, which must get fuller than the source was.
        left, b = min((f, b) for b, f in self.offers[back].items() if f >= need)
        return (b, back) if left - need < self.free[source] else None

    def _given_back(self, b: int, back: int) -> list[int]:
        if not back:
            return []
        own = self.bins[b]
        for i in own:
            if self.lengths[i] == back:
                return [i]
        for i, j in combinations(own, 2):
            if self.lengths[i] + self.lengths[j] == back:
                return [i, j]
        raise AssertionError("an offer without its pieces")

    def _improve(self, source: int) -> bool:
        """One exchange that moves the most tokens out of the emptiest bin."""
        own = self.bins[source]
        options = [(i,) for i in own] + list(combinations(own, 2))
        best = None
        for taken in options:
            size = sum(self.lengths[i] for i in taken)
            found = self._target(source, size) if size <= self.capacity else None
            if found and (len(taken) == 1 or found[1] == 0 or self._is_one(*found)):
                net = size - found[1]
                if best is None or net > best[0]:
                    best = (net, taken, found)
        if best is None:
            return False
        _, taken, (b, back) = best
        returned = self._given_back(b, back)
        self._withdraw(b)
        self.bins[b] = [i for i in self.bins[b] if i not in returned] + list(taken)
        self.bins[source] = [i for i in own if i not in taken] + returned
        self.free[b] -= best[0]
        self.free[source] += best[0]
        if self.free[b]:
            self._offer(b)
        return True

    def _is_one(self, b: int, back: int) -> bool:
        return any(self.lengths[i] == back for i in self.bins[b])

    def run(self) -> list[list[int]]:
        """Try the bins that are not full, the emptiest first, while one could be saved."""
        order = sorted((b for b, f in enumerate(self.free) if f), key=lambda b: -self.free[b])
        space = sum(self.free)
        for source in order:
            if space < self.capacity:
                break
            if not self.free[source]:
                continue
            self._withdraw(source)
            while self.bins[source] and self._improve(source):
                pass
            if not self.bins[source]:
                space -= self.capacity
            elif self.free[source]:
                self._offer(source)
        return [own for own in self.bins if own]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def pack(
    pieces: DataFrame, length: str = "length", capacity: int = 1024, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece.

    Pieces should be narrow: they are written to the shared folder once, and payloads are
    better joined afterwards.
    """
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    at, group, size = (fresh(names, n) for n in ("at", "group", "size"))
    rows = settled(pieces.select(*(column(c) for c in names)))
    rows = rows.withColumn(at, F.monotonically_increasing_id())
    shown = F.coalesce(column(length).cast("string"), F.lit("null"))
    wrong = F.raise_error(F.concat(F.lit("length outside 1 to capacity: "), shown))
    inside = F.coalesce(column(length).between(1, capacity), F.lit(False))
    rows = rows.withColumn(size, F.when(inside, column(length).cast("int")).otherwise(wrong.cast("int")))
    full = rows.filter(F.col(size) == capacity)
    rest = rows.filter(F.col(size) < capacity)
    groups = max(1, math.ceil(rest.count() / group_pieces))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(at, ignore_index=True)
        lengths = pdf[size].tolist()
        sequence, offset = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
        first = int(pdf[group].iloc[0]) << GROUP_SHIFT
        for number, own in enumerate(pack_lengths(lengths, capacity)):
            place = 0
            for i in own:
                sequence[i], offset[i] = first + number, place
                place += lengths[i]
        return pd.DataFrame({at: pdf[at], "sequence_id": sequence, "offset": offset})

    dealt = rest.select(at, size, F.pmod(F.xxhash64(at), F.lit(groups)).alias(group))
    placed = dealt.groupBy(group).applyInPandas(
        packed, f"`{at}` long, sequence_id long, offset long"
    )
    alone = full.select(
        at, (-1 - F.col(at)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return rows.drop(size).join(placed.unionByName(alone), at).drop(at)


def _piece_rows(keys: pa.Array, pieces: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    row, piece, start, length, ids = zip(*pieces, strict=True)
    return pa.record_batch(
        [
            keys.take(pa.array(row, pa.int64())),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(ids, pa.binary()),
        ],
        ["key", "piece", "start", "length", "ids"],
    )


def token_pieces(
    df: DataFrame,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    capacity: int = 1024,
) -> DataFrame:
    """Encode texts, append ``end_id`` and cut what is longer than ``capacity``.

    One row per piece: the key, piece, start, length and ids (packed 32-bit). The first piece
    of a cut document is the shorter one. Null and empty texts are the end id alone.
    """
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(read_tokenizer(tokenizer_file))
    docs = df.select(column(key).alias("key"), column(text).cast("string").alias("text"))
    key_type = docs.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(data.value), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            held: list[tuple[int, int, int, int, bytes]] = []
            for row, packed in enumerate(own.packed_column(batch.column(1))):
                packed += end
                n = len(packed) // 4
                first = n % capacity or min(n, capacity)
                edges = [0, *range(first, n + 1, capacity)]
                for number, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    held.append((row, number, a, b - a, packed[4 * a : 4 * b]))
                if len(held) >= OUT_ROWS:
                    yield _piece_rows(batch.column(0), held)
                    held = []
            if held:
                yield _piece_rows(batch.column(0), held)

    schema = f"key {key_type}, piece int, start long, length long, ids binary"
    return docs.mapInArrow(cut, schema).withColumnRenamed("key", key)
