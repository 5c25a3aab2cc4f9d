"""Cut texts into pre-tokens and encode each distinct one once per worker.

The pre-tokens of a text can be found chunk by chunk when it is cut before single spaces:
a space followed by a non-space always starts a pre-token. Texts in which a space stands
before white space or at the end are matched whole instead. Both give the same pre-tokens.

A slice of texts is cut, its chunks are told apart and their ids are joined in Arrow; Python
sees each chunk of a slice once.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator
from itertools import chain, compress, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Pre-tokens that one worker remembers, and half as many chunks; characters of the longest
# it remembers; characters of text that are cut at once. They bound a worker's memory and
# change no result.
REMEMBERED = 120_000
LONGEST = 48
SLICE_CHARS = 4_000_000

# Marks that are a pre-token of their own where white space follows.
MARKS = tuple(",.;:!?)")

_odd_space = re.compile(r" (?=\s|\Z)")


def _grouped(parts: pa.LargeBinaryArray, edges: np.ndarray) -> pa.LargeBinaryArray:
    """The parts between each two edges as one value."""
    _, offsets, data = parts.buffers()
    starts = np.frombuffer(offsets, np.int64, len(parts) + 1, 8 * parts.offset)[edges]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(starts), data or pa.py_buffer(b"")]
    )


class Remembered:
    """The ids of a bounded number of strings; those not met for longest are forgotten."""

    def __init__(self, most: int):
        self.most = most
        self.place: dict[str, int] = {}
        self.ids = pa.array([], pa.large_binary())
        self.used, self.time = np.empty(0, np.int32), 0

    def places(self, names: list[str]) -> np.ndarray:
        """Where each of distinct names is remembered, or -1."""
        at = np.fromiter(map(self.place.get, names, repeat(-1)), np.int64, len(names))
        self.time += 1
        self.used[at[at >= 0]] = self.time
        return at

    def take(self, places: np.ndarray, names: list[str], ids: pa.Array) -> pa.Array:
        """The ids at places, given those of the names that have none; these are remembered."""
        new = np.flatnonzero(places < 0)
        places[new] = len(self.ids) + np.arange(len(new))
        out = pa.concat_arrays([self.ids, ids]).take(pa.array(places))
        short = [len(name) <= LONGEST for name in names]
        self.place.update(zip(compress(names, short), count(len(self.ids))))
        self.ids = pa.concat_arrays([self.ids, ids.filter(pa.array(short, pa.bool_()))])
        self.used = np.concatenate([self.used, np.full(sum(short), self.time, np.int32)])
        if len(self.place) > self.most:
            kept = np.sort(np.argsort(-self.used, kind="stable")[: self.most * 3 // 4])
            stays = np.zeros(len(self.used), bool)
            stays[kept] = True
            # Names stand in the order of their places.
            self.place = dict(zip(compress(self.place, stays.tolist()), count()))
            self.ids, self.used = self.ids.take(pa.array(kept)), self.used[kept]
        return out


class PretokenEncoder:
    """Turns texts into the ids of their pre-tokens, packed as bytes."""

    def __init__(
        self,
        pattern: str,
        encode: Callable[[list[str]], list[bytes]],
        remembered: int = REMEMBERED,
        slice_chars: int = SLICE_CHARS,
    ):
        self.slice_chars = slice_chars
        self.find = regex.compile(pattern).findall
        self.encode = encode
        # Chunks are named without the space before them.
        self.chunks, self.pieces = Remembered(remembered // 2), Remembered(remembered)

    def _cut(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk that a space stands before.

        Letters are a single pre-token with their space, and so is a mark after them.
        """
        if chunk.isalpha():
            return [" " + chunk]
        if chunk[-1:] in MARKS and chunk[:-1].isalpha():
            return [" " + chunk[:-1], chunk[-1]]
        return self.find(" " + chunk)

    def _of_pieces(self, cut: list[list[str]]) -> pa.Array:
        """The ids of strings that are given as their pre-tokens."""
        told = pa.array(chain.from_iterable(cut), pa.large_string()).dictionary_encode()
        names = told.dictionary.to_pylist()
        places = self.pieces.places(names)
        new = list(compress(names, (places < 0).tolist()))
        ids = pa.array(self.encode(new), pa.large_binary())
        found = self.pieces.take(places, new, ids).take(told.indices)
        return _grouped(found, np.cumsum([0, *map(len, cut)]))

    def _some(self, texts: list[str]) -> list[bytes]:
        # Nothing here makes reference cycles, and looking for them costs a quarter of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collecting:
                gc.enable()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        plain = np.array([not _odd_space.search(text) for text in texts], bool)
        bodies = pa.array([t for t, p in zip(texts, plain, strict=True) if p], pa.large_string())
        cut = pc.split_pattern(bodies, " ")
        edges = cut.offsets.to_numpy().astype(np.int64)
        told = cut.flatten().dictionary_encode()
        at = told.indices.to_numpy().astype(np.int64)
        chunks = told.dictionary.to_pylist()
        places = self.chunks.places(chunks)
        new = list(compress(chunks, (places < 0).tolist()))
        pieces = [self._cut(c) for c in new]
        # No space stands before the first chunk of a text. Other texts are cut whole.
        heads = map(chunks.__getitem__, at[edges[:-1]].tolist())
        pieces += [self.find(next(heads) if p else t) for t, p in zip(texts, plain.tolist(), strict=True)]
        ids = self._of_pieces(pieces)
        first = ids.slice(len(new))
        known = self.chunks.take(places, new, ids.slice(0, len(new)))
        at[edges[:-1]] = len(known) + np.flatnonzero(plain)
        joined = _grouped(pa.concat_arrays([known, first]).take(pa.array(at)), edges)
        own = iter(joined.to_pylist())
        odd = iter(first.filter(pa.array(~plain)).to_pylist())
        return [next(own) if p else next(odd) for p in plain.tolist()]

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """The packed ids of each text; a null text is empty."""
        some, chars = [], 0
        for text in texts:
            some.append(text or "")
            chars += len(some[-1])
            if chars >= self.slice_chars:
                yield from self._some(some)
                some, chars = [], 0
        yield from self._some(some)
