"""Periodic runs of words by difference-cover LCE (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart are the same) of
at least ``min_length`` words and ``times`` periods, that no neighbouring word extends.

Words become ids, and the documents of a slice one array of ids. Where a run of period q
is, a stretch of words equals the one q further on, so it holds a point of the grid of multiples
of the stretch's least length. For every period all points of its grid are compared with
the word q further on; the grids of all periods have n log n points. A few words on both
sides end nearly all of them. For the rest the length of the common extension (LCE) is
looked up to the right and, in the reversed array, to the left:

* a difference cover names some places of every ``COVER`` words so that any two positions reach named
  places after the same few words;
* only suffixes at named places are sorted, first by blocks of ``COVER`` words and then by doubling;
* the common lengths of neighbours in that order are the leaves of a sparse table, and its range
  minimum is the common length of any two of them.

A task holds one slice, about ``SLICE_BYTES`` of whole texts, at a time; nothing is shuffled. The
suffixes of a slice's documents are sorted only where a point needs them.

Words are what white space of ASCII separates. Null and empty texts have no words and no runs.
Texts of any length are read whole. Repeated rows are judged each for itself. Existing
columns named like the results are replaced and all others kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import column, fresh

# Any two places are the same distance from two places of the cover modulo COVER (fixed values).
COVER, PLACES = 31, np.array([0, 1, 3, 8, 12, 18])
# Text that is worked on at once, and grid points of it.
SLICE_BYTES = 2 * 1024 * 1024
POINTS = 1_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class CommonExtensions:
    """How many words agree from two positions of an array on."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.ids = np.concatenate([ids.astype(np.int32), np.full(2 * COVER, -1, np.int32)])
        self.blocks = np.lib.stride_tricks.sliding_window_view(self.ids, COVER)
        self.place_of = np.full(COVER, -1)
        self.place_of[PLACES] = np.arange(len(PLACES))
        # The place x of the cover for which x + difference is one as well.
        self.meet = np.empty(COVER, np.int64)
        for x in PLACES:
            self.meet[(PLACES - x) % COVER] = x
        rows = -(-n // COVER)
        places = (np.arange(rows)[:, None] * COVER + PLACES).ravel()
        self.places = places[places < n]
        self._sort()

    def _sort(self) -> None:
        m, step = len(self.places), len(PLACES)
        block = np.ascontiguousarray(self.blocks[self.places]).view(f"V{4 * COVER}").ravel()
        levels = [np.unique(block, return_inverse=True)[1].astype(np.int64) + 1]
        while levels[-1].max() < m:
            now = levels[-1]
            after = np.zeros(m, np.int64)
            after[: max(m - step, 0)] = now[step:]
            levels.append(np.unique(now * (m + 1) + after, return_inverse=True)[1] + 1)
            step *= 2
        self.rank = levels[-1] - 1
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        self.table = [self._agreement(order[:-1], order[1:], levels[:-1] or levels)]
        width = 1
        while 2 * width < m:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _agreement(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of neighbouring suffixes: whole blocks by their names, then single words."""
        m, common = len(self.places), np.zeros(len(a), np.int64)
        at, other = a.copy(), b.copy()
        for level in range(len(levels) - 1, -1, -1):
            names = levels[level]
            inside = (at < m) & (other < m)
            same = inside & (names[np.minimum(at, m - 1)] == names[np.minimum(other, m - 1)])
            at[same] += len(PLACES) << level
            other[same] += len(PLACES) << level
            common[same] += COVER << level
        left, right = self.places[a] + common, self.places[b] + common
        return common + (self.blocks[left] != self.blocks[right]).argmax(axis=1)

    def _index(self, position: np.ndarray) -> np.ndarray:
        return position // COVER * len(PLACES) + self.place_of[position % COVER]

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common length for positions whose next ``COVER`` words are known to agree."""
        ahead = (self.meet[(b - a) % COVER] - a) % COVER
        one, two = self.rank[self._index(a + ahead)], self.rank[self._index(b + ahead)]
        low, high = np.minimum(one, two), np.maximum(one, two)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.empty(len(a), np.int64)
        for k in np.unique(level):
            own = level == k
            least[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << k)])
        return ahead + least


def _agreeing(ids: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """Words that agree from ``a`` and ``b`` on, at most ``room`` and ``COVER`` of them."""
    length = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(room > 0)
    for k in range(COVER):
        open_ = open_[ids[a[open_] + way * k] == ids[b[open_] + way * k]]
        length[open_] += 1
        open_ = open_[room[open_] > k + 1]
        if not len(open_):
            break
    return length


def _grid(sizes: np.ndarray, min_length: int, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Document, period, least stretch and place of all grid points, in bounded chunks."""
    tops = np.where(sizes >= min_length, sizes // times, 0)
    docs = np.repeat(np.arange(len(sizes)), tops)
    periods = np.arange(len(docs)) - np.repeat(np.cumsum(tops) - tops, tops) + 1
    least = np.maximum(min_length - periods, (times - 1) * periods)
    points = (sizes[docs] - periods - 1) // least + 1
    total = np.cumsum(points)
    at = 0
    while at < len(docs):
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + POINTS, "right")))
        number = points[at:stop]
        which = np.repeat(np.arange(at, stop), number)
        k = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        yield docs[which], periods[which], least[which], k * least[which]
        at = stop


def find_runs(ids: np.ndarray, starts: np.ndarray, min_length: int, times: int) -> np.ndarray:
    """Rows of start, end and period by start and period; ``starts`` cuts ``ids`` into documents."""
    sizes = np.diff(starts)
    doc, period, least, place = ([np.empty(0, np.int64)] for _ in range(4))
    right_of, left_of = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for docs, periods, leasts, places in _grid(sizes, min_length, times):
        a = starts[docs] + places
        met = np.flatnonzero(ids[a] == ids[a + periods])
        docs, periods, leasts, places, a = (x[met] for x in (docs, periods, leasts, places, a))
        right = _agreeing(ids, a, a + periods, starts[docs + 1] - a - periods, 1)
        left = _agreeing(ids, a - 1, a + periods - 1, places, -1)
        # A side that stopped before COVER is known; the other may go on.
        far = (right == COVER) | (left == COVER)
        kept = np.flatnonzero(far | (right + left >= leasts))
        for held, x in ((doc, docs), (period, periods), (least, leasts), (place, places),
                        (right_of, right), (left_of, left)):
            held.append(x[kept])
    doc, period, least, place, right, left = map(
        np.concatenate, (doc, period, least, place, right_of, left_of)
    )
    if not len(doc):
        return np.empty((0, 3), np.int64)
    # Only the documents of these points are sorted.
    own, doc_at = np.unique(doc, return_inverse=True)
    firsts = np.concatenate([[0], np.cumsum(sizes[own])])
    text = np.concatenate([ids[starts[d] : starts[d + 1]] for d in own])
    n, a = len(text), firsts[doc_at] + place
    b = a + period
    more = np.flatnonzero(right == COVER)
    if len(more):
        room = firsts[doc_at[more] + 1] - b[more]
        right[more] = np.minimum(CommonExtensions(text).of(a[more], b[more]), room)
    more = np.flatnonzero(left == COVER)
    if len(more):
        found = CommonExtensions(text[::-1]).of(n - b[more], n - a[more])
        left[more] = np.minimum(found, place[more])
    start, end = a - left, b + right
    fits = right + left >= least
    runs = np.stack([start + (starts[own] - firsts[:-1])[doc_at], end - start, period], axis=1)[fits]
    # Multiples of a period have the same stretch, of which the smallest period counts.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a slice and where each text's words start."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values, offsets = split.flatten(), split.offsets.to_numpy()
    real = pc.not_equal(pc.binary_length(values), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return values.filter(real), before[offsets - offsets[0]]


def _collapsed_slice(texts: pa.Array, min_length: int, times: int) -> pa.StructArray:
    words, starts = _words(texts)
    ids = words.dictionary_encode().indices.to_numpy()
    runs = find_runs(ids, starts, min_length, times)
    # A word is dropped where any run holds it after the run's first period.
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edges[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(keep)])
    kept = words if keep.all() else words.filter(pa.array(keep))
    lists = pa.ListArray.from_arrays(pa.array(before[starts], pa.int32()), kept)
    # Runs lie in document order, as their starts do.
    cuts = np.searchsorted(runs[:, 0], starts)
    doc = np.searchsorted(starts, runs[:, 0], "right") - 1
    fields = [pa.array(x) for x in (runs[:, 0] - starts[doc], runs[:, 1], runs[:, 2])]
    rows = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(starts)),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows),
            pc.binary_join(lists, " "),
        ],
        ["n_words", "runs", "collapsed"],
    )


def periodic_runs(
    df: DataFrame, text: str = "text", min_length: int = 24, times: int = 3
) -> DataFrame:
    """Add ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are structs of start (word number from 0), length and period, by start and period.
    ``collapsed`` is the words that no run repeats, joined by one space: of each run its first
    period stays.
    """
    if times < 2 or min_length < 2:
        raise ValueError("times and min_length must be 2 or more")

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy())
            parts, at = [], 0
            while at < len(batch):
                base = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, "right")))
                parts.append(_collapsed_slice(batch.slice(at, stop - at), min_length, times))
                at = stop
            yield pa.concat_arrays(parts) if parts else _collapsed_slice(batch, min_length, times)

    names = ("n_words", "runs", "collapsed")
    out = fresh(df.columns, "found")
    kind = f"struct<n_words:bigint,runs:{RUNS},collapsed:string>"
    kept = [column(c) for c in df.columns if c.lower() not in names]
    rows = df.select(*kept, F.arrow_udf(found, kind)(column(text).cast("string")).alias(out))
    return rows.select(
        *[column(c) for c in rows.columns if c != out], *[F.col(f"`{out}`.{c}").alias(c) for c in names]
    )
