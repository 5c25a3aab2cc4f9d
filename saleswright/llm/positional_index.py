"""Benchmark decontamination by a distributed positional inverted index (operator 13).

``write_index`` stores the postings of every token. Each task cuts its documents into segments
of a bounded size, and a segment keeps one list of positions for each of its terms, so no
word of the corpus is gathered anywhere and nothing is shuffled. A term that is everywhere has
one bounded list in each segment.

``PositionalIndex.search`` finds phrases. Counts of the phrases' terms over all segments
give each phrase its terms from the rarest to the most frequent. A segment is asked only for
phrases whose rarest term it has: the positions of that term, less its place in the phrase, are
where the phrase may start, and the lists of the other terms, less theirs, are intersected
with them, rarest first. Only the lists of terms of phrases leave the index, by segment. Many
phrases are asked in blocks, each with the lists it needs.

Words are runs of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are
lower-cased. Null and empty texts have no words, and are documents of the index all the
same; repeated rows and keys and null keys are documents of their own. Phrases without a word
match nothing. Tables may be empty and may have any other columns, which are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from saleswright.llm.common import column
from saleswright.scale import attach, settled

# Text of a segment, phrases that are asked at once, and rows that a task hands on at once.
SEGMENT_BYTES = 8 * 1024 * 1024
BLOCK_PHRASES = 50_000
OUT_ROWS = 20_000
# Lower-case letters, digits and all that is not ASCII are words; the rest is space.
_SPELT = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
# No word is empty, so that term is free for the edges of documents.
EDGES = ""
MATCH = "segment string, doc_no int, start long, length long, phrase string"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts and where each text's words start."""
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(1, np.int64)
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    data = b"".join(t.as_buffer() for t in texts).translate(_SPELT)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data))
    split = pc.ascii_split_whitespace(plain)
    values = split.flatten()
    real = pc.not_equal(pc.binary_length(values), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return values.filter(real), before[split.offsets.to_numpy()]


def words_of(text: Column) -> Column:
    """A text's words as an array."""

    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words, starts = split_words(batch)
            yield pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words)

    return F.arrow_udf(split, "array<string>")(text.cast("string"))


def pack_gaps(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in groups of seven bits, lowest first, and where each one ends."""
    sizes = np.ones(len(gaps), np.int64)
    for k in range(1, 5):
        sizes += gaps >= 1 << 7 * k
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > k)
        more = (sizes[own] > k + 1) * 128
        out[ends[own] - sizes[own] + k] = ((gaps[own] >> 7 * k) & 127) | more
    return out, ends


def positions_of(packed: bytes) -> np.ndarray:
    """The rising numbers behind ``pack_gaps`` of their gaps."""
    data = np.frombuffer(packed, np.uint8)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.cumsum(np.add.reduceat((data & 127).astype(np.int64) << 7 * place, first))


def _segment(words: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Terms of a segment, their counts and their packed positions."""
    coded = words.dictionary_encode()
    terms = coded.indices.to_numpy().astype(np.int64)
    order = np.sort(terms << 32 | np.arange(len(terms)))
    places, counts = order & 0xFFFFFFFF, np.bincount(terms, minlength=len(coded.dictionary))
    gaps = np.diff(places, prepend=0)
    firsts = np.cumsum(counts) - counts
    gaps[firsts] = places[firsts]
    data, ends = pack_gaps(gaps)
    cuts = np.concatenate([[0], ends[firsts + counts - 1]]).astype(np.int32)
    lists = pa.BinaryArray.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(cuts), pa.py_buffer(data)]
    )
    return coded.dictionary, counts, lists


def _rows(segment: str, number: int, key_type: pa.DataType, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of the index; columns that are not given are null."""
    types = {"term": pa.string(), "n": pa.int64(), "positions": pa.binary(), "doc_no": pa.int32(), "key": key_type}
    held = [pa.repeat(segment, number), *(columns.get(c, pa.nulls(number, t)) for c, t in types.items())]
    return pa.record_batch(held, ["segment", *types])


def write_index(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Store the index of all rows in a folder that all executors share.

    Rows with a ``term`` hold the positions of one term in one segment, and those of the empty
    term where its documents start and the last one ends. Rows without a term hold a document:
    its key, its number in the segment and its number of words.
    """
    docs = df.select(column(key).alias("key"), column(text).cast("string").alias("text"))
    key_type = docs.schema["key"].dataType.simpleString()
    kind = f"segment string, term string, n long, positions binary, doc_no int, key {key_type}"

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, texts = batch.columns
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
            at = 0
            while at < len(batch):
                base = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, base + SEGMENT_BYTES, "right")))
                words, starts = split_words(texts.slice(at, stop - at))
                name, made = f"{part}-{made}", made + 1
                if len(words):
                    terms, counts, lists = _segment(words)
                    for a in range(0, len(terms), OUT_ROWS):
                        n = min(OUT_ROWS, len(terms) - a)
                        yield _rows(name, n, keys.type, term=terms.slice(a, n),
                                    n=pa.array(counts[a : a + n]), positions=lists.slice(a, n))
                edges = pa.array([pack_gaps(np.diff(starts, prepend=0))[0].tobytes()], pa.binary())
                yield _rows(name, 1, keys.type, term=pa.array([EDGES]), n=pa.array([stop - at]),
                            positions=edges)
                yield _rows(name, stop - at, keys.type, n=pa.array(np.diff(starts)),
                            doc_no=pa.array(np.arange(stop - at), pa.int32()),
                            key=keys.slice(at, stop - at))
                at = stop

    docs.mapInArrow(built, kind).write.parquet(path)


def _matches(
    lists: dict[str, np.ndarray], order: list[int], words: list[str], within: int | None,
    firsts: np.ndarray, ends: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of a phrase's matches in a segment."""
    none = np.empty(0, np.int64)
    if any(w not in lists for w in words):
        return none, none, none
    lead = lists[words[order[0]]]
    if within is None:
        at = lead - order[0]
        for place in order[1:]:
            own = lists[words[place]]
            found = np.searchsorted(own, at + place)
            at = at[own[np.minimum(found, len(own) - 1)] == at + place]
            if not len(at):
                return none, none, none
        doc = np.searchsorted(firsts, np.maximum(at, 0), "right") - 1
        fits = (at >= firsts[doc]) & (at + len(words) <= ends[doc])
        return doc[fits], at[fits], np.full(int(fits.sum()), len(words))
    at, low, high = lead, lead, lead
    doc = np.searchsorted(firsts, at, "right") - 1
    for word in dict.fromkeys(words[i] for i in order[1:]):
        own = lists[word]
        after = np.searchsorted(own, at)
        left = own[np.maximum(after - 1, 0)]
        right = own[np.minimum(after, len(own) - 1)]
        # Nearest occurrence in the document, of two the earlier.
        far = np.iinfo(np.int64).max
        to_left = np.where((after > 0) & (left >= firsts[doc]), at - left, far)
        to_right = np.where((after < len(own)) & (right < ends[doc]), right - at, far)
        nearest = np.where(to_left <= to_right, left, right)
        fits = np.minimum(to_left, to_right) <= within
        at, doc, nearest = at[fits], doc[fits], nearest[fits]
        low, high = np.minimum(low[fits], nearest), np.maximum(high[fits], nearest)
    return doc, low, high - low + 1


class PositionalIndex:
    """A stored index that can be asked for phrases."""

    def __init__(self, spark: SparkSession, path: str):
        self.rows = spark.read.parquet(path)

    def documents(self) -> DataFrame:
        """``segment, doc_no, key, n_words`` of every indexed row."""
        return self.rows.filter("term IS NULL").select("segment", "doc_no", "key", F.col("n").alias("n_words"))

    def search(
        self, phrases: DataFrame, within: int | None = None, block_phrases: int = BLOCK_PHRASES
    ) -> DataFrame:
        """Every match of every phrase: ``segment, doc_no, start, length, phrase``.

        ``phrases`` has ``phrase``, a text that names it and occurs once, and ``words``, an array.
        Starts are word numbers within the document. By default a match is the words in a row.
        With ``within`` it is an occurrence of the phrase's rarest word (of equally rare ones the
        first) that has an occurrence of each other word at most so many words away in the same
        document; start and length span the nearest ones.
        """
        asked = settled(
            phrases.filter("size(words) > 0 AND NOT exists(words, w -> w IS NULL)").select("phrase", "words")
        )
        places = asked.select("phrase", "words", F.posexplode("words").alias("place", "term"))
        terms = settled(places.select("term").distinct())
        held = attach(self.rows.filter(F.col("term") != EDGES), terms, ["term"], computed=True)
        counts = held.groupBy("term").agg(F.sum("n").alias("n"))
        # A phrase with a word that no document has is gone here.
        ranked = (
            places.join(counts, "term")
            .groupBy("phrase")
            .agg(F.first("words").alias("words"), F.array_sort(F.collect_list(F.struct("n", "place"))).alias("rank"))
            .filter(F.size("rank") == F.size("words"))
            .select("phrase", "words", F.transform("rank", lambda r: r["place"]).alias("order"))
        )
        blocks = max(1, math.ceil(asked.count() / block_phrases))
        ranked = settled(ranked.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks)).cast("int")))
        wanted = settled(ranked.select("block", F.explode("words").alias("term")).distinct())
        lead = ranked.withColumn("term", F.expr("words[order[0]]"))
        where = attach(held.select("segment", "term"), lead, ["term"]).drop("term")
        lists = attach(held.select("segment", "term", "positions"), wanted, ["term"], computed=True)
        edges = self.rows.filter(F.col("term") == EDGES).select(
            "segment", "term", "positions", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        )

        def found(asked: pa.Table, stored: pa.Table) -> pa.Table:
            return _segment_matches(asked, stored, within)

        # Both sides come from the index; new names for its columns tell them apart.
        where = where.select(*(F.col(c).alias(c) for c in where.columns))
        return (
            where.groupBy("segment", "block")
            .cogroup(lists.unionByName(edges).groupBy("segment", "block"))
            .applyInArrow(found, MATCH)
        )


class _Lists(dict):
    """Positions by term, unpacked when they are asked for."""

    def __init__(self, packed: dict[str, bytes]):
        super().__init__()
        self.packed = packed

    def __contains__(self, term: object) -> bool:
        return term in self.packed

    def __missing__(self, term: str) -> np.ndarray:
        self[term] = positions_of(self.packed[term])
        return self[term]


def _segment_matches(asked: pa.Table, stored: pa.Table, within: int | None) -> pa.Table:
    names = ["segment", "doc_no", "start", "length", "phrase"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    out: list[list] = [[], [], [], []]
    if len(asked):
        lists = _Lists(dict(zip(stored["term"].to_pylist(), stored["positions"].to_pylist(), strict=True)))
        edges = lists[EDGES]
        firsts, ends = edges[:-1], edges[1:]
        for phrase, words, order in zip(
            asked["phrase"].to_pylist(), asked["words"].to_pylist(), asked["order"].to_pylist(), strict=True
        ):
            doc, start, length = _matches(lists, order, words, within, firsts, ends)
            if len(doc):
                for held, x in zip(out, (doc, start - firsts[doc], length, [phrase] * len(doc)), strict=True):
                    held.append(x)
    n = sum(map(len, out[0]))
    segment = asked["segment"][0].as_py() if n else None
    joined = [np.concatenate(x) if n else [] for x in out[:3]]
    phrase = [p for x in out[3] for p in x]
    columns = [pa.repeat(pa.scalar(segment, pa.string()), n), *joined, phrase]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def item_windows(items: DataFrame, size: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, phrase, words`` of the windows of ``size`` words of each item.

    An item of fewer words, but not none, is one window. A null item id is the empty id.
    """
    words = F.col("words")
    last = F.greatest(F.size(words) - size, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(words, i + 1, F.lit(size)))
    rows = items.select(
        F.coalesce(column(item).cast("string"), F.lit("")).alias("item"), words_of(column(text)).alias("words")
    ).filter("size(words) > 0")
    return rows.select("item", F.explode(cut).alias("words")).select(
        "item", F.array_join("words", " ").alias("phrase"), "words"
    )


def contamination(
    index: PositionalIndex, items: DataFrame, size: int = 10, item: str = "item_id", text: str = "text"
) -> DataFrame:
    """Per indexed row: ``key, n_words, n_hit, items, spans``.

    ``n_hit`` counts the words inside any occurrence of a window of an item, ``items`` are the ids
    of the items with such windows as sorted texts, and ``spans`` the covered stretches of words.
    """
    windows = settled(item_windows(items, size, item, text))
    matches = settled(index.search(windows.select("phrase", "words").dropDuplicates(["phrase"])))
    doc = ["segment", "doc_no"]
    by_start = Window.partitionBy(*doc).orderBy("start", "length", "phrase")
    stop = F.col("start") + F.col("length")
    before = F.max(stop).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    # Matches of one document in order: each opens a span or goes on with the one before.
    opened = matches.select(
        *doc, "start", stop.alias("stop"), F.coalesce(F.col("start") > before, F.lit(True)).alias("new"), "length", "phrase"
    )
    spans = (
        opened.select(*doc, "start", "stop", F.sum(F.col("new").cast("int")).over(by_start).alias("span"))
        .groupBy(*doc, "span")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .groupBy(*doc)
        .agg(
            F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        )
    )
    named = attach(matches.select(*doc, "phrase").distinct(), windows.select("item", "phrase").distinct(), ["phrase"])
    found = named.groupBy(*doc).agg(F.array_sort(F.collect_set("item")).alias("items"))
    hits = spans.join(found, doc)
    rows = attach(index.documents(), hits, doc, how="left")
    return rows.select(
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"),
    )
