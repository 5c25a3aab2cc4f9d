"""Reversible line dedup (operator 5).

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys
found in ``min_docs`` documents or more lose all their lines in every document.

The index is two things in the shared folder. The reference counts are exact: every batch
of inserted or deleted documents appends one row per key, shard and change of the
number of documents. For each shard, a cuckoo filter holds the keys that now reach
``min_docs``; a batch touches only the keys that cross that bound, in either direction, so
deleting documents undoes inserting them. Cleaning asks the filters for every line, which
need two bytes or so per key, and settles every hit against the exact counts: the distinct
keys that the filters take are looked up, and the few that they take by mistake are excepted. So
documents that were not inserted, or were deleted since, lose no line of theirs by mistake either.

Keys are 128-bit digests (MD5) of the line's key. Null texts are one empty line, as empty ones
are; empty keys are never dropped. A line repeated in a document counts once; repeated rows
count as documents of their own. Texts of any length are read whole. Cleaning keeps all
columns but those named like its results, which are replaced. Empty tables are a batch like
any other.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm.common import column, fresh
from saleswright.llm.cuckoo import CuckooFilter, Full

N_SHARDS = 64
MIN_DOCS = 10
MIN_CHARS = 1
# Filters and exceptions are sent to every executor up to this many bytes in all.
SENT_BYTES = 64 * 1024 * 1024
WHITE = " \t\n\x0b\x0c\r"
STATE = "shard int, filter binary"


def line_keys(text: str, min_chars: int) -> tuple[list[str], list[bytes | None]]:
    """The lines of a text and their digests; None for keys that are too short."""
    lines = text.split("\n")
    digests: list[bytes | None] = []
    for line in lines:
        key = line.strip(WHITE)
        # Bytes are lower-cased in ASCII alone.
        digests.append(
            hashlib.md5(key.encode().lower()).digest() if key and len(key) >= min_chars else None
        )
    return lines, digests


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Filters:
    """The filters of all shards side by side, for look-ups of many keys."""

    def __init__(self, blobs: dict[int, bytes], n_shards: int):
        parts = [CuckooFilter.from_bytes(blobs[s]) if s in blobs else CuckooFilter.sized(0)
                 for s in range(n_shards)]
        self.n_shards = n_shards
        self.masks = np.array([len(p.table) - 1 for p in parts], np.uint64)
        self.starts = np.cumsum([0, *(len(p.table) for p in parts[:-1])]).astype(np.uint64)
        self.all = CuckooFilter(np.concatenate([p.table for p in parts]))

    def contain(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        shard = shard_numbers(low, self.n_shards)
        self.all.mask = self.masks[shard]
        prints, here = self.all.prints(low), self.all.first(high)
        there = self.all.other(here, prints)
        start, own, table = self.starts[shard], prints[:, None], self.all.table
        return (table[here + start] == own).any(1) | (table[there + start] == own).any(1)


def shard_numbers(low: np.ndarray, n_shards: int) -> np.ndarray:
    """A key's shard; other bits of the key than its fingerprint and bucket."""
    return ((low.astype(np.uint64) >> np.uint64(40)) % np.uint64(n_shards)).astype(np.int64)


class LineIndex:
    """Reference counts and filters of lines, kept in a folder that all executors share."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        min_docs: int = MIN_DOCS,
        n_shards: int = N_SHARDS,
        min_chars: int = MIN_CHARS,
        version: int = 0,
    ):
        self.spark, self.folder, self.version = spark, folder, version
        self.min_docs, self.n_shards, self.min_chars = min_docs, n_shards, min_chars

    @classmethod
    def open(cls, spark: SparkSession, folder: str, **parameters) -> LineIndex:
        """An index as its last whole batch left it; a batch that failed has no effect."""
        last = spark.read.parquet(f"{folder}/filters").agg(F.max("batch")).first()[0]
        return cls(spark, folder, version=int(last or 0), **parameters)

    def _batch_counts(self, docs: DataFrame, text: str) -> DataFrame:
        """One row per key: in how many of these documents it stands."""
        min_chars, n_shards = self.min_chars, self.n_shards

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: list[bytes] = []
                for body in batch.column(0).to_pylist():
                    _, digests = line_keys(body or "", min_chars)
                    found.extend({d for d in digests if d is not None})
                high, low = halves(found)
                shard = shard_numbers(low, n_shards)
                yield pa.record_batch(
                    [pa.array(shard, pa.int32()), pa.array(high), pa.array(low)],
                    ["shard", "high", "low"],
                )

        rows = docs.select(column(text).cast("string").alias("text")).mapInArrow(
            keys, "shard int, high long, low long"
        )
        return rows.groupBy("shard", "high", "low").agg(F.count(F.lit(1)).alias("n"))

    def _refs(self) -> DataFrame:
        """All changes up to this version."""
        schema = "shard int, high long, low long, n long"
        if not self.version:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.folder}/refs/batch={v}" for v in range(1, self.version + 1)]
        return self.spark.read.schema(schema).parquet(*paths)

    def counts(self) -> DataFrame:
        """Keys and the number of documents they stand in now."""
        total = self._refs()
        if self.version > 1:
            total = total.groupBy("shard", "high", "low").agg(F.sum("n").alias("n"))
        return total.filter("n <> 0")

    def filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.folder}/filters/batch={self.version}")

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._apply(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """Take documents out that were inserted."""
        return self._apply(docs, text, -1)

    def _apply(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        new = f"{self.folder}/refs/batch={self.version + 1}"
        counted = self._batch_counts(docs, text).withColumn("n", F.col("n") * sign)
        counted.write.mode("overwrite").parquet(new)
        changes = self.spark.read.schema("shard int, high long, low long, n long").parquet(new)
        key = ["shard", "high", "low"]
        if self.version:
            # Only the counts of keys in this batch matter.
            before = self._refs().join(changes.select(*key), key, "left_semi")
            before = before.groupBy(*key).agg(F.sum("n").alias("old"))
            changes = changes.join(before, key, "left")
        else:
            changes = changes.withColumn("old", F.lit(0))
        old = F.coalesce("old", F.lit(0))
        crossing = changes.select(
            *key,
            (old >= self.min_docs).alias("was"),
            (old + F.col("n") >= self.min_docs).alias("is"),
        ).filter(F.col("was") != F.col("is"))
        held = self.filters()
        updated = (
            held.groupBy("shard").cogroup(crossing.groupBy("shard"))
            .applyInPandas(updated_filter, STATE)
        )
        after = LineIndex(
            self.spark, self.folder, self.min_docs, self.n_shards, self.min_chars, self.version + 1
        )
        state = f"{self.folder}/filters/batch={after.version}"
        if self.version:
            # Shards that have outgrown their filter are built from the exact counts.
            staged = f"{self.folder}/staged/batch={after.version}"
            updated.write.mode("overwrite").parquet(staged)
            updated = self.spark.read.schema(STATE).parquet(staged)
            outgrown = updated.filter("filter is null").select("shard")
            rebuilt = (
                after.counts().filter(F.col("n") >= self.min_docs)
                .join(F.broadcast(outgrown), "shard", "left_semi")
                .groupBy("shard").applyInPandas(built_filter, STATE)
            )
            updated = updated.filter("filter is not null").unionByName(rebuilt)
        updated.write.mode("overwrite").parquet(state)
        return after

    def clean(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Add ``n_lines``, ``n_dropped`` and ``kept_text`` to any documents."""
        names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept_text")]
        docs = docs.select(*(column(c) for c in names))
        size = self.filters().agg(F.sum(F.octet_length("filter"))).first()[0] or 0
        if size > SENT_BYTES:
            return self._clean_joined(docs, text)
        blobs = {r["shard"]: bytes(r["filter"]) for r in self.filters().collect()}
        filters, n_shards = self.spark.sparkContext.broadcast(blobs), self.n_shards
        min_chars = self.min_chars

        def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            probe = Filters(filters.value, n_shards)
            for batch in batches:
                texts = batch.column(0).to_pylist()
                own = list({d for body in texts for d in line_keys(body or "", min_chars)[1] if d is not None})
                high, low = halves(own)
                hit = pa.array(probe.contain(high, low))
                yield pa.record_batch([pa.array(high), pa.array(low)], ["high", "low"]).filter(hit)

        # A frequent key is listed once per batch; about one other key in ten thousand is taken. The
        # bytes of those are checked before they are sent.
        mistaken = f"{self.folder}/mistaken/{uuid.uuid4().hex}"
        hits = docs.select(column(text).cast("string").alias("text")).mapInArrow(taken, "high long, low long")
        frequent = self.counts().filter(F.col("n") >= self.min_docs).select("high", "low")
        hits.distinct().join(frequent, ["high", "low"], "left_anti").write.parquet(mistaken)
        excepted = self.spark.read.schema("high long, low long").parquet(mistaken)
        if excepted.count() * 16 > SENT_BYTES:
            return self._clean_joined(docs, text)
        pairs = [(r["high"], r["low"]) for r in excepted.collect()]
        exact = np.array(pairs, "<i8").tobytes() if pairs else b""
        exceptions = self.spark.sparkContext.broadcast(exact)

        def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            probe = Filters(filters.value, n_shards)
            raw = exceptions.value
            not_these = {raw[i : i + 16] for i in range(0, len(raw), 16)}
            for batch in batches:
                rows = [line_keys(body or "", min_chars) for body in batch.to_pylist()]
                known = list({d for _, digests in rows for d in digests if d is not None})
                hit = probe.contain(*halves(known))
                drop = {known[i] for i in np.flatnonzero(hit).tolist()} - not_these
                yield kept_lines(rows, drop)

        return _with_result(docs, F.arrow_udf(cleaned, RESULT)(column(text).cast("string")))

    def _clean_joined(self, docs: DataFrame, text: str) -> DataFrame:
        """The same where the filters are too large to send: by joins on the exact counts."""
        min_chars = self.min_chars
        body = F.coalesce(column(text).cast("string"), F.lit(""))
        row, listed, drop = (fresh(docs.columns, n) for n in ("row", "listed", "drop"))
        marked = docs.withColumn(row, F.sha2(body, 256))

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers, found = [], []
                for number, text in enumerate(batch.column(1).to_pylist()):
                    own = {d for d in line_keys(text, min_chars)[1] if d is not None}
                    numbers.extend([number] * len(own))
                    found.extend(own)
                high, low = halves(found)
                rows = batch.column(0).take(pa.array(numbers, pa.int64()))
                yield pa.record_batch([rows, pa.array(high), pa.array(low)], ["row", "high", "low"])

        texts = marked.select(F.col(row).alias("row"), body.alias("text")).mapInArrow(
            keys, "row string, high long, low long"
        )
        frequent = self.counts().filter(F.col("n") >= self.min_docs).select("high", "low")
        # Equal texts lose the same lines, so their keys are listed once.
        digest = F.struct("high", "low")
        listing = (
            texts.distinct().join(frequent, ["high", "low"])
            .groupBy("row").agg(F.collect_set(digest).alias(listed))
            .withColumnRenamed("row", row)
        )

        def cleaned(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for bodies, lists in batches:
                parts = []
                for body, pairs in zip(bodies.to_pylist(), lists.to_pylist(), strict=True):
                    own = [(p["high"], p["low"]) for p in pairs or []]
                    raw = np.array(own, "<i8").tobytes()
                    drop = {raw[i : i + 16] for i in range(0, len(raw), 16)}
                    parts.append(kept_lines([line_keys(body, min_chars)], drop))
                yield pa.concat_arrays(parts)

        joined = marked.join(listing, row, "left")
        result = F.arrow_udf(cleaned, RESULT)(body, F.col(listed))
        return _with_result(joined, result).drop(row, listed)


RESULT = "n_lines long, n_dropped long, kept_text string"


def _with_result(df: DataFrame, result) -> DataFrame:
    name = fresh(df.columns, "result")
    out = df.withColumn(name, result)
    for part in ("n_lines", "n_dropped", "kept_text"):
        out = out.withColumn(part, F.col(name)[part])
    return out.drop(name)


def kept_lines(rows: list[tuple[list[str], list[bytes | None]]], drop: set[bytes]) -> pa.Array:
    n_lines, n_dropped, kept = [], [], []
    for lines, digests in rows:
        left = [x for x, d in zip(lines, digests, strict=True) if d is None or d not in drop]
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(left))
        kept.append("\n".join(left))
    return pa.StructArray.from_arrays(
        [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
        ["n_lines", "n_dropped", "kept_text"],
    )


def updated_filter(held: pd.DataFrame, crossing: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after the keys that crossed the bound; null where they don't fit."""
    shard = int((held if len(held) else crossing)["shard"].iloc[0])
    gone, come = crossing[crossing["was"]], crossing[crossing["is"]]
    if len(held):
        own = CuckooFilter.from_bytes(bytes(held["filter"].iloc[0]))
    else:
        own = CuckooFilter.sized(len(come))
    blob = None
    try:
        own.delete(gone["high"].to_numpy(), gone["low"].to_numpy())
        own.insert(come["high"].to_numpy(), come["low"].to_numpy())
        blob = own.to_bytes()
    except Full:
        if not len(held):
            return built_filter(come)
    return pd.DataFrame({"shard": [shard], "filter": [blob]})


def built_filter(keys: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter from all its keys, as large as it takes."""
    room = len(keys)
    while True:
        own = CuckooFilter.sized(room)
        try:
            own.insert(keys["high"].to_numpy(), keys["low"].to_numpy())
            break
        except Full:
            room *= 2
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "filter": [own.to_bytes()]})
