"""Token ids in binary files with constant-time access by document key (operator 6).

Documents are sorted by key over the cluster, and every task writes the ids of its range as
one shard file: the raw ids of all its documents one after another, then its keys, the
place where each document begins, and an index. The index is a minimal perfect hash of
the keys; at a key's slot stand a 32-bit fingerprint, which tells keys that are not there
apart, and the document's number in the shard. A look-up finds the shard by its key range in the
manifest, then costs one hash and one read, however many documents there are.

File format, all integers little-endian: the magic; ids of ``width`` bytes each (2 if the
vocabulary and the end id fit, else 4); the keys as an Arrow stream; ``n + 1`` starts of 64
bits; the hash; ``m`` fingerprints and ``m`` document numbers of 32 bits, by slot; a footer of
nine 64-bit integers: width, documents, ids, the slots m, and the places of the five
parts after the ids.

A task writes a file under a new name and reports it as a row; the manifest is the table
of those rows that Spark has committed, so a task that runs twice or fails leaves at most a
file that nothing names.

Null texts are empty: only the end id. Texts of any length are encoded whole. Null keys come
first, are stored and read back, but not indexed. Rows with a repeated key are all stored;
a look-up finds the first. Other columns are not read. An empty table gives a manifest
without rows.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.llm.common import column
from saleswright.llm.mph import MinimalPerfectHash, mixed
from saleswright.llm.tokenizer import encoder, read_tokenizer

MAGIC = b"IDSHARD1"
FOOTER = 9 * 8
# Ids that a reader holds at once.
READ_IDS = 1 << 21
# Bytes of ids that a writer gathers before it writes them.
WRITE_BYTES = 1 << 20
KEY_SALT, FINGERPRINT_SALT = 101, 202


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path: a URI's own, or local files."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def key_hashes(keys: pa.Array) -> np.ndarray:
    """64 bits of each key, which must not be null."""
    if pa.types.is_integer(keys.type):
        return mixed(keys.cast(pa.int64()).to_numpy(zero_copy_only=False).astype(np.uint64), KEY_SALT)
    raw = [str(k).encode() for k in keys.to_pylist()]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, FINGERPRINT_SALT) >> np.uint64(32)).astype("<u4")


class ShardWriter:
    """Writes one shard file; documents are added in order."""

    def __init__(self, folder: str, name: str, width: int):
        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        self.out, self.width = files.open_output_stream(f"{root}/{name}"), width
        self.keys: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.at = 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, keys: pa.Array, packed: Iterator[bytes]) -> None:
        """Documents by key and their 32-bit ids."""
        sizes, held, waiting = [], [], 0
        for ids in packed:
            sizes.append(len(ids) // 4)
            held.append(ids)
            waiting += len(ids)
            if waiting >= WRITE_BYTES:
                self._write_ids(b"".join(held))
                held, waiting = [], 0
        self._write_ids(b"".join(held))
        self.keys.append(keys)
        self.sizes.append(np.array(sizes, np.int64))

    def _write_ids(self, ids: bytes) -> None:
        if self.width == 2:
            ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
        self._write(ids)

    def close(self) -> tuple[pa.Array, int]:
        """The keys and the number of ids."""
        keys = pa.concat_arrays(self.keys)
        starts = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))]).astype("<u8")
        known = np.flatnonzero(np.asarray(keys.is_valid()))
        hashes, first = np.unique(key_hashes(keys.take(pa.array(known))), return_index=True)
        index = MinimalPerfectHash.build(hashes)
        slots = index.slots(hashes)
        prints, numbers = np.zeros(len(hashes), "<u4"), np.zeros(len(hashes), "<u4")
        prints[slots], numbers[slots] = fingerprints(hashes), known[first]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("key", keys.type)])) as stream:
            stream.write_batch(pa.record_batch([keys], ["key"]))
        places = []
        for part in (sink.getvalue().to_pybytes(), starts, index.to_bytes(), prints, numbers):
            places.append(self.at)
            self._write(part if isinstance(part, bytes) else part.tobytes())
        footer = [self.width, len(keys), int(starts[-1]), len(hashes), *places]
        self._write(np.array(footer, "<i8").tobytes())
        self.out.close()
        return keys, int(starts[-1])


class ShardReader:
    """Keyed and sequential access to one shard file."""

    def __init__(self, path: str):
        files, name = _file_system(path)
        self.file = files.open_input_file(name)
        end = self.file.size() - FOOTER
        footer = np.frombuffer(self.file.read_at(FOOTER, end), "<i8").tolist()
        self.width, self.documents, self.ids, slots = footer[:4]
        parts = [*footer[4:], end]
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no shard file")
        raw = [self.file.read_at(b - a, a) for a, b in zip(parts, parts[1:], strict=False)]
        self._keys = raw[0]
        self.starts = np.frombuffer(raw[1], "<u8").astype(np.int64)
        self.index = MinimalPerfectHash.from_bytes(raw[2])
        self.prints = np.frombuffer(raw[3], "<u4", slots)
        self.numbers = np.frombuffer(raw[4], "<u4", slots)

    def keys(self) -> pa.Array:
        return pa.ipc.open_stream(self._keys).read_all().column(0).combine_chunks()

    def find(self, keys: pa.Array) -> np.ndarray:
        """The number of each key's document, or -1; keys must not be null."""
        hashes = key_hashes(keys)
        slots = self.index.slots(hashes)
        out = np.full(len(hashes), -1, dtype=np.int64)
        hit = np.flatnonzero(slots >= 0)
        hit = hit[self.prints[slots[hit]] == fingerprints(hashes[hit])]
        out[hit] = self.numbers[slots[hit]]
        return out

    def read(self, start: int, count: int) -> np.ndarray:
        raw = self.file.read_at(count * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")

    def get(self, key) -> np.ndarray | None:
        """The ids of a key's document."""
        number = int(self.find(pa.array([key]))[0])
        if number < 0:
            return None
        return self.read(self.starts[number], self.starts[number + 1] - self.starts[number])

    def scan(self) -> Iterator[tuple[int, np.ndarray]]:
        """Every document's number and ids, found by key where its key is its own."""
        keys = self.keys()
        numbers = np.arange(self.documents)
        known = np.flatnonzero(np.asarray(keys.is_valid()))
        found = self.find(keys.take(pa.array(known)))
        if (found < 0).any() or (found > known).any():
            raise ValueError("the index does not find a stored key")
        numbers[known] = np.where(found < known, known, found)  # repeated keys find the first
        first = 0
        while first < self.documents:
            last = int(np.searchsorted(self.starts, self.starts[first] + READ_IDS, "right")) - 1
            last = min(max(last, first + 1), self.documents)
            base = self.starts[first]
            block = self.read(base, self.starts[last] - base)
            for number in numbers[first:last].tolist():
                yield number, block[self.starts[number] - base : self.starts[number + 1] - base]
            first = last


def write_store(
    df: DataFrame,
    folder: str,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
) -> None:
    """Encode every text, append ``end_id`` and write the shards and their manifest."""
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(read_tokenizer(tokenizer_file))
    docs = df.select(column(key).alias("key"), column(text).cast("string").alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text").asc()]
    docs = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    key_type = docs.schema["key"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, end = encoder(data.value), np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId()
        name, writer = f"shard-{number:06d}-{uuid.uuid4().hex}.ids", None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                writer = ShardWriter(folder, name, 2 if max(own.size, end_id + 1) <= 65536 else 4)
            packed = own.packed_column(batch.column(1))
            writer.add(batch.column(0), (ids + end for ids in packed))
        if writer is not None:
            keys, ids = writer.close()
            yield pa.record_batch(
                [
                    pa.array([number], pa.int32()),
                    [name],
                    [len(keys)],
                    [ids],
                    keys.slice(0, 1),
                    keys.slice(len(keys) - 1, 1),
                ],
                ["shard", "file", "documents", "ids", "first_key", "last_key"],
            )

    schema = (
        "shard int, file string, documents long, ids long, "
        f"first_key {key_type}, last_key {key_type}"
    )
    docs.mapInArrow(write, schema).write.parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, with the ids and documents before it."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.read.parquet(f"{folder}/manifest")
    # One row per shard: a task's range of documents each, so this table is small.
    return shards.withColumn("ids_before", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document from the files: key, start over all shards, n_tokens, ids_crc32."""
    shards = manifest(spark, folder).select("shard", "file", "ids_before", "first_key")
    n = max(1, shards.count())
    key_type = shards.schema["first_key"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(f"{folder}/{row['file']}")
                numbers, sums = [], []
                for number, ids in reader.scan():
                    numbers.append(number)
                    sums.append(zlib.crc32(ids.tobytes()))
                at = np.array(numbers)
                yield pa.record_batch(
                    [
                        reader.keys().take(pa.array(at)),
                        pa.array(reader.starts[at] + row["ids_before"], pa.int64()),
                        pa.array(reader.starts[at + 1] - reader.starts[at], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["key", "start", "n_tokens", "ids_crc32"],
                )

    schema = f"key {key_type}, start long, n_tokens long, ids_crc32 long"
    return shards.drop("first_key").repartition(n, "shard").mapInArrow(scan, schema)


class TokenStore:
    """Ids by key, from anywhere that reaches the files."""

    def __init__(self, spark: SparkSession, folder: str):
        rows = manifest(spark, folder).filter("last_key is not null").orderBy("shard").collect()
        self.folder, self.rows = folder, rows
        self.last = [r["last_key"] for r in rows]

    def get(self, key) -> np.ndarray | None:
        at = bisect.bisect_left(self.last, key)
        if at == len(self.rows):
            return None
        return ShardReader(f"{self.folder}/{self.rows[at]['file']}").get(key)
