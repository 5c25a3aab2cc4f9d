"""Byte-level BPE encoding and decoding (operator 1).

A pre-token that is in the vocabulary as a whole is one lookup in a minimal perfect hash,
confirmed by the bytes stored at its slot. Any other is merged from its bytes: they form
a linked list, and a heap gives the adjacent pair of lowest rank, the leftmost first.

A null text is the empty text; an empty text has no ids; any length is encoded whole.
Ids are packed as little-endian unsigned 32-bit integers in a binary column, which Spark
can hash, measure and store as it is; ``unpacked`` turns them into an array. Null ids
decode to null. Rows are neither moved nor dropped, so ties and repeated rows stay.
An existing column named like the output is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import column
from saleswright.llm.mph import MinimalPerfectHash
from saleswright.llm.pretokens import PretokenEncoder

# The vocabulary is sent to every executor, so its file must not be larger than this.
VOCABULARY_BYTES = 64 * 1024 * 1024


class ByteBpe:
    """The coder of one vocabulary, as it lives in a worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token_of = {rank: token for token, rank in ranks.items()}
        tokens = list(ranks)
        hashes = self._hashes(tokens)
        self.whole = MinimalPerfectHash.build(hashes)
        self.stored: list[bytes] = [b""] * len(tokens)
        for token, slot in zip(tokens, self.whole.slots(hashes).tolist(), strict=True):
            self.stored[slot] = token
        self.ids = [ranks[token].to_bytes(4, "little") for token in self.stored]
        self.encode = PretokenEncoder(pattern, self._encode_pieces)

    @staticmethod
    def _hashes(pieces: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, pieces), np.uint64, len(pieces))

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        slots = self.whole.slots(self._hashes(raw)).tolist()
        return [
            self.ids[slot] if slot >= 0 and self.stored[slot] == piece else self.merged(piece)
            for piece, slot in zip(raw, slots, strict=True)
        ]

    def merged(self, piece: bytes) -> bytes:
        """The packed ids of one pre-token, merged pair by pair."""
        n, rank_of = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n))  # where the part before this one starts
        heap = []
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if middle is None or middle >= stop or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[i], end[middle] = stop, None
            if stop < n:
                before[stop] = i
                rank = rank_of(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            if i:
                left = before[i]
                rank = rank_of(piece[left:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return np.array(ids, "<u4").tobytes()

    def decode(self, packed: bytes) -> bytes | None:
        """The bytes behind the ids; None where an id is not in the vocabulary."""
        try:
            return b"".join(map(self.token_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        except KeyError:
            return None


_coders: dict[tuple[str, str], ByteBpe] = {}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file's lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def coder(data: bytes, pattern: str) -> ByteBpe:
    """The worker's coder for a rank file, built once."""
    key = (hashlib.sha256(data).hexdigest(), pattern)
    if key not in _coders:
        _coders.clear()
        _coders[key] = ByteBpe(read_ranks(data), pattern)
    return _coders[key]


class BpeCodec:
    """Encodes and decodes columns by a rank file and the pattern that cuts pre-tokens."""

    def __init__(self, spark, rank_file: str, pattern: str):
        with open(rank_file, "rb") as file:
            data = file.read(VOCABULARY_BYTES + 1)
        if len(data) > VOCABULARY_BYTES:
            raise ValueError(f"{rank_file} is larger than {VOCABULARY_BYTES} bytes")
        self.data, self.pattern = spark.sparkContext.broadcast(data), pattern

    def encode(self, df: DataFrame, text: str = "text", out: str = "ids") -> DataFrame:
        data, pattern = self.data, self.pattern

        def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = coder(data.value, pattern)
            for batch in batches:
                yield pa.array(own.encode(batch.to_pylist()), pa.binary())

        return df.withColumn(out, F.arrow_udf(ids, "binary")(column(text).cast("string")))

    def decode(self, df: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
        """Bytes, as ids may end within a character; cast to string where they don't.

        Null ids and rows with an id outside of the vocabulary give null.
        """
        data, pattern = self.data, self.pattern

        def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = coder(data.value, pattern)
            for batch in batches:
                rows = (None if x is None else own.decode(x) for x in batch.to_pylist())
                yield pa.array(rows, pa.binary())

        return df.withColumn(out, F.arrow_udf(decoded, "binary")(column(ids)))


def n_ids(ids: Column) -> Column:
    return F.floor(F.octet_length(ids) / F.lit(4)).cast("long")


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of integers, on the JVM."""
    at = F.sequence(F.lit(0), n_ids(ids).cast("int") - 1)

    def one(i: Column) -> Column:
        # The bytes of an id stand lowest first.
        digits = F.hex(F.substring(ids, i * 4 + 1, F.lit(4)))
        pairs = [F.substring(digits, 2 * k + 1, 2) for k in (3, 2, 1, 0)]
        return F.conv(F.concat(*pairs), 16, 10).cast("long")

    return F.when(n_ids(ids) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(at, one))
