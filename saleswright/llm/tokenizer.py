"""Encode columns with a tokenizer file of the ``tokenizers`` library.

Where the file is a byte-level BPE that cuts texts by the usual pattern and changes nothing
before, every distinct pre-token is given to the library once per worker, and a text's ids
are those of its pre-tokens. Any other file encodes texts whole. So is a text that holds the
string of an added token of the file: it gets that token's id, as the library gives it.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from saleswright.llm.pretokens import PretokenEncoder

# The pattern of the library's byte-level pre-tokenizer (fixed value).
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Byte-level vocabularies name bytes that are no visible character by those from U+0100 on.
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_NAMES = {byte: 256 + i for i, byte in enumerate(sorted({*range(256)} - SHOWN))}
# The file is sent to every executor, so it must not be larger than this.
TOKENIZER_BYTES = 64 * 1024 * 1024
BATCH = 256
# What a worker remembers and holds at once; no other worker runs beside it in a task.
REMEMBERED = 400_000
SLICE_CHARS = 4_000_000


class TextEncoder:
    """The tokenizer of one file, as it lives in a worker."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.encode_special_tokens = True  # pieces are parts of texts without their strings
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        parts = json.loads(data)
        self.data, self.unchanged = data, None
        self.marks = [t["content"] for t in parts.get("added_tokens") or [] if t.get("content")]
        cut = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            parts.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space", True)
            and cut.get("use_regex", True)
            and (parts.get("model") or {}).get("type") == "BPE"
        )
        self.encode = PretokenEncoder(BYTE_LEVEL, self._encode_pieces, REMEMBERED, SLICE_CHARS)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pre-tokens by the library's model, which names bytes by characters."""
        merge = self.tokenizer.model.tokenize
        named = [piece.encode().decode("latin-1").translate(BYTE_NAMES) for piece in pieces]
        lists = [[token.id for token in merge(name)] for name in named]
        return [pack(f"<{len(ids)}I", *ids) for ids in lists]

    def _marked(self, text: str | None) -> bool:
        return bool(text) and any(mark in text for mark in self.marks)

    def _encode_whole(self, text: str) -> bytes:
        if self.unchanged is None:
            from tokenizers import Tokenizer

            self.unchanged = Tokenizer.from_str(self.data.decode())
            self.unchanged.no_truncation()
            self.unchanged.no_padding()
        return np.array(self.unchanged.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def packed(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        marked = [self._marked(t) for t in texts]
        plain = self._packed([None if m else t for t, m in zip(texts, marked, strict=True)])
        for text, mark, ids in zip(texts, marked, plain, strict=True):
            yield self._encode_whole(text) if mark else ids

    def packed_column(self, texts: pa.Array) -> Iterator[bytes]:
        """As ``packed``, for a column of which only a slice is made into Python texts at once."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right")))
            yield from self.packed(texts.slice(at, stop - at).to_pylist())
            at = stop

    def _packed(self, texts: list[str | None]) -> Iterator[bytes]:
        if self.by_piece:
            yield from self.encode(texts)
            return
        for at in range(0, len(texts), BATCH):
            some = [t or "" for t in texts[at : at + BATCH]]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            yield from (pack(f"<{len(f.ids)}I", *f.ids) for f in found)


_encoders: dict[str, TextEncoder] = {}


def encoder(data: bytes) -> TextEncoder:
    """The worker's encoder for a tokenizer file, built once."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(data)
    return _encoders[key]


def read_tokenizer(path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read(TOKENIZER_BYTES + 1)
    if len(data) > TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {TOKENIZER_BYTES} bytes")
    return data
