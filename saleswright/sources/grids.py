"""Delimited files of unknown layout as cell grids.

A grid has one row per sheet row: (file_name, sheet_name, sheet_ordinal,
row_idx, cells). ``row_idx`` starts at 1 and empty cells are NULL.
"""

from __future__ import annotations

import codecs
import csv
import io
import itertools
import re
import sys
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.config import GRID_SCHEMA
from saleswright.functions.text import parse_range
from saleswright.scale import attach, settled

# Encodings tried in this order, after a byte-order mark is dropped.
ENCODINGS = ["utf-8", "cp1252", "latin1"]
BYTE_ORDER_MARK = b"\xef\xbb\xbf"
# Files up to this size are read whole by one task, larger ones by lines. Rows are the same.
WHOLE_FILE_BYTES = 64 * 1024 * 1024
# Bytes that are decoded at a time.
STRETCH = 1 << 16


def list_files(
    spark: SparkSession,
    folder: str,
    extensions: list[str],
    contains: str | None = None,
    recursive: bool = False,
    keep_lock_files: bool = False,
) -> DataFrame:
    """Files of a folder by extension (any case), in name order.

    Names that start with ``~$`` are lock files and are left out unless asked
    for. ``contains`` keeps names that hold a keyword; ``recursive`` looks below
    the folder.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", "length", F.col("_metadata.file_name").alias("file_name"))
    )
    ends = F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
    kept = found.filter(ends.isin([e.lower() for e in extensions]))
    if not keep_lock_files:
        kept = kept.filter(~F.col("file_name").startswith("~$"))
    if contains is not None:
        kept = kept.filter(F.col("file_name").contains(contains))
    return kept.orderBy("file_name")


def _rank(raw: bytes) -> int:
    """The first encoding that reads the bytes; the last one reads all."""
    for i, encoding in enumerate(ENCODINGS[:-1]):
        try:
            for _ in _decoded(raw, encoding):
                pass
            return i
        except UnicodeDecodeError:
            continue
    return len(ENCODINGS) - 1


def _decoded(raw: bytes, encoding: str) -> Iterator[str]:
    """The text of the bytes in stretches, so that it is never there whole."""
    decoder = codecs.getincrementaldecoder(encoding)()
    for at in range(0, len(raw), STRETCH):
        yield decoder.decode(raw[at : at + STRETCH], at + STRETCH >= len(raw))


def _records(raw: bytes, encoding: str) -> Iterator[list[str]]:
    """The records of the bytes, one by one; a cell may be of any length, so none is an error."""
    csv.field_size_limit(sys.maxsize)
    return csv.reader(io.TextIOWrapper(io.BytesIO(raw), encoding, newline=""))


def _cells(line: list[str]) -> list[str | None]:
    return [c if c != "" else None for c in line]


def _whole_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for name, content in zip(batch["file_name"], batch["content"]):
            content = content.removeprefix(BYTE_ORDER_MARK)
            lines = _records(content, ENCODINGS[_rank(content)])
            start = 0
            # The records of a file are never in memory all at once.
            while part := list(itertools.islice(lines, 10_000)):
                yield pd.DataFrame(
                    {
                        "file_name": name,
                        "sheet_name": name,
                        "sheet_ordinal": 0,
                        "row_idx": range(start + 1, start + 1 + len(part)),
                        "cells": [_cells(line) for line in part],
                    }
                )
                start += len(part)


# A quote opens a cell only where the cell begins; inside other cells it is a character.
_OPENS = re.compile(rb'[,\r]"')


def _walk(line: bytes, inside: bool) -> tuple[int, int]:
    """Whether a line ends inside a quoted cell, and how many records it ends.

    ``inside`` says whether it begins inside one. A lone carriage return outside of quotes
    ends a record, too.
    """
    line = line.removesuffix(b"\r")
    ended, at = 0, 0
    if not inside and line[:1] == b'"':
        inside, at = True, 1
    while True:
        if inside:
            close = line.find(b'"', at)
            if close < 0:
                return 1, ended
            at = close + 1
            if line[at : at + 1] == b'"':
                at += 1
                continue
        opening = _OPENS.search(line, at)
        ended += line.count(b"\r", at, opening.end() if opening else len(line))
        if opening is None:
            return 0, ended + 1
        inside, at = True, opening.end()


_WALKED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("end0", "end1", "rows0", "rows1", "rank")]
)


@F.pandas_udf(_WALKED)
def _walked(raw: pd.Series) -> pd.DataFrame:
    def both(line: bytes) -> tuple[int, ...]:
        line = bytes(line)
        (end0, rows0), (end1, rows1) = _walk(line, False), _walk(line, True)
        return end0, end1, rows0, rows1, _rank(line)

    return pd.DataFrame([both(x) for x in raw], columns=_WALKED.names)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _parsed(lines: pd.Series, rank: pd.Series, whole: pd.Series) -> pd.Series:
    def parse(parts, encoding: int, ends: bool) -> list[list[str | None]]:
        raw = b"\n".join(bytes(p) for p in parts) + (b"\n" if ends else b"")
        return [_cells(r) for r in _records(raw, ENCODINGS[encoding])]

    return pd.Series([parse(*x) for x in zip(lines, rank, whole)], dtype=object)


def _entered(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add how each row begins (0 outside, 1 inside of quotes) if its key begins outside
    (``from0``) or inside (``from1``).

    A row maps how it begins to how it ends (``end0``, ``end1``). What counts is the last row
    before that ends alike either way, and how many rows since then turn one into the other.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when((F.col("end0") == 1) & (F.col("end1") == 0), 1).otherwise(0)
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("v"), F.col("_t").alias("t")))
    since = F.col("_n") - F.coalesce(F.col("_fixed.t"), F.lit(0))

    def begins(key_begins: int) -> Column:
        return ((F.coalesce(F.col("_fixed.v"), F.lit(key_begins)) + since) % 2).cast("int")

    return (
        df.withColumn("_t", F.sum(turns).over(by.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_fixed", F.last(fixed, ignorenulls=True).over(before))
        .withColumn("_n", F.coalesce(F.lag("_t").over(by), F.lit(0)))
        .withColumns({"from0": begins(0), "from1": begins(1)})
        .drop("_t", "_fixed", "_n")
    )


def _grid_by_line(lines: DataFrame) -> DataFrame:
    """Rows of (file_name, _size, _start, _seq, _raw), a line each, as a grid.

    Lines are walked for both ways they may begin, blocks of a file are put in a row by what
    they do to either, and only then lines of one record meet.
    """
    at = ["file_name", "_start"]
    walked = _entered(lines.withColumn("_w", _walked("_raw")).select("*", "_w.*").drop("_w"), at, "_seq")
    by = Window.partitionBy(*at).orderBy("_seq")
    so_far, before = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, -1)

    def begun(q: int) -> Column:
        return F.when(F.col(f"from{q}") == 0, 1).otherwise(0)

    def ended(q: int) -> Column:
        return F.when(F.col(f"from{q}") == 0, F.col("rows0")).otherwise(F.col("rows1"))

    def ends(q: int) -> Column:
        return F.when(F.col(f"from{q}") == 0, F.col("end0")).otherwise(F.col("end1"))

    blocks = walked.groupBy(*at).agg(
        *[F.max_by(ends(q), "_seq").alias(f"end{q}") for q in (0, 1)],
        *[F.sum(begun(q)).alias(f"_begun{q}") for q in (0, 1)],
        *[F.sum(ended(q)).alias(f"_ended{q}") for q in (0, 1)],
        F.max("rank").alias("rank"),
        F.max("_size").alias("_size"),
        F.sum(F.octet_length("_raw") + 1).alias("_bytes"),
    )
    # One row per block that one task reads.
    blocks = _entered(settled(blocks), ["file_name"], "_start")
    file = Window.partitionBy("file_name")
    earlier = file.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)

    def of_block(name: str) -> Column:
        return F.when(F.col("from0") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    # The reader drops line ends and a byte-order mark of three bytes.
    read = F.sum("_bytes").over(file) - F.col("_size")
    facts = blocks.select(
        *at,
        F.col("from0").alias("_q"),
        F.coalesce(F.sum(of_block("_begun")).over(earlier), F.lit(0)).alias("_begun"),
        F.coalesce(F.sum(of_block("_ended")).over(earlier), F.lit(0)).alias("_ended"),
        F.sum(of_block("_begun")).over(file).alias("_records"),
        F.max("rank").over(file).alias("_rank"),
        read.isin(0, -len(BYTE_ORDER_MARK)).alias("_closed"),
    )
    q = F.col("_q") == 0
    placed = walked.withColumns(
        {f"_b{n}": F.sum(begun(n)).over(so_far) for n in (0, 1)}
        | {f"_e{n}": F.coalesce(F.sum(ended(n)).over(before), F.lit(0)) for n in (0, 1)}
    )
    met = attach(placed.select(*at, "_seq", "_raw", "_b0", "_b1", "_e0", "_e1"), facts, at)
    record = F.col("_begun") + F.when(q, F.col("_b0")).otherwise(F.col("_b1"))
    first = F.col("_ended") + F.when(q, F.col("_e0")).otherwise(F.col("_e1"))
    records = (
        met.select("file_name", record.alias("_record"), first.alias("_first"), "_records", "_rank", "_closed",
                   F.struct("_start", "_seq", "_raw").alias("_line"))
        .groupBy("file_name", "_record")
        .agg(
            F.min("_first").alias("_first"),
            F.max("_rank").alias("_rank"),
            F.max((F.col("_record") < F.col("_records")) | F.col("_closed")).alias("_closed"),
            F.array_sort(F.collect_list("_line"))["_raw"].alias("_lines"),
        )
        .withColumn("_rows", _parsed("_lines", "_rank", "_closed"))
    )
    return records.select("file_name", "_first", F.posexplode("_rows").alias("_no", "cells")).select(
        "file_name",
        F.col("file_name").alias("sheet_name"),
        F.lit(0).alias("sheet_ordinal"),
        (F.col("_first") + F.col("_no") + 1).cast("long").alias("row_idx"),
        "cells",
    )


def read_delimited_grid(
    spark: SparkSession,
    folder: str,
    name_glob: str = "*.csv",
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """CSV files without a known header as one grid.

    Text is read as UTF-8, else cp1252, else latin1, decided per file; a
    byte-order mark is dropped. Every file can be read this way, and cells may
    have any length, so no file is left out.

    Files up to ``whole_file_bytes`` are parsed by one task each, larger ones are
    split over tasks by line. Both give the same rows: a record may contain line
    breaks in quotes, and each block of lines is put in the state that the blocks
    before leave it in.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_glob)
        .load(folder)
        .withColumn("file_name", F.col("_metadata.file_name"))
        .filter(~F.col("file_name").startswith("~$"))
    )
    small = files.filter(F.col("length") <= whole_file_bytes)
    whole = small.select("file_name", "content").mapInPandas(_whole_files, GRID_SCHEMA)

    lines = (
        spark.read.option("pathGlobFilter", name_glob)
        .option("lineSep", "\n")
        .text(folder)
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("_size"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_seq"),
            F.col("value").cast("binary").alias("_raw"),
        )
        .filter((F.col("_size") > whole_file_bytes) & ~F.col("file_name").startswith("~$"))
    )
    return whole.unionByName(_grid_by_line(lines))


def delimited_sheets(spark: SparkSession, folder: str, name_glob: str = "*.csv") -> DataFrame:
    """The sheets of ``read_delimited_grid``, of files without a row too.

    One row per file: (file_name, sheet_name, sheet_ordinal, error). Contents are not read.
    ``error`` is NULL, as every file can be read; other readers name their files there.
    """
    # A scan skips files of no bytes, the list of the files does not.
    found = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(folder).inputFiles()
    names = [unquote(path).rsplit("/", 1)[-1] for path in found]
    return spark.createDataFrame(
        [(n, n, 0, None) for n in names if not n.startswith("~$")],
        "file_name string, sheet_name string, sheet_ordinal int, error string",
    )


def read_range(grid: DataFrame, range_text: str) -> DataFrame:
    """The cells of a range such as ``A5:K900``, empty rows kept."""
    bounds = grid.sparkSession.range(1).select(parse_range(F.lit(range_text)).alias("r")).first()[0]
    if bounds is None:
        raise ValueError(f"not a range: {range_text}")
    width = bounds["end_col"] - bounds["start_col"] + 1
    return grid.filter(
        F.col("row_idx").between(bounds["start_row"], bounds["end_row"])
    ).withColumn("cells", F.slice("cells", F.lit(bounds["start_col"]), F.lit(width)))
