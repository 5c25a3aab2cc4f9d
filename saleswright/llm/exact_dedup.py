"""Exact dedup by two-pass Bloom filtering (operator 8).

Texts are equal when they are the same after each run of white space becomes one space.

Pass one hashes every text to two places of a bit space with ``BITS_PER_ROW`` bits for each
row and keeps the places that two or more rows hit: the Bloom filter of what may be
repeated. Only hashes move, and each task adds up its own first. Pass two tests every row:
one that misses a place is alone and passes straight through; only the others are
shuffled, grouped by the SHA-256 of the text, and settled exactly. Where the filter is too
large to broadcast, all rows are shuffled to look their places up. All of it is DataFrame
operations.

Null texts count as empty, so null and empty texts are equal. Of equal texts the smallest
id stays; a null id stays only where all are null; where that id is repeated, one of its
rows stays. Texts of any length are read whole. Empty tables give empty tables. Further
columns, whatever their names, are kept by ``first_copies`` and not read by ``copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import column, text_of
from saleswright.scale import attach, fits_broadcast, settled

BITS_PER_ROW = 16
# Words of 64 bits in a row of the filter; it is looked up in rows, which are few.
BLOCK_WORDS = 64


def normalised(text: Column) -> Column:
    """White space runs as one space; only runs that need a change are touched."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digest(text: str) -> Column:
    return F.sha2(normalised(text_of(text)), 256)


def _place(sha: Column, number: int, bits: int) -> Column:
    """One of the two places of a text in the bit space."""
    return F.pmod(F.xxhash64(sha, F.lit(number)), F.lit(bits))


def repeat_filter(shas: DataFrame, sha: str, bits: int) -> DataFrame:
    """The Bloom filter of what may be repeated, as blocks of words that are not all zero."""
    places = shas.select(
        F.explode(F.array(_place(F.col(sha), 0, bits), _place(F.col(sha), 1, bits))).alias("place")
    )
    twice = places.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    words = twice.groupBy(F.expr("place div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")
    )
    of_block = F.map_from_entries(
        F.collect_list(F.struct((F.col("word") % BLOCK_WORDS).cast("int").alias("at"), "bits"))
    )
    filled = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1)),
        lambda i: F.coalesce(F.try_element_at("of_block", i), F.lit(0).cast("long")),
    )
    # A block has BLOCK_WORDS words at most.
    return (
        words.groupBy(F.expr(f"word div {BLOCK_WORDS}").alias("block"))
        .agg(of_block.alias("of_block"))
        .select("block", filled.alias("words"))
    )


def maybe_repeated(rows: DataFrame, sha: str, words: DataFrame, bits: int) -> DataFrame:
    """Add ``maybe``: whether both places of the row are in the filter."""
    small = fits_broadcast(words)
    for number in (0, 1):
        rows = rows.withColumn("place", _place(F.col(sha), number, bits))
        rows = rows.withColumn("block", F.expr(f"place div {64 * BLOCK_WORDS}"))
        if small:
            rows = rows.join(F.broadcast(words), "block", "left")
        else:
            rows = attach(rows, words, ["block"], how="left", computed=True)
        word = f"get(words, cast(place div 64 % {BLOCK_WORDS} as int))"
        bit = F.expr(f"coalesce(shiftright({word}, cast(place % 64 as int)) & 1, 0) = 1")
        rows = rows.withColumn(f"hit{number}", bit).drop("place", "block", "words")
    return rows.withColumn("maybe", F.col("hit0") & F.col("hit1")).drop("hit0", "hit1")


def copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: its key, the key that stays, the group's size, and whether it stays."""
    # Texts are read once; digests are what later steps work on.
    shas = settled(df.select(column(key).alias("id"), digest(text).alias("sha")))
    bits = max(64, BITS_PER_ROW * shas.count())
    words = settled(repeat_filter(shas, "sha", bits))
    rows = shas.withColumn("at", F.monotonically_increasing_id())
    flagged = maybe_repeated(rows, "sha", words, bits)
    alone = flagged.filter(~F.col("maybe")).select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    maybe = flagged.filter("maybe").drop("maybe")
    groups = maybe.groupBy("sha").agg(
        F.min("id").alias("keep_id"),
        F.count(F.lit(1)).alias("group_size"),
        F.coalesce(F.min_by("at", "id"), F.min("at")).alias("keep_at"),
    )
    settled_groups = attach(maybe, groups, ["sha"]).select(
        "id", "keep_id", "group_size", (F.col("at") == F.col("keep_at")).alias("kept"), "sha"
    )
    return alone.unionByName(settled_groups).select(
        F.col("id").alias(key), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def first_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with.

    Rows that may be repeated are grouped whole; each task first keeps one row per text.
    """
    whole = F.struct(*(column(c) for c in df.columns))
    first = F.struct(column(key).isNull(), column(key))
    rows = df.select(whole.alias("row"), first.alias("first"), digest(text).alias("sha"))
    shas = settled(rows.select("sha"))
    bits = max(64, BITS_PER_ROW * shas.count())
    words = settled(repeat_filter(shas, "sha", bits))
    flagged = maybe_repeated(rows, "sha", words, bits)
    alone = flagged.filter(~F.col("maybe")).select("row")
    kept = (
        flagged.filter("maybe").groupBy("sha").agg(F.min_by("row", "first").alias("row"))
    ).select("row")
    return alone.unionByName(kept).select("row.*")
