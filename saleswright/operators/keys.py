"""Key checks of rows before they are appended to a ledger.

Spark enforces no keys. A batch is checked against itself and against the keys that the ledger
has. The batch is small beside the ledger, so its keys become a Bloom filter, the
ledger's keys are tested where they are read, and only those that may be in the batch are
joined with it exactly. Where the filter is too large to broadcast, all keys are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.scale import attach, fits_broadcast, settled

MISSING, REPEATED, KNOWN = "missing key", "repeated key", "known key"
# A key sets BITS bits in one block of the filter; a block has BLOCK_BITS for KEYS_OF_BLOCK keys.
BITS, BLOCK_BITS, KEYS_OF_BLOCK = 4, 4096, 256


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)).cast("int") for i in range(BITS)]


def key_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """A Bloom filter as rows of ``block`` and 64 ``words`` of 64 bits."""
    set_bits = keys.select(_block(F.col(key), blocks).alias("block"), F.explode(F.array(*_bits(F.col(key)))).alias("bit"))
    words = set_bits.groupBy("block", F.expr("bit div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits")
    )
    entries = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    filled = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)),
        lambda i: F.coalesce(F.try_element_at("entries", i), F.lit(0).cast("long")),
    )
    # A block has 64 words.
    return words.groupBy("block").agg(entries.alias("entries")).select("block", filled.alias("words"))


def may_hold(rows: DataFrame, key: str, held: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key passes the filter ``held``, which must fit a broadcast."""
    met = rows.withColumn("block", _block(F.col(key), blocks)).join(F.broadcast(held), "block")
    hit = F.lit(True)
    for bit in _bits(F.col(key)):
        word = F.get("words", (bit / 64).cast("int"))
        hit = hit & (F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", word, bit % 64)) == 1)
    return met.filter(hit).drop("block", "words")


def known_keys(batch: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """The distinct keys of the batch that the ledger has. ``batch`` should be stored."""
    wanted = batch.filter(F.col(key).isNotNull()).select(key).distinct()
    theirs = ledger.filter(F.col(key).isNotNull()).select(key)
    blocks = max(1, -(-wanted.count() // KEYS_OF_BLOCK))
    held = settled(key_filter(wanted, key, blocks))
    if fits_broadcast(held):
        theirs = may_hold(theirs, key, held, blocks)
    return attach(wanted, theirs.distinct(), [key], how="left_semi")


def with_key_faults(batch: DataFrame, ledger: DataFrame, key: str, out: str = "key_fault") -> DataFrame:
    """Add what is wrong with each row's key, or NULL.

    A key that is NULL is missing. All rows that share a key within the batch are repeated,
    as nothing says which one is right. A key of the ledger is known.
    """
    rows = settled(batch)
    uses = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    faults = uses.filter("_n > 1").select(key, F.lit(REPEATED).alias("_fault")).unionByName(
        known_keys(rows, ledger, key).select(key, F.lit(KNOWN).alias("_fault"))
    )
    # REPEATED sorts after KNOWN, and a key with both faults shows it.
    one = faults.groupBy(key).agg(F.max("_fault").alias("_fault"))
    found = F.when(F.col(key).isNull(), F.lit(MISSING)).otherwise(F.col("_fault"))
    return attach(rows, one, [key], how="left").withColumn(out, found).drop("_fault")
