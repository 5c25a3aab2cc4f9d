"""Helpers that keep the work spread when one file or key holds much of the data.

Four situations recur in this package:

* a table with one row per file must meet a table with one row per cell row;
* rows of a file must be numbered in order;
* rows of a key must be gathered into one document;
* a few first examples of each key are wanted.

Each has one helper here, and none of them puts all rows of a key in one task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A side is broadcast only below both bounds; they are checked on the computed rows.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Facts of one partition of a shuffle join that are put in a hash table, on average.
HASHED_BYTES = 64 * 1024 * 1024
# The JVM does not compile methods of more bytes of code; it interprets them for each row.
COMPILED_BYTES = 8000
# Parts into which the pairs of a product are dealt.
SALTS = 32
# Rows that one task numbers, about.
BLOCK_ROWS = 100_000
# Rows of one document or text block, for all keys alike, where the caller names no number.
PAGE_ROWS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local run gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="saleswright-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Plans made inside delete their shuffle files as soon as they have run.

    Else these stay on the executors' disks until the driver's JVM happens to collect the plan.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settled(df: DataFrame) -> DataFrame:
    """Compute a table once and keep it in the shared folder; its shuffle files end with that."""
    shared_folder(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        # A plan takes the setting when it is made.
        return df.select("*").checkpoint(eager=True)


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Run plans of very long projections so that the JVM compiles them.

    Spark puts a stage into one method; one that is too long to be compiled is evaluated in
    several short ones instead.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unsized(df: DataFrame) -> DataFrame:
    """A settled table without Spark's guess of its size, which a checkpoint keeps.

    The guess for a join is the product of both sides. Carried on from round to round it gets
    more digits than the driver can hold or multiply. Without one, no side is broadcast unasked.
    """
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of an already computed table."""
    return tuple(
        df.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)),
        ).first()
    )


def fits_broadcast(df: DataFrame) -> bool:
    """Count rows and bytes of an already computed table."""
    rows, size = measured(df)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def attach(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    computed: bool = False,
) -> DataFrame:
    """Join per-key facts to many rows.

    The facts are computed once and measured. Small ones are broadcast, so the
    rows are not shuffled. Larger ones meet the rows in a shuffle join, in which
    adaptive execution cuts the partition of a hot key into several tasks and copies
    only the facts of that partition. Where the facts of a partition are few enough for a
    hash table, the many rows are not sorted, so they do not spill. ``computed`` says that
    the facts already come from ``settled``.
    """
    facts = small if computed else settled(small)
    rows, size = measured(facts)
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        return big.join(F.broadcast(facts), list(keys), how)
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size <= parts * HASHED_BYTES:
        facts = facts.hint("shuffle_hash")
    return big.join(facts, list(keys), how)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    block: Column | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, ... by ``order``.

    Rows are cut into blocks of the order value. Blocks are counted first (with
    partial counts), the running total of the counts gives every block its first
    number, and only the rows of one block are sorted together. NULL keys and a NULL order
    are values like any other.
    """
    size = block_rows or BLOCK_ROWS
    keys = list(keys)
    cut = block if block is not None else F.floor(F.col(order) / F.lit(size)).cast("long")
    rows = df.withColumn("_block", cut)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = (
        rows.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    # One row per block; a key and block together are never large.
    first = settled(first)
    if fits_broadcast(first):
        first = F.broadcast(first)
    at = [*keys, "_block"]
    first = first.withColumnsRenamed({c: f"_first_{c}" for c in at})
    same = [rows[c].eqNullSafe(first[f"_first_{c}"]) for c in at]
    return (
        rows.join(first, same)
        .withColumn(out, (F.row_number().over(inside) + F.col("_before")).cast("long"))
        .drop("_block", "_before", *[f"_first_{c}" for c in at])
    )


def paged(
    df: DataFrame, keys: Sequence[str], order: str, page_rows: int | None, out: str = "part_no"
) -> DataFrame:
    """Give each row its page among the rows of its key, from 0, by one rule for all keys.

    A page holds ``page_rows`` rows in ``order``, the last one fewer. With None a key is one
    page, which only keys of few rows bear. ``order`` must be unique within a key.
    """
    if page_rows is None:
        return df.withColumn(out, F.lit(0).cast("long"))
    numbered = number_rows(df, keys, order, "_no")
    return numbered.withColumn(out, F.floor((F.col("_no") - 1) / page_rows).cast("long")).drop("_no")


def first_examples(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """Keep the first ``n`` rows of each key.

    Spark keeps ``n`` rows per key in every task before the shuffle
    (WindowGroupLimit), so a large key sends few rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("example_no", F.row_number().over(window)).filter(
        F.col("example_no") <= n
    )
