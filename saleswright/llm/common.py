"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.scale import settled

# The white space of the contracts, as a regular expression class (fixed value).
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name that does not clash with those that exist, whatever their case."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def column(name: str) -> Column:
    """A column by its exact name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def numbered(df: DataFrame, order: list[str], out: str = "row_number") -> DataFrame:
    """Number all rows 0, 1, 2, ... by ``order`` without gathering them.

    Rows are sorted over the cluster and kept in the shared folder, so that every later
    read sees the same partitions. A row's number is its place in its partition plus the
    rows of the partitions before, of which there is one small row each.
    """
    tie = fresh([*df.columns, out], "tie")
    keys = [column(c).asc_nulls_first() for c in order]
    ordered = settled(
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*keys, F.col(tie))
        .sortWithinPartitions(*keys, F.col(tie))
        .drop(tie)
    )
    part, place, first = (fresh([*df.columns, out], n) for n in ("part", "place", "first"))
    at = F.monotonically_increasing_id()
    placed = ordered.withColumn(place, at)
    placed = placed.withColumn(part, F.shiftright(F.col(place), 33))
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias(first)).collect()
    before, total = [], 0
    for number, rows in sorted((r[part], r[first]) for r in counts):
        before.append((number, total))
        total += rows
    # One row per partition of the sort: the number of partitions bounds this table.
    starts = df.sparkSession.createDataFrame(before or [(0, 0)], f"`{part}` long, `{first}` long")
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(starts), part)
        .withColumn(out, inside + F.col(first))
        .drop(part, place, first)
    )
