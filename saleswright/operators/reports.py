"""Reports in an order: rows numbered over the whole table, files in the order of their names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.scale import settled


def in_order(df: DataFrame, order: Sequence[Column], out: str = "row_number") -> DataFrame:
    """Sort all rows and number them 1, 2, ... without gathering them.

    Rows are dealt by ranges of the order and kept in the shared folder. A row's number is its
    place in its part plus the rows of the parts before, of which there is one small row each.
    Rows that are equal in ``order`` come in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = settled(df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id()
    placed = sorted_rows.withColumn("_at", at).withColumn("_part", F.shiftright(F.col("_at"), 33))
    # One row per part of the sort, so this one window is short.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(out, inside + F.col("_before") + 1).drop("_at", "_part", "_before")


def write_in_order(df: DataFrame, order: Sequence[Column], path: str) -> None:
    """A CSV report whose files, read by name one after another, are in order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
