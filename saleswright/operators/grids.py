"""Sheet choice, header search and row tests on cell grids.

Header searches look at the first rows of every sheet before anything else. Only
sheets without a match there are read further, so a large file with its header
near the top is not searched to its end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import (
    FALLBACK_SCAN_ROWS,
    SHEET_WORDS,
    TOTAL_WORDS,
    UNUSABLE_SHEET_WORDS,
)
from saleswright.functions.cleaning import clean_text
from saleswright.functions.text import normal_header
from saleswright.scale import attach, settled

SHEET = ["file_name", "sheet_name"]
# Rows of a sheet that are searched before the rest of it.
NEAR_ROWS = 200


# -- sheets -----------------------------------------------------------------


def sheet_list(grid: DataFrame, sheets: DataFrame | None = None) -> DataFrame:
    """One row per sheet with its position. Reads no cells.

    ``sheets`` (file_name, sheet_name, sheet_ordinal) names all sheets; without it, those
    without a row are unknown.
    """
    listed = grid.select(*SHEET, "sheet_ordinal")
    if sheets is not None:
        listed = listed.unionByName(sheets.select(*SHEET, "sheet_ordinal"))
    return listed.groupBy(*SHEET).agg(F.min("sheet_ordinal").alias("sheet_ordinal"))


def _contains_any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def choose_sheet(
    sheets: DataFrame, wanted: str, words: list[str] | None = None
) -> DataFrame:
    """The sheet to convert, per file: the wanted name, else a telling name, else the first."""
    name = F.lower("sheet_name")
    rank = (
        F.when(F.lower(clean_text(F.col("sheet_name"))) == wanted.lower(), 0)
        .when(_contains_any(name, words or SHEET_WORDS), 1)
        .otherwise(2)
    )
    best = F.min_by("sheet_name", F.struct(rank, F.col("sheet_ordinal")))
    return sheets.groupBy("file_name").agg(best.alias("sheet_name"))


def first_usable_sheet(sheets: DataFrame, words: list[str] | None = None) -> DataFrame:
    """The first sheet whose name holds none of the words; NULL for a file without one."""
    unusable = _contains_any(F.lower("sheet_name"), words or UNUSABLE_SHEET_WORDS)
    return sheets.groupBy("file_name").agg(
        F.min_by("sheet_name", F.when(~unusable, F.col("sheet_ordinal"))).alias("sheet_name")
    )


# -- row tests --------------------------------------------------------------


def non_null_cells(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda c: c.isNotNull()))


def non_blank_cells(cells: Column) -> Column:
    return F.filter(F.transform(cells, clean_text), lambda c: c != "")


def is_data_row(cells: Column, total_words: list[str] | None = None) -> Column:
    """At least two filled cells, the first of which is not a total label."""
    kept = non_blank_cells(cells)
    return (F.size(kept) >= 2) & ~F.lower(F.get(kept, F.lit(0))).isin(total_words or TOTAL_WORDS)


def is_dense_row(cells: Column, width: Column, share: Column) -> Column:
    """The filled cells make up at least a share of the sheet's width."""
    return non_null_cells(cells) / width >= share


# -- header search ----------------------------------------------------------


def first_row_where(grid: DataFrame, test: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Per sheet, the first row that ``test`` keeps.

    ``test`` maps grid rows to (file_name, sheet_name, row_idx, found), where
    ``found`` is a struct, and keeps only rows that match. The rest of a sheet is
    read only when its first rows have no match.
    """
    def first(rows: DataFrame) -> DataFrame:
        return test(rows).groupBy(*SHEET).agg(
            F.min("row_idx").alias("header_row"), F.min_by("found", "row_idx").alias("found")
        )

    near = settled(first(grid.filter(F.col("row_idx") <= NEAR_ROWS)))
    sheets = grid.filter(F.col("row_idx") > NEAR_ROWS).select(*SHEET).distinct()
    left = settled(sheets.join(near, SHEET, "left_anti"))
    if left.isEmpty():
        return near
    far = grid.filter(F.col("row_idx") > NEAR_ROWS)
    return near.unionByName(first(attach(far, left, SHEET, computed=True)))


def normal_cells(cells: Column) -> Column:
    return F.transform(cells, lambda c: normal_header(F.coalesce(c, F.lit(""))))


def alias_positions(normal: Column, aliases: dict[str, list[str]]) -> Column:
    """Field -> 0-based index of its first header cell, as a map of the fields found.

    The dictionary is part of the expression, so no rows are multiplied. One
    header may serve several fields.
    """
    def place(words: list[str]) -> Column:
        return F.array_position(F.transform(normal, lambda c: c.isin(words)), True).cast("int")

    entries = [
        F.struct(F.lit(name).alias("key"), place(words).alias("value"))
        for name, words in aliases.items()
    ]
    found = F.filter(F.array(*entries), lambda e: e["value"] > 0)
    moved = F.transform(
        found, lambda e: F.struct(e["key"].alias("key"), (e["value"] - 1).alias("value"))
    )
    return F.map_from_entries(moved)


def alias_headers(grid: DataFrame, aliases: dict[str, list[str]], least: int = 2) -> DataFrame:
    """Per sheet, the first row that names at least two fields, with their positions."""
    known = sorted({w for words in aliases.values() for w in words})

    def test(rows: DataFrame) -> DataFrame:
        # Data rows rarely hold any header word; one set lookup per cell drops them.
        normal = rows.withColumn("normal", normal_cells(F.col("cells")))
        named = normal.filter(F.exists("normal", lambda c: c.isin(known)))
        return (
            named.withColumn("col_map", alias_positions(F.col("normal"), aliases))
            .filter(F.size("col_map") >= least)
            .select(*SHEET, "row_idx", F.struct("col_map", "cells").alias("found"))
        )

    return first_row_where(grid, test).select(
        *SHEET, "header_row", "found.col_map", F.col("found.cells").alias("header_cells")
    )


def fullest_headers(grid: DataFrame, rows: int = FALLBACK_SCAN_ROWS) -> DataFrame:
    """Per sheet, the fullest of the first rows (the first of equals), if it has two cells."""
    filled = F.size(non_blank_cells(F.col("cells")))
    near = grid.filter(F.col("row_idx") <= rows).select(
        *SHEET, "row_idx", "cells", filled.alias("filled")
    )
    rank = F.struct("filled", -F.col("row_idx"))
    return (
        near.groupBy(*SHEET)
        .agg(
            F.max("filled").alias("filled"),
            F.max_by("row_idx", rank).alias("header_row"),
            F.max_by("cells", rank).alias("header_cells"),
        )
        .filter(F.col("filled") >= 2)
        .drop("filled")
    )
