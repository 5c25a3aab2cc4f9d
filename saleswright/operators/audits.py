"""Audits of loaded transactions: categories, exclusions, file counts, file totals."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import (
    CATEGORY_FLAGS,
    CATEGORY_KEYWORDS,
    EXCLUSION_TERMS,
    TRUE_FLAGS,
)
from saleswright.functions.cleaning import clean_text, plain_number
from saleswright.functions.text import first_containing
from saleswright.operators.grids import (
    SHEET,
    first_row_where,
    first_usable_sheet,
    non_null_cells,
    sheet_list,
)
from saleswright.scale import attach, settled

# -- category keywords ------------------------------------------------------


def keyword_matches(lowered: Column, keywords: list[tuple[str, str, int]]) -> Column:
    """Keywords found in lower-case text as structs, best first.

    Order: priority from high to low, then position in the text, then keyword.
    The keywords are part of the expression, so the rows are neither multiplied
    nor shuffled.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(-priority).alias("rank"), F.lit(word).alias("keyword"),
                F.lit(word.lower()).alias("word"), F.lit(category).alias("category"),
            )
            for word, category, priority in keywords
        ]
    )
    found = F.filter(table, lambda k: F.contains(lowered, k["word"]))
    return F.array_sort(
        F.transform(
            found,
            lambda k: F.struct(
                k["rank"].alias("rank"), F.instr(lowered, k["word"]).alias("position"),
                k["keyword"].alias("keyword"), k["category"].alias("category"),
            ),
        )
    )


def with_category(
    df: DataFrame, text: str = "item_description",
    keywords: list[tuple[str, str, int]] | None = None,
) -> DataFrame:
    """Add ``keywords_found``, ``final_category`` and ``highest_priority``.

    Rows without any keyword are dropped, by one search for all of them.
    """
    keywords = keywords or CATEGORY_KEYWORDS
    any_word = "|".join(re.escape(word.lower()) for word, _, _ in keywords)
    lowered = F.lower(text)
    return (
        df.filter(lowered.rlike(any_word))
        .withColumn("_m", keyword_matches(lowered, keywords))
        .withColumns(
            {
                "keywords_found": F.array_join(
                    F.array_sort(F.transform("_m", lambda m: m["keyword"])), ", "
                ),
                "final_category": F.get("_m", F.lit(0))["category"],
                "highest_priority": -F.get("_m", F.lit(0))["rank"],
            }
        )
        .drop("_m")
    )


def category_discrepancies(
    df: DataFrame,
    keywords: list[tuple[str, str, int]] | None = None,
    flags: list[tuple[str, str]] | None = None,
    text: str = "item_description",
) -> DataFrame:
    """Rows whose text says one category while its flag column does not.

    A NULL flag gives no discrepancy. One output row per input row.
    """
    message = None
    for category, flag in flags or CATEGORY_FLAGS:
        wrong = (F.col("final_category") == category) & ~F.lower(F.col(flag)).isin(TRUE_FLAGS)
        words = F.lit(f"Should be marked as {category} but {flag} column is not true")
        message = F.when(wrong, words) if message is None else message.when(wrong, words)
    return (
        with_category(df, text, keywords)
        .withColumn("discrepancy_type", message)
        .filter(F.col("discrepancy_type").isNotNull())
    )


# -- exclusions -------------------------------------------------------------


def exclusion_report(
    df: DataFrame, terms: list[str] | None = None, text: str = "item_description"
) -> DataFrame:
    """Lines that hold an excluded word but are not handled as excluded.

    For the first word found, in list order: one issue when the flag is not
    exactly Y, and one when potential earnings are filled (0 is filled).
    """
    flag = clean_text(F.col("exclude"))
    term = F.col("_term")
    filled = F.col("potential_earnings").cast("string")
    issues = F.array_compact(
        F.array(
            F.when(flag != "Y", F.concat(F.lit('Found "'), term, F.lit('" but exclude is not "Y"'))),
            F.when(
                F.coalesce(clean_text(filled) != "", F.lit(False)) & filled.isNotNull(),
                F.concat(F.lit('Found "'), term, F.lit('" but potential_earnings is not empty')),
            ),
        )
    )
    return (
        df.withColumn("_term", first_containing(F.col(text), terms or EXCLUSION_TERMS))
        .filter(term.isNotNull())
        .select(
            "contractor_name",
            "file_name",
            text,
            flag.alias("exclude"),
            F.explode(issues).alias("issue_type"),
        )
    )


# -- file counts ------------------------------------------------------------


def loaded_counts(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Rows per trimmed, non-blank file name."""
    return (
        df.select(clean_text(F.col(name)).alias("file_name"))
        .filter(F.col("file_name") != "")
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("db_count"))
    )


def reconcile_counts(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Expected (file_name, input_count) lines against ``loaded_counts``, both ways.

    Repeated expected lines stay repeated.
    """
    listed = expected.withColumn("_listed", F.lit(True))
    numbers = F.concat(
        F.lit("found (count mismatch: input="), "input_count", F.lit(", db="), "db_count", F.lit(")")
    )
    status = (
        F.when(F.col("_listed").isNull(), "MISSING")
        .when(F.col("db_count").isNull(), "not found")
        .when(F.col("input_count").isNull(), "found (no input count)")
        .when(F.col("input_count") == F.col("db_count"), "found (count matches)")
        .otherwise(numbers)
    )
    return listed.join(loaded, "file_name", "full_outer").select(
        "file_name", "input_count", "db_count", status.alias("status")
    )


def reconcile_summary(result: DataFrame) -> DataFrame:
    """Lines per status, mismatches as one class."""
    status = F.when(
        F.col("status").contains("count mismatch"), "found (count mismatch)"
    ).otherwise(F.col("status"))
    return result.groupBy(status.alias("status_class")).agg(F.count(F.lit(1)).alias("n_files"))


# -- file totals ------------------------------------------------------------


def file_totals(
    grid: DataFrame,
    amount_header: str = "extended_price",
    unreadable: DataFrame | None = None,
    sheets: DataFrame | None = None,
) -> DataFrame:
    """(file_name, transaction_count, sales_total) of the first usable sheet of each file.

    The header is the first row with the amount column's name. Rows below it with
    two filled cells are counted; amounts that are not plain numbers, or have more than 28
    whole digits, do not add. A
    file without a usable sheet or header has 0 and 0, an unreadable one NULLs. ``sheets``
    names the sheets that may have no row; see ``sheet_list``.
    """
    chosen = settled(first_usable_sheet(sheet_list(grid, sheets)))
    usable = chosen.filter(F.col("sheet_name").isNotNull())
    rows = attach(
        grid.select(*SHEET, "row_idx", "cells"), usable, SHEET, how="left_semi",
        computed=True,
    )
    place = F.array_position(
        F.transform("cells", lambda c: F.lower(clean_text(c))), amount_header
    ).cast("int")

    def test(part: DataFrame) -> DataFrame:
        return (
            part.withColumn("place", place)
            .filter(F.col("place") > 0)
            .select(*SHEET, "row_idx", F.struct("place").alias("found"))
        )

    headers = first_row_where(rows, test).select(
        *SHEET, "header_row", F.col("found.place").alias("place")
    )
    amount = plain_number(F.get(F.col("cells"), F.col("place") - 1)).try_cast("decimal(38,10)")
    totals = (
        attach(rows, headers, SHEET)
        .filter(F.col("row_idx") > F.col("header_row"))
        .groupBy("file_name")
        .agg(
            F.count_if(non_null_cells(F.col("cells")) >= 2).alias("transaction_count"),
            F.sum(amount).cast("double").alias("sales_total"),
        )
    )
    result = chosen.select("file_name").join(totals, "file_name", "left").select(
        "file_name",
        F.coalesce("transaction_count", F.lit(0)).cast("long").alias("transaction_count"),
        F.coalesce("sales_total", F.lit(0.0)).alias("sales_total"),
    )
    if unreadable is not None:
        result = result.unionByName(unreadable.select("file_name"), allowMissingColumns=True)
    # The mark keeps spreadsheets from reading the name as a number or date.
    return result.withColumn("file_name", F.concat(F.lit("'"), "file_name"))
