"""Customer names of credit files: from the mapping, or from the mapped column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.functions.cleaning import clean_text
from saleswright.functions.text import (
    dollar_literal,
    is_letters,
    letters_to_number,
    parse_range,
    strip_quotes,
)
from saleswright.operators.grids import SHEET
from saleswright.scale import attach, settled
from saleswright.sources.files import lower_names

MAPPING_FIELDS = ["file_name", "sheet_name", "customer_name", "header_range", "data_range"]


def customer_name_mapping(mapping: DataFrame) -> DataFrame:
    """Mapping rows with a customer name, split into static values and lookups.

    Column names may be in any case. A value between ``$$`` marks is static and
    leaves the column to look up empty.
    """
    rows = lower_names(mapping)
    source = clean_text(F.col("source_file")) if "source_file" in rows.columns else F.lit("")
    pos = [F.col("pos")] if "pos" in rows.columns else []
    named = rows.select(
        *pos,
        source.alias("source_file"),
        *[
            (clean_text(F.col(c)) if c in rows.columns else F.lit("")).alias(c)
            for c in MAPPING_FIELDS
        ],
    ).filter(F.col("customer_name") != "")
    static = dollar_literal(F.col("customer_name"))
    return named.withColumn("static_value", F.coalesce(static, F.lit(""))).withColumn(
        "customer_name", F.when(F.col("static_value") != "", "").otherwise(F.col("customer_name"))
    )


def static_customers(tasks: DataFrame) -> DataFrame:
    """Static values as they are listed, repeated ones too."""
    return tasks.filter((F.col("file_name") != "") & (F.col("static_value") != "")).select(
        "file_name", F.col("static_value").alias("customer_name")
    )


def lookup_tasks(tasks: DataFrame) -> DataFrame:
    """One task per file, sheet and column; the first listed keeps its ranges.

    Needs ``pos``, the position of a row in the mapping.
    """
    keys = ["file_name", "sheet_name", "customer_name"]
    filled = F.col("static_value") == ""
    for c in keys:
        filled = filled & (F.col(c) != "")
    return (
        tasks.filter(filled)
        .groupBy(*keys)
        .agg(F.min_by(F.struct("header_range", "data_range"), "pos").alias("r"))
        .select(*keys, "r.*")
    )


def locate_columns(tasks: DataFrame, grid: DataFrame) -> DataFrame:
    """Add ``place``, the 0-based cell index of each task's column.

    A column name of one to three letters is an address; other names are looked for in
    the header range, row by row. Tasks without a column or data range drop out.
    """
    ranged = settled(
        tasks.withColumn("wanted", strip_quotes(F.col("customer_name")))
        .withColumn("h", parse_range(F.col("header_range")))
        .withColumn("d", parse_range(F.col("data_range")))
        .filter(F.col("d").isNotNull())
    )
    by_letter = ranged.filter(is_letters(F.col("wanted"), 3)).withColumn(
        "place", letters_to_number(F.col("wanted")) - 1
    )
    by_name = ranged.filter(~is_letters(F.col("wanted"), 3) & F.col("h").isNotNull())
    last = by_name.agg(F.max("h.end_row")).first()[0]
    if last is None:
        return by_letter
    near = grid.filter(F.col("row_idx") <= last).select(*SHEET, "row_idx", "cells")
    names = F.slice(
        "cells", F.col("h.start_col"), F.greatest(F.col("h.end_col") - F.col("h.start_col") + 1, F.lit(0))
    )
    at = F.array_position(F.transform(names, lambda c: strip_quotes(c)), F.col("wanted")).cast("int")
    found = (
        attach(near, by_name, SHEET)
        .filter(F.col("row_idx").between(F.col("h.start_row"), F.col("h.end_row")))
        .withColumn("at", at)
        .filter(F.col("at") > 0)
        .groupBy(*SHEET, "customer_name")
        .agg(F.min_by("at", "row_idx").alias("at"))
    )
    located = by_name.join(found, [*SHEET, "customer_name"]).withColumn(
        "place", F.col("h.start_col") + F.col("at") - 2
    )
    return by_letter.unionByName(located.drop("at"))


def customer_values(mapping: DataFrame, grid: DataFrame) -> DataFrame:
    """(file_name, customer_name): static values and the distinct names in mapped columns.

    Blank cells and the header text itself do not count. ``first_row`` is the row a
    looked-up name first occurs in, NULL for static values.
    """
    tasks = locate_columns(lookup_tasks(mapping), grid).select(
        *SHEET, "customer_name", "wanted", "place",
        F.col("d.start_row").alias("from_row"), F.col("d.end_row").alias("to_row"),
    )
    value = clean_text(F.get(F.col("cells"), F.col("place")))
    found = (
        attach(grid.select(*SHEET, "row_idx", "cells"), tasks, SHEET)
        .filter(F.col("row_idx").between(F.col("from_row"), F.col("to_row")))
        .select(*SHEET, F.col("customer_name").alias("_column"), "wanted", "row_idx", value.alias("customer_name"))
        .filter((F.col("customer_name") != "") & (F.col("customer_name") != F.col("wanted")))
        .groupBy(*SHEET, "_column", "customer_name")
        .agg(F.min("row_idx").alias("first_row"))
        .select("file_name", "customer_name", "first_row")
    )
    return static_customers(mapping).unionByName(found, allowMissingColumns=True)
