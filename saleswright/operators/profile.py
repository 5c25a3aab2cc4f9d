"""Sheet profiling: header row, data range and field mapping per sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.config import (
    CREDIT_ALIASES,
    CREDIT_PROFILE,
    HEADER_MIN_SHARE,
    HEADER_SCAN_ROWS,
    LAYOUT_RULES,
    LayoutRule,
    ProfileVariant,
)
from saleswright.functions.cleaning import clean_text
from saleswright.functions.text import number_to_letters, quote_or_null
from saleswright.operators.aliases import header_for, layout_overrides
from saleswright.operators.grids import SHEET, non_null_cells


def row_density(grid: DataFrame) -> DataFrame:
    """Per sheet and number of filled cells: how many rows, and the first and last.

    The first rows, where the header is looked for, are kept one by one with their
    cells. They are counted apart from the many others, as an aggregate that holds cells has to
    sort its rows. The result has at most as many rows per sheet as the sheet has columns, plus ten.
    """
    head = F.when(F.col("row_idx") <= HEADER_SCAN_ROWS, F.col("row_idx"))
    rows = grid.select(
        *SHEET,
        "sheet_ordinal",
        "row_idx",
        head.alias("head_row"),
        non_null_cells(F.col("cells")).alias("filled"),
        F.size("cells").alias("width"),
        F.when(head.isNotNull(), F.col("cells")).alias("head_cells"),
    )
    counts = [
        F.count(F.lit(1)).alias("n"),
        F.min("row_idx").alias("first_row"),
        F.max("row_idx").alias("last_row"),
        F.max("width").alias("width"),
        F.min("sheet_ordinal").alias("sheet_ordinal"),
    ]
    near = rows.filter(F.col("head_row").isNotNull()).groupBy(*SHEET, "head_row", "filled").agg(
        *counts, F.max("head_cells").alias("head_cells")
    )
    far = rows.filter(F.col("head_row").isNull()).groupBy(*SHEET, "filled").agg(*counts)
    return near.unionByName(far, allowMissingColumns=True)


def densest_headers(density: DataFrame) -> DataFrame:
    """Per sheet, the fullest of the first ten rows, the first of equals.

    A sheet whose fullest row fills no more than 30 percent has no header.
    """
    rank = F.when(F.col("head_row").isNotNull(), F.struct("filled", -F.col("head_row")))
    best = density.groupBy(*SHEET).agg(
        F.max("width").alias("width"),
        F.min("sheet_ordinal").alias("sheet_ordinal"),
        F.max_by("head_row", rank).alias("best_row"),
        F.max_by("filled", rank).alias("best_filled"),
        F.max_by("head_cells", rank).alias("best_cells"),
    )
    is_header = F.col("best_filled") / F.col("width") > HEADER_MIN_SHARE
    # Short rows are as wide as the sheet.
    padding = F.array_repeat(F.lit(""), F.col("width") - F.size("best_cells"))
    headers = F.concat(F.transform("best_cells", clean_text), padding)
    return best.select(
        *SHEET,
        "sheet_ordinal",
        "width",
        F.when(is_header, F.col("best_row")).alias("header_row"),
        F.when(is_header, headers).alias("headers"),
    )


def data_ranges(density: DataFrame, headers: DataFrame, variant: ProfileVariant) -> DataFrame:
    """Header and data ranges and the row count of each sheet."""
    named = F.size(F.filter("headers", lambda h: h != ""))
    share = (
        F.lit(variant.row_share)
        if variant.row_share is not None
        else F.greatest(F.lit(0.1), named / F.col("width") * 0.5)
    )
    after = (
        F.col("first_row") > F.col("header_row")
        if variant.range_from_header
        else F.col("first_row") >= F.col("header_row")
    )
    rows = (
        density.select(*SHEET, "filled", "n", "first_row", "last_row")
        .join(headers.withColumn("share", share), SHEET)
        .filter(after & (F.col("filled") / F.col("width") >= F.col("share")))
        .groupBy(*SHEET)
        .agg(
            F.min("first_row").alias("first_row"),
            F.max("last_row").alias("last_row"),
            F.sum("n").alias("n"),
        )
    )
    last = number_to_letters(F.col("width"))
    top = F.col("header_row") if variant.range_from_header else F.col("first_row")
    some = F.col("n").isNotNull()

    def span(first_row, last_row):
        return F.concat(F.lit("A"), first_row, F.lit(":"), last, last_row)

    count = F.col("n") if variant.range_from_header else F.col("n") - 1
    return headers.join(rows, SHEET, "left").select(
        *SHEET,
        "sheet_ordinal",
        "headers",
        F.when(some, span(top, F.col("last_row"))).otherwise("").alias("data_range"),
        F.when(
            F.col("header_row").isNotNull(), span(F.col("header_row"), F.col("header_row"))
        ).otherwise("").alias("header_range"),
        F.when(some, count).otherwise(F.lit(0)).alias("rows_count"),
    )


def profile_files(
    grid: DataFrame,
    aliases: dict[str, list[str]] | None = None,
    variant: ProfileVariant = CREDIT_PROFILE,
    rules: list[LayoutRule] | None = None,
    unreadable: DataFrame | None = None,
    sheets: DataFrame | None = None,
) -> DataFrame:
    """One mapping row per sheet, ready for people to edit.

    ``aliases`` is the field -> header words dictionary, built in for the credit variant
    and required for the base one. The credit variant
    applies layout rules after it. ``unreadable`` (file_name, error) adds one ERROR row
    per file to the credit variant. ``sheets`` (file_name, sheet_name, sheet_ordinal) names the
    sheets that may have no row; they are profiled as sheets without a header.
    """
    credit = not variant.range_from_header
    if aliases is None:
        if not credit:
            raise ValueError("the base variant needs a header dictionary; see read_aliases")
        aliases = CREDIT_ALIASES
    density = row_density(grid)
    if sheets is not None:
        # No row, which is neither a header nor data, and as narrow as can be.
        none = {"filled": F.lit(0), "n": F.lit(0), "width": F.lit(1)}
        empty = sheets.select(*SHEET, "sheet_ordinal").withColumns(none)
        density = density.unionByName(empty, allowMissingColumns=True)
    found = densest_headers(density)
    ranges = data_ranges(density, found, variant)
    ranges = ranges.withColumn(
        "header_cells", F.coalesce("headers", F.array().cast("array<string>"))
    ).drop("headers")
    headers = F.col("header_cells")
    overrides = layout_overrides(headers, LAYOUT_RULES if rules is None else rules)
    fields = []
    for name in variant.fields:
        matched = quote_or_null(
            header_for(headers, aliases.get(name, []), variant.skip_single_letters)
            if aliases.get(name)
            else F.lit(None).cast("string")
        )
        if credit:
            forced = F.try_element_at(F.col("overrides"), F.lit(name))
            matched = F.when(forced.isNotNull(), quote_or_null(forced)).otherwise(matched)
        # A sheet without a header has no mapping at all.
        fields.append(F.when(F.size(headers) > 0, matched).otherwise("").alias(name))
    constants = {
        "payment_run": F.lit("YYYYMMDD"),
        "structure_type": F.lit("unspecified"),
        "headers": F.array_join(headers, "|"),
        "use_header": F.when(F.size(headers) > 0, "TRUE").otherwise("FALSE"),
        "rows_count": F.col("rows_count").cast("string"),
        "process": F.lit("TRUE"),
    }
    order = ["payment_run", "file_name", "sheet_name", "structure_type", "headers", "data_range",
             "header_range", "use_header", "rows_count", "process"]
    rows = ranges.withColumn("overrides", overrides).select(
        *[constants.get(c, F.col(c)).alias(c) for c in order],
        *[F.lit("").alias(c) for c in variant.extra],
        *fields,
    )
    if unreadable is not None and credit:
        errors = unreadable.select(
            "file_name",
            F.lit("ERROR").alias("sheet_name"),
            F.lit("unspecified").alias("structure_type"),
            *[F.lit("").alias(c) for c in ("headers", "data_range", "header_range")],
            F.lit("FALSE").alias("use_header"),
            F.lit("0").alias("rows_count"),
            F.lit("TRUE").alias("process"),
            *[F.lit("NULL").alias(c) for c in variant.fields],
        )
        rows = rows.unionByName(errors, allowMissingColumns=True).na.fill("")
    return rows
