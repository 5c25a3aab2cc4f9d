"""Conversion of files with unknown headers to the ten-column template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.config import (
    REQUIRED_TWO,
    TEMPLATE_ALIASES,
    TEMPLATE_FIELDS,
    TEMPLATE_NUMBERS,
    TEMPLATE_SHEET,
)
from saleswright.functions.cleaning import clean_text, derived_unit_price, number
from saleswright.functions.text import file_stem, header_signature
from saleswright.operators import aliases as al
from saleswright.operators.grids import (
    SHEET,
    alias_headers,
    choose_sheet,
    fullest_headers,
    is_data_row,
    sheet_list,
)
from saleswright.scale import attach, settled


def with_contractor(files: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """The contractor of each file: its override, else the file stem in words.

    ``overrides`` comes from ``sources.files.clean_overrides``.
    """
    stem = file_stem(F.col("file_name"))
    if overrides is None:
        return files.withColumn("contractor", stem)
    # A missing name falls back to the file; other facts stay as listed.
    listed = overrides.withColumnRenamed("contractor", "_listed")
    return (
        files.withColumn("file_key", F.lower("file_name"))
        .join(listed, "file_key", "left")
        .withColumn("contractor", F.coalesce(F.when(F.col("_listed") != "", F.col("_listed")), stem))
        .drop("file_key", "_listed")
    )


def scan_files(
    grid: DataFrame,
    aliases: dict[str, list[str]] | None = None,
    required: list[str] | None = None,
    overrides: DataFrame | None = None,
    saved: DataFrame | None = None,
    confirmed: DataFrame | None = None,
    sheet: str = TEMPLATE_SHEET,
    unreadable: DataFrame | None = None,
    sheets: DataFrame | None = None,
) -> DataFrame:
    """One row per file: its sheet, header, column positions and status.

    ``confirmed`` (file_name, confirmed_map) holds positions a person chose; they
    win over detected and saved ones. ``unreadable`` (file_name, error) adds files
    that could not be read. ``sheets`` names the sheets that may have no row; see
    ``sheet_list``. Status is ready, needs_mapping or error.
    """
    aliases = aliases or TEMPLATE_ALIASES
    required = REQUIRED_TWO if required is None else required
    chosen = settled(choose_sheet(sheet_list(grid, sheets), sheet))
    # Rows of other sheets are dropped before the header search.
    wanted = attach(grid, chosen, SHEET, how="left_semi", computed=True)
    found = alias_headers(wanted, aliases)
    fallback = fullest_headers(wanted).withColumnsRenamed(
        {"header_row": "fallback_row", "header_cells": "fallback_cells"}
    )
    none = F.create_map().cast("map<string,int>")
    files = (
        chosen.join(found, SHEET, "left")
        .join(fallback, SHEET, "left")
        .withColumn("header_cells", F.coalesce("header_cells", "fallback_cells"))
        .withColumn("signature", header_signature(F.coalesce("header_cells", F.array())))
        .withColumn("detected_row", F.col("header_row"))
        .withColumn("header_row", F.coalesce("header_row", "fallback_row"))
    )
    files = (
        al.apply_saved(files, saved)
        if saved is not None
        else files.withColumn("from_saved", F.lit(False))
    )
    if confirmed is not None:
        files = (
            files.join(confirmed, "file_name", "left")
            .withColumn(
                "col_map",
                al.merge_maps(F.coalesce("col_map", none), F.col("confirmed_map")),
            )
            .drop("confirmed_map")
        )
    # Data starts below the header the map belongs to; a map that a person made
    # without any detected header belongs to the first row.
    start = F.when(F.col("detected_row").isNotNull() | F.col("from_saved"), F.col("header_row"))
    files = (
        files.withColumn("col_map", F.coalesce("col_map", none))
        .withColumn("missing", al.missing_fields(F.col("col_map"), required))
        .withColumn("map_row", F.coalesce(start, F.lit(1)).cast("long"))
        .withColumn(
            "status",
            F.when(F.size("missing") == 0, "ready").otherwise("needs_mapping"),
        )
        .withColumn("error", F.lit(None).cast("string"))
    )
    files = with_contractor(files, overrides).drop("fallback_row", "fallback_cells", "detected_row")
    if unreadable is not None:
        broken = unreadable.select(
            "file_name", F.lit("error").alias("status"), F.col("error").cast("string")
        )
        files = files.unionByName(broken, allowMissingColumns=True)
    return files


def template_records(grid: DataFrame, files: DataFrame, computed: bool = False) -> DataFrame:
    """Records of the ready files, ten columns after the file and row.

    ``computed`` says that ``files`` comes from ``settled``.
    """
    ready = files.filter(F.col("status") == "ready").select(
        *SHEET, "col_map", "map_row", "contractor"
    )
    rows = attach(
        grid.select(*SHEET, "row_idx", "cells"), ready, SHEET, computed=computed
    )
    rows = rows.filter((F.col("row_idx") > F.col("map_row")) & is_data_row(F.col("cells")))

    def cell(name: str):
        return F.get(F.col("cells"), F.try_element_at("col_map", F.lit(name)))

    text = {f: clean_text(cell(f)) for f in TEMPLATE_FIELDS if f not in TEMPLATE_NUMBERS}
    named = (text["sales_order_number"] != "") | (text["item_sku"] != "") | (
        text["item_description"] != ""
    )
    contractor = F.when(text["contractor_name"] != "", text["contractor_name"]).otherwise(
        F.col("contractor")
    )
    values = {**text, "contractor_name": contractor}
    values |= {f: number(cell(f)) for f in TEMPLATE_NUMBERS}
    typed = rows.filter(named).select(
        "file_name", "row_idx", *[values[f].alias(f) for f in TEMPLATE_FIELDS]
    )
    price = derived_unit_price(
        F.col("unit_price"), F.col("extended_price"), F.col("ship_quantity")
    )
    return typed.withColumn("unit_price", price)


def convert_template(grid: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Records and file status; see ``scan_files`` for the options."""
    files = settled(scan_files(grid, **options))
    return template_records(grid, files, computed=True), files
