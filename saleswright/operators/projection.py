"""Mapping rows to typed ledger rows, for all files in one plan.

The mapping stays data: each mapping row carries, per field, a 0-based cell
index or a literal. The plan does not grow with the number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.config import (
    FIELD_SPELLINGS,
    NO_HEADER_VALUES,
    NOT_COUNTED_FOR_BLANK,
    PROCESS_VALUES,
    TRANSACTION_TYPE,
    Ledger,
)
from saleswright.functions import cleaning as cl
from saleswright.functions.text import (
    dollar_literal,
    is_letters,
    is_quoted,
    letters_to_number,
    parse_range,
    stable_uuid,
)
from saleswright.operators.conditions import (
    CAST,
    Condition,
    check_conditions,
    judged,
    with_condition_places,
)
from saleswright.operators.grids import SHEET
from saleswright.scale import attach, fits_broadcast, settled

MAPPING_ROW = "mapping_row"
# Rows of a block, about, which one task sorts together. Most sheets are one block, which needs no
# facts about the blocks before it.
BLOCK_ROWS = 1_000_000
# A block of a sheet whose rows lie unevenly may hold so many times more.
UNEVEN = 4


def block_widths(grid: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The sheets of more than one block: ``width``, sheet rows of a block, and the ``last`` block.

    Sheets may be sparse, so the width follows from the rows that are there: blocks are as many as
    the rows need, however far their numbers reach. Where rows lie so unevenly that a block
    would be too large, a block is ``block_rows`` sheet rows, which cannot hold more.
    """
    share = F.lit(block_rows) / F.count(F.lit(1))
    width = F.greatest(F.ceil((F.max("row_idx") + 1) * share), F.lit(block_rows))
    large = settled(
        grid.groupBy(*SHEET)
        .agg(width.alias("width"), F.max("row_idx").alias("end"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > block_rows)
        .drop("n")
    )
    if not large.isEmpty():
        cut = F.floor(F.col("row_idx") / F.col("width"))
        rows = attach(grid.select(*SHEET, "row_idx"), large, SHEET, computed=True)
        fullest = (
            rows.groupBy(*SHEET, cut.alias("block")).agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*SHEET).agg(F.max("n").alias("fullest"))
        )
        even = F.col("fullest") <= UNEVEN * block_rows
        width = F.when(even, F.col("width")).otherwise(F.lit(block_rows)).alias("width")
        large = settled(large.join(fullest, SHEET).select(*SHEET, width, "end"))
    return large.select(*SHEET, "width", F.floor(F.col("end") / F.col("width")).alias("last"))


def with_blocks(grid: DataFrame, widths: DataFrame) -> DataFrame:
    """Add ``block``, a stretch of sheet rows. Large sheets are few, as each has many rows."""
    met = grid.join(F.broadcast(widths.drop("last")), SHEET, "left")
    block = F.coalesce(F.floor(F.col("row_idx") / F.col("width")), F.lit(0)).cast("long")
    return met.withColumn("block", block).drop("width")


def active_mapping(mapping: DataFrame, ledger: Ledger) -> DataFrame:
    """Mapping rows to process, with the loader's spelling of every field.

    A row counts when its process flag is TRUE, 1, YES or Y (or there is no such
    column) and it names a file. ``mapping_row`` identifies a row.
    """
    names = set(mapping.columns)
    for old, new in FIELD_SPELLINGS.items():
        if old in names and new not in names:
            mapping = mapping.withColumnRenamed(old, new)
        elif old in names:
            mapping = mapping.withColumn(
                new, F.when(cl.blank(F.col(new)), F.col(old)).otherwise(F.col(new))
            ).drop(old)
    wanted = ["file_name", "sheet_name", "data_range", "header_range", "use_header", "process",
              "filter", *ledger.static, *[f for f, _ in ledger.mapped]]
    known = set(mapping.columns)
    defaults = {"process": "TRUE", "use_header": "TRUE"}
    rows = mapping.select(
        *[
            (cl.clean_text(F.col(c)) if c in known else F.lit(defaults.get(c, ""))).alias(c)
            for c in dict.fromkeys(wanted)
        ],
        *([MAPPING_ROW] if MAPPING_ROW in known else []),
    )
    if MAPPING_ROW not in known:
        # Rows that are alike in every column are still loaded once each.
        alike = F.xxhash64(*rows.columns)
        copy = F.row_number().over(Window.partitionBy(alike).orderBy(alike))
        rows = rows.withColumn("_copy", copy).withColumn(MAPPING_ROW, F.xxhash64(*rows.columns, "_copy"))
        rows = rows.drop("_copy")
    kept = F.upper("process").isin(PROCESS_VALUES) & (F.col("file_name") != "")
    return rows.filter(kept).drop("process")


def clean_filter(text: Column) -> Column:
    """Row condition without a leading WHERE; NULL when there is none."""
    bare = cl.strip(F.regexp_replace(cl.strip(text), r"(?i)^\s*WHERE\s+", ""))
    return F.when(~cl.is_no_value(text) & (bare != ""), bare)


def with_ranges(mapping: DataFrame) -> DataFrame:
    """Header row and the bounds of the cells below it.

    A header range moves the start of the data range up to its row; without one
    the first row of the range is the header.
    """
    mapping = mapping.withColumn("_data", parse_range(F.col("data_range")))
    data = F.col("_data")
    given_header = F.regexp_extract("header_range", r"^[A-Z]+([0-9]+)", 1).try_cast("long")
    use_header = ~F.upper("use_header").isin(NO_HEADER_VALUES)
    start = F.when(
        use_header & given_header.isNotNull() & data.isNotNull(), given_header
    ).otherwise(F.coalesce(data["start_row"], F.lit(1)))
    return (
        mapping.withColumn("use_header", use_header)
        .withColumn("header_row", F.when(F.col("use_header"), start))
        .withColumn("from_row", F.when(F.col("use_header"), start + 1).otherwise(start))
        .withColumn("to_row", F.coalesce(data["end_row"], F.lit(2**62)))
        .withColumn("from_col", F.coalesce(data["start_col"] - 1, F.lit(0)).cast("int"))
        .withColumn("to_col", F.coalesce(data["end_col"] - 1, F.lit(2**20)).cast("int"))
        .withColumn("predicate", clean_filter(F.col("filter")))
        .drop("_data")
    )


def with_header_cells(mapping: DataFrame, grid: DataFrame) -> DataFrame:
    """Fetch the header cells of each mapping row.

    Only grid rows up to the last header row are read.
    """
    places = settled(mapping.select(*SHEET, F.col("header_row").alias("row_idx")).distinct().dropna())
    last = places.agg(F.max("row_idx")).first()[0]
    if last is None:
        return mapping.withColumn("header_cells", F.array().cast("array<string>"))
    near = grid.filter(F.col("row_idx") <= last).select(*SHEET, "row_idx", "cells")
    cells = attach(near, places, [*SHEET, "row_idx"], computed=True).withColumnsRenamed(
        {"row_idx": "header_row", "cells": "header_cells"}
    )
    return mapping.join(cells, [*SHEET, "header_row"], "left").withColumn(
        "header_cells", F.coalesce("header_cells", F.array().cast("array<string>"))
    )


def resolve_fields(mapping: DataFrame, ledger: Ledger) -> DataFrame:
    """Turn each mapping value into a cell index or a literal.

    Adds arrays in the order of ``field_order``: ``places`` (cell index), ``texts``
    (literal) and ``counted`` (the field makes a row non-blank); and ``unresolved``,
    the fields whose column does not exist. With a header, quoted names and 1-2
    letter values are header texts; without one they are column addresses.
    """
    fields = field_order(ledger)
    inside = F.transform(
        F.col("header_cells"),
        lambda h, i: F.when(i.between(F.col("from_col"), F.col("to_col")), F.lower(cl.clean_text(h))),
    )
    names = F.array(*[F.lit(f) for f in fields])
    not_counted = F.array(*[F.lit(f) for f in NOT_COUNTED_FOR_BLANK])

    def shape(value: Column, i: Column) -> Column:
        none, literal = cl.is_no_value(value), dollar_literal(value)
        quoted, letters = is_quoted(value), is_letters(value)
        return F.struct(
            i.alias("i"),
            value.alias("value"),
            none.alias("none"),
            literal.alias("literal"),
            quoted.alias("quoted"),
            F.upper(value).alias("upper"),
            ((i >= len(ledger.static)) & ~none & literal.isNull() & (quoted | letters)).alias("from_cell"),
        )

    def resolved(s: Column) -> Column:
        value, name = s["value"], F.get(names, s["i"])
        wanted = F.when(s["quoted"], F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(s["upper"])
        by_name = F.array_position("_names", F.lower(cl.strip(wanted))).cast("int") - 1
        by_letter = letters_to_number(s["upper"]) - 1
        by_letter = F.when(
            by_letter.between(F.col("from_col"), F.col("to_col")), by_letter
        ).otherwise(F.lit(-1))
        place = F.when(s["from_cell"], F.when(F.col("use_header"), by_name).otherwise(by_letter))
        counted = (
            (s["i"] >= len(ledger.static)) & ~s["none"] & s["literal"].isNull()
            & ~F.array_contains(not_counted, name)
        )
        return F.struct(
            place.alias("place"),
            F.when(~s["none"] & ~s["from_cell"], F.coalesce(s["literal"], value)).alias("text"),
            counted.alias("counted"),
            name.alias("name"),
        )

    # The fields of a mapping row stay one array, so its other columns are not copied for each.
    kept = [c for c in mapping.columns if c not in fields]
    shaped = mapping.select(*kept, inside.alias("_names"), F.transform(F.array(*fields), shape).alias("f"))
    lists = shaped.select(*kept, F.transform("f", resolved).alias("f"))
    missing = F.filter("f", lambda f: f["place"] < 0)
    return lists.select(
        *kept,
        F.transform("f", lambda f: f["place"]).alias("places"),
        F.transform("f", lambda f: f["text"]).alias("texts"),
        F.transform("f", lambda f: f["counted"]).alias("counted"),
        F.transform(missing, lambda f: f["name"]).alias("unresolved"),
    )


def field_order(ledger: Ledger) -> list[str]:
    """The fields a mapping row fills: literals first, then cells."""
    return [*ledger.static, *[f for f, _ in ledger.mapped]]


CLEANERS = {
    "date": cl.sales_date,
    "decimal(10,2)": cl.amount,
    "int": cl.quantity,
}
BAD_VALUE = {"decimal(10,2)": cl.bad_amount, "int": cl.bad_quantity}


def prepare_mapping(mapping: DataFrame, grid: DataFrame, ledger: Ledger) -> DataFrame:
    """Active mapping rows with their ranges, header cells and resolved fields."""
    ranged = with_ranges(active_mapping(mapping, ledger))
    return settled(resolve_fields(with_header_cells(ranged, grid), ledger))


PLAN_COLUMNS = [MAPPING_ROW, *SHEET, "from_row", "to_row", "predicate", "name_places",
                "places", "texts", "counted"]


def checked_mapping(prepared: DataFrame) -> tuple[DataFrame, list[Condition]]:
    """Add what is wrong with a mapping row before rows are read: ``condition_error``."""
    conditions = check_conditions(prepared)
    return with_condition_places(prepared, conditions), conditions


def rows_in_range(
    grid: DataFrame, checked: DataFrame, conditions: list[Condition], ledger: Ledger,
    only_counts: bool = False, by_block: bool = False,
) -> DataFrame:
    """Every row in the range of a mapping row, with typed fields, before row numbers.

    ``loaded`` says whether the row passes the condition and has a counted field that is not
    NULL; ``cast_failed`` that the condition could not be evaluated for it. ``bad_fields`` lists
    fields whose text could not be read. Fields are NULL where a row is not loaded. Rows of mapping
    rows that are known to fail are only counted. With ``only_counts`` there are no fields, and
    cells are cleaned only where no counted text says already that the row is not blank.
    ``by_block`` says that blocks of sheet rows will be sorted: mapping rows that are too many to be
    broadcast then meet the rows by sheet and block, so that one shuffle serves both.
    """
    sound = (F.size("unresolved") == 0) & F.col("condition_error").isNull()
    usable = with_blank_test(checked, ledger).select(
        *PLAN_COLUMNS, "always", "text_places", sound.alias("sound")
    )
    grid = grid.select(*SHEET, "row_idx", "cells")
    keys = SHEET
    if by_block:
        widths = block_widths(grid)
        grid = with_blocks(grid, widths)
        keys = [*SHEET, "block"]
    if by_block and not fits_broadcast(usable):
        blocks = F.sequence(F.lit(0).cast("long"), F.greatest(F.coalesce("last", F.lit(0)), F.lit(0))).alias("blocks")
        facts = usable.join(F.broadcast(widths.drop("width")), SHEET, "left").select(*usable.columns, blocks)
        rows = attach(grid, facts.select(*usable.columns, F.explode("blocks").alias("block")), keys)
    else:
        rows = attach(grid, usable, SHEET, computed=True)
    rows = rows.filter(F.col("row_idx").between(F.col("from_row"), F.col("to_row")))
    # The condition of a mapping row that is not sound is not evaluated.
    rows = rows.withColumn("predicate", F.when(F.col("sound"), F.col("predicate")))
    place = {name: F.lit(i) for i, name in enumerate(field_order(ledger))}

    def raw(name: str) -> Column:
        cell = F.get("cells", F.get("places", place[name]))
        return F.coalesce(F.trim(cell), F.get("texts", place[name]))

    # All fields of a type are cleaned by one expression over an array. One expression
    # per field would make generated code too long to be compiled.
    of_type = {t: [n for n, u in ledger.mapped if u == t] for t in CLEANERS}
    wanted = F.col("sound") & F.col("passes")
    # Text cells come first: one of them is mostly filled, and the rest is not evaluated.
    present = F.col("always") | F.exists("text_places", lambda p: F.get("cells", p).isNotNull())
    to_clean = wanted & ~present if only_counts else wanted
    cleaned = judged(rows, conditions, keys).withColumns(
        {
            f"_{t}": F.when(to_clean, F.transform(F.array(*[raw(n) for n in names]), CLEANERS[t]))
            for t, names in of_type.items()
        }
    )
    value = {n: raw(n) for n in ledger.text_columns}
    value |= {n: F.get("texts", place[n]) for n in ledger.static}
    for t, names in of_type.items():
        value |= {n: F.get(f"`_{t}`", F.lit(i)) for i, n in enumerate(names)}

    for names in of_type.values():
        for n in names:
            present = present | (F.get("counted", place[n]) & value[n].isNotNull())
    kept = cleaned.withColumn("loaded", wanted & present)
    if only_counts:
        return kept.select(MAPPING_ROW, "loaded", "cast_failed")
    bad = [
        F.when(BAD_VALUE[t](raw(n), value[n]), F.lit(n))
        for t, names in of_type.items()
        if t in BAD_VALUE
        for n in names
    ]
    shown = F.col("loaded")
    return kept.select(
        MAPPING_ROW,
        *keys,
        "row_idx",
        "loaded",
        "cast_failed",
        *[F.when(shown, value[n]).alias(n) for n in field_order(ledger)],
        F.when(shown, F.array_compact(F.array(*bad))).alias("bad_fields"),
    )


def with_blank_test(prepared: DataFrame, ledger: Ledger) -> DataFrame:
    """Add what the blank-row test needs, per mapping row.

    ``always`` is true when no field is counted or a counted text field is a literal,
    and ``text_places`` are the cells of the counted text fields.
    """
    is_text = F.array(*[F.lit(n in ledger.text_columns) for n in field_order(ledger)])
    fields = F.arrays_zip(
        F.col("places").alias("p"), F.col("texts").alias("t"), F.col("counted").alias("c"),
        is_text.alias("is_text"),
    )
    texts = F.filter(fields, lambda f: f["c"] & f["is_text"])
    return prepared.withColumn(
        "always",
        ~F.array_contains("counted", True) | F.exists(texts, lambda f: f["p"].isNull()),
    ).withColumn("text_places", F.array_compact(F.transform(texts, lambda f: f["p"])))


def row_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows in range, loaded rows and rows whose condition failed, per mapping row (and block)."""
    return rows.groupBy(MAPPING_ROW, *keys).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if("loaded").alias("loaded_rows"),
        F.count_if("cast_failed").alias("failed_rows"),
    )


def _archive_name() -> Column:
    return F.regexp_extract("file_name", r"([^/]*)$", 1)


def placed_rows(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``block``, a stretch of sheet rows, unless it is there, and ``place``, the loaded rows in it so far.

    Only rows of one block meet in a task, so a file of any size is dealt over the cluster.
    """
    if "block" not in rows.columns:
        rows = rows.withColumn("block", F.floor(F.col("row_idx") / F.lit(block_rows)).cast("long"))
    # The number leads, as it is compared faster than names.
    so_far = (
        Window.partitionBy(MAPPING_ROW, "block", *SHEET)
        .orderBy("row_idx")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn("place", F.count_if("loaded").over(so_far))


def number_and_label(staged: DataFrame, ledger: Ledger, run_id: str = "") -> DataFrame:
    """The loaded rows of ``placed_rows``, numbered, with the ledger's columns in order.

    ``staged`` is a stored table: counts of its blocks, read from three narrow columns, give every
    block its first number, and the rows stay where they are. A mapping row whose condition failed
    for a row loads none.
    """
    of_row = Window.partitionBy(MAPPING_ROW)
    before = of_row.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each block of many sheet rows.
    starts = row_counts(staged, "block").select(
        MAPPING_ROW,
        "block",
        F.coalesce(F.sum("loaded_rows").over(before), F.lit(0)).alias("before"),
        F.sum("failed_rows").over(of_row).alias("failed"),
    )
    # Most blocks are the first of sound mapping rows, which need none of this.
    told = starts.filter("before > 0 OR failed > 0")
    numbered = attach(staged.filter("loaded"), told, [MAPPING_ROW, "block"], how="left").filter(
        "coalesce(failed, 0) = 0"
    )
    key = stable_uuid(
        F.lit(run_id), F.col("file_name"), F.col("sheet_name"),
        F.col(MAPPING_ROW).cast("string"), F.col("row_idx").cast("string"),
    )
    made = {
        "transaction_id": key,
        # row_id counts the kept rows of a mapping row in sheet order.
        "row_id": (F.coalesce("before", F.lit(0)) + F.col("place")).cast("int"),
        "type": F.lit(TRANSACTION_TYPE),
        "archive_file_name": _archive_name(),
    }
    return numbered.select(*[made.get(n, F.col(n)).alias(n) for n in ledger.names], "bad_fields")


def load_metadata(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """Rows in range against rows loaded, per mapping row, in one aggregate of ``rows_in_range``.

    ``status`` is loaded, or failed when a mapped column does not exist or the condition is
    wrong; ``missing_columns`` and ``condition_error`` say why.
    """
    zero = F.lit(0).cast("long")
    error = F.coalesce("condition_error", F.when(F.col("failed_rows") > 0, F.lit(CAST)))
    failed = (F.size("unresolved") > 0) | error.isNotNull()
    return (
        checked.select(MAPPING_ROW, *SHEET, "predicate", "unresolved", "condition_error")
        .join(row_counts(rows), MAPPING_ROW, "left")
        .select(
            _archive_name().alias("archive_file_name"),
            "sheet_name",
            F.coalesce("raw_rows", zero).alias("raw_rows"),
            F.when(failed, zero).otherwise(F.coalesce("loaded_rows", zero)).alias("loaded_rows"),
            F.col("predicate").isNotNull().alias("has_explicit_filter"),
            F.when(failed, "failed").otherwise("loaded").alias("status"),
            F.array_join("unresolved", ", ").alias("missing_columns"),
            F.coalesce(error, F.lit("")).alias("condition_error"),
        )
    )


def bad_values(rows: DataFrame, by: str = "archive_file_name") -> DataFrame:
    """Loaded fields whose text could not be read, counted per file, from ``rows_in_range``.

    Counts are made per mapping row, so that those of failed mapping rows can be left out.
    """
    nothing = F.array(F.lit(None).cast("string"))
    listed = F.concat(F.coalesce("bad_fields", F.array().cast("array<string>")), nothing)
    counted = (
        rows.select(MAPPING_ROW, "file_name", "cast_failed", F.explode(listed).alias("column_name"))
        .groupBy(MAPPING_ROW, "file_name", "column_name")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("cast_failed").alias("failed"))
    )
    failed = F.sum("failed").over(Window.partitionBy(MAPPING_ROW))
    return (
        counted.withColumn("failed", failed)
        .filter("column_name IS NOT NULL AND failed = 0")
        .groupBy(_archive_name().alias(by), "column_name")
        .agg(F.sum("n").alias("bad_values"))
    )
