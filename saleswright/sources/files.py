"""Tables, documents, configuration and text lists from files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.config import DOCUMENT_SCHEMA
from saleswright.functions.cleaning import clean_text, strip
from saleswright.functions.text import unescape_entities
from saleswright.scale import attach, settled
from saleswright.sources import versions
from saleswright.sources.envelopes import read_envelope


def _without_mark(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def read_delimited(
    spark: SparkSession, path: str, infer: bool = False, pos: Column | None = None
) -> DataFrame:
    """A CSV file with a header; a byte-order mark is dropped from the names.

    ``pos`` is added as a column of that name.
    """
    reader = spark.read.option("header", True).option("inferSchema", infer)
    raw = reader.option("escape", '"').csv(path)
    return _without_mark(raw if pos is None else raw.withColumn("pos", pos))


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """A transactions file by its extension: csv, json, parquet or orc."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return read_delimited(spark, path, infer=True)
    if kind in ("json", "parquet", "orc"):
        return spark.read.format(kind).load(path)
    raise ValueError(f"no reader for {path}; land spreadsheets as cell grids")


SNAPSHOT_SCHEMA = "key string, product_key string, superseded_by string"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Product records from ``{"data": [...]}`` documents of any size.

    ``pos`` is the order in which later duplicates of a key win.
    """
    return read_envelope(spark, path, SNAPSHOT_SCHEMA)


def place_in_files() -> Column:
    """A line's place among all lines: its file, where its block starts, and its turn in the block.

    Places compare in file order however Spark cuts and packs the files. To be taken straight
    from a reader, before rows are dropped.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``pos`` and ``value`` of the lines of text files, numbered 0, 1, ... over all files.

    Files count in the order of their paths. Lines of each block are counted first, without
    their texts; running totals give every block its first number.
    """
    at = ["file", "start"]
    lines = spark.read.text(path).select(place_in_files().alias("place"), "value").select("place.*", "value")
    blocks = settled(
        lines.groupBy(*at).agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    )
    # One row per block of a file, so this one window is short.
    before = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*at, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return attach(lines, starts, at).select(
        (F.col("before") + F.col("seq") - F.col("first")).alias("pos"), "value"
    )


def read_snapshot_lines(spark: SparkSession, path: str) -> DataFrame:
    """Product records landed one per line, with the number of their line as ``pos``."""
    lines = numbered_lines(spark, path).filter(strip(F.col("value")) != "")
    return lines.select("pos", F.from_json("value", SNAPSHOT_SCHEMA).alias("r")).select("pos", "r.*")


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Participant documents; missing parts are NULL."""
    return spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", multi_line).json(path)


def read_mapping(spark: SparkSession, path: str, decode_entities: bool = False) -> DataFrame:
    """Mapping rows: names and cells trimmed, blank rows dropped, missing cells empty."""
    return clean_mapping(
        spark.read.option("header", True).option("escape", '"').csv(path), decode_entities
    )


def clean_mapping(raw: DataFrame, decode_entities: bool = False) -> DataFrame:
    """Trim the names and cells of mapping rows and drop rows without any text."""
    named = raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns])
    value = (lambda c: unescape_entities(clean_text(F.col(c)))) if decode_entities else (
        lambda c: clean_text(F.col(c))
    )
    cells = named.select(*[value(f"`{c}`").alias(c) for c in named.columns])
    return cells.filter(F.concat(*[F.col(f"`{c}`") for c in cells.columns]) != "")


def lower_names(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_pasted_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines such as ``file name.csv 120`` as (file_name, input_count)."""
    return pasted_counts(spark.read.text(path))


def pasted_counts(lines: DataFrame) -> DataFrame:
    """Split each line into a name and a trailing count.

    A line without a count keeps its whole text as the name. Blank lines are
    dropped and repeated lines stay.
    """
    line = strip(F.col("value"))
    counted = r"^(.+?)\s+([0-9]+)$"
    has_count = line.rlike(counted)
    return (
        lines.filter(line != "")
        .select(
            F.when(has_count, strip(F.regexp_extract(line, counted, 1)))
            .otherwise(line)
            .alias("file_name"),
            F.when(has_count, F.regexp_extract(line, counted, 2).try_cast("long")).alias(
                "input_count"
            ),
        )
    )


OVERRIDE_FIELDS = ["contractor", "wholesaler_name", "wholesaler_address", "date_of_this_report"]


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Per-file header facts; see ``clean_overrides``. An absent file gives no rows."""
    try:
        raw = read_delimited(spark, path, pos=place_in_files())
    except AnalysisException:
        fields = ", ".join(f"{f} string" for f in ["filename", *OVERRIDE_FIELDS])
        return spark.createDataFrame([], f"{fields}, pos long").transform(clean_overrides)
    return clean_overrides(raw)


def clean_overrides(raw: DataFrame) -> DataFrame:
    """One row per lower-case file name: the last one listed (by ``pos``)."""
    name = F.lower(clean_text(F.col("filename")))
    facts = [
        (clean_text(F.col(f)) if f in raw.columns else F.lit("")).alias(f) for f in OVERRIDE_FIELDS
    ]
    return (
        raw.select(name.alias("file_key"), F.struct(*facts).alias("facts"), "pos")
        .filter(F.col("file_key") != "")
        .groupBy("file_key")
        .agg(F.max_by("facts", "pos").alias("facts"))
        .select("file_key", "facts.*")
    )


SAVED_SCHEMA = "signature string, field string, header string"


def read_saved_mappings(spark: SparkSession, path: str) -> DataFrame:
    """Confirmed mappings as (signature, field, header); absent or unreadable gives none.

    The current version where the folder has versions (``sinks.save_mappings``), else its files.
    """
    schema = SAVED_SCHEMA + ", saved_at timestamp"
    try:
        return spark.read.schema(schema).json(versions.current_folder(spark, path) or path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_saved_mapping_file(spark: SparkSession, path: str) -> DataFrame:
    """Confirmed mappings from one JSON object of signature -> field -> header."""
    text = spark.read.option("wholetext", True).text(path)
    layers = F.from_json("value", "map<string, map<string, string>>")
    return (
        text.select(F.explode(layers).alias("signature", "fields"))
        .select("signature", F.explode("fields").alias("field", "header"))
        .withColumn("saved_at", F.lit(None).cast("timestamp"))
    )


def read_aliases(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """A header dictionary from CSV rows (field, alias), in file order.

    A dictionary is configuration that people write, so it is held on the driver.
    """
    rows = read_delimited(spark, path).select("field", "alias").collect()
    aliases: dict[str, list[str]] = {}
    for row in rows:
        aliases.setdefault(row["field"], []).append(row["alias"])
    return aliases
