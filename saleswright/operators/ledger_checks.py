"""Quality checks on typed ledgers, for all files in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import BASE_LEDGER, Ledger
from saleswright.functions.cleaning import is_junk
from saleswright.scale import first_examples

FILE = "archive_file_name"


def _empty(ledger: Ledger) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in ledger.data_columns]).isNull()


def _no_description() -> Column:
    return F.coalesce(F.trim("item_description") == "", F.lit(True))


def file_counts(df: DataFrame, ledger: Ledger = BASE_LEDGER, by: str = FILE) -> DataFrame:
    """All counts the checks need, one row per file, in one aggregation."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_empty(ledger)).alias("empty"),
        F.count_if(_no_description()).alias("no_description"),
        *[F.count(c).alias(f"filled_{c}") for c in ledger.data_columns],
        *[F.count_if(is_junk(F.col(c))).alias(f"junk_{c}") for c in ledger.text_columns],
    )


def column_profile(df: DataFrame, ledger: Ledger = BASE_LEDGER, by: str = FILE) -> DataFrame:
    """Filled and NULL counts per file and data column."""
    return _column_rows(file_counts(df, ledger, by), ledger, by)


def _column_rows(counts: DataFrame, ledger: Ledger, by: str) -> DataFrame:
    columns = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"filled_{c}").alias("non_null"))
            for c in ledger.data_columns
        ]
    )
    nulls = F.col("total") - F.col("non_null")
    return (
        counts.select(by, "total", F.explode(columns).alias("c"))
        .select(by, "c.*", "total")
        .withColumn("nulls", nulls)
        .withColumn("pct_null", F.round(nulls / F.col("total") * 100, 0))
    )


def failing_rows(df: DataFrame, ledger: Ledger = BASE_LEDGER, by: str = FILE) -> DataFrame:
    """Rows that fail a check: one row per check and, for junk, per column."""
    def hit(test: Column, check: str, column: Column, value: Column) -> Column:
        return F.when(
            test,
            F.struct(F.lit(check).alias("check"), column.alias("column_name"), value.alias("value")),
        )

    none = F.lit(None).cast("string")
    hits = [
        hit(_empty(ledger), "Empty rows", none, none),
        hit(_no_description(), "Missing item_description", none, none),
    ]
    hits += [
        hit(is_junk(F.col(c)), "Junk values", F.lit(c), F.col(c)) for c in ledger.text_columns
    ]
    failed = _empty(ledger) | _no_description()
    for c in ledger.text_columns:
        failed = failed | is_junk(F.col(c))
    # The list is a column before it is exploded: of an expression, Spark would derive the type
    # anew for each row.
    return (
        df.filter(failed)
        .select(by, "row_id", F.array_compact(F.array(*hits)).alias("h"))
        .select(by, "row_id", F.explode("h").alias("h"))
        .select(by, "row_id", "h.*")
    )


def samples(df: DataFrame, ledger: Ledger = BASE_LEDGER, n: int = 5, by: str = FILE) -> DataFrame:
    """The first rows of every failed check."""
    failed = failing_rows(df, ledger, by)
    return first_examples(failed, [by, "check", "column_name"], ["row_id"], n)


def _sample_text(df: DataFrame, ledger: Ledger, by: str) -> DataFrame:
    shown = F.when(
        F.col("column_name").isNull(), F.col("row_id").cast("string")
    ).otherwise(F.concat(F.lit("row "), "row_id", F.lit("='"), "value", F.lit("'")))
    lists = (
        samples(df, ledger, by=by)
        .groupBy(by, "check", "column_name")
        .agg(F.array_sort(F.collect_list(F.struct("example_no", shown.alias("shown")))).alias("s"))
        .withColumn("s", F.array_join(F.transform("s", lambda e: e["shown"]), ", "))
    )
    # Columns of the junk check, in ledger order.
    place = F.array_position(
        F.array(*[F.lit(c) for c in ledger.text_columns]), F.coalesce("column_name", F.lit(""))
    )
    text = F.when(F.col("column_name").isNull(), F.col("s")).otherwise(
        F.concat("column_name", F.lit(": "), "s")
    )
    return (
        lists.groupBy(by, "check")
        .agg(F.array_sort(F.collect_list(F.struct(place.alias("p"), text.alias("t")))).alias("s"))
        .select(by, "check", F.array_join(F.transform("s", lambda e: e["t"]), "; ").alias("samples"))
    )


def _grouped(number: Column) -> Column:
    return F.format_number(number, 0)


def issues(
    df: DataFrame,
    ledger: Ledger = BASE_LEDGER,
    metadata: DataFrame | None = None,
    by: str = FILE,
    with_samples: bool = True,
) -> DataFrame:
    """(file, check, severity, detail, samples): failures and warnings of every file.

    ``metadata`` from ``load_metadata`` adds skipped-row warnings for sheets without an
    explicit filter, and load failures.
    """
    counts = file_counts(df, ledger, by)
    junk = [F.col(f"junk_{c}") for c in ledger.text_columns]
    junk_total = sum(junk[1:], junk[0])
    junk_columns = sum([(j > 0).cast("int") for j in junk[1:]], (junk[0] > 0).cast("int"))

    def issue(test: Column, check: str, severity: str, detail: Column) -> Column:
        return F.when(
            test,
            F.struct(
                F.lit(check).alias("check"),
                F.lit(severity).alias("severity"),
                detail.alias("detail"),
            ),
        )

    found = [
        issue(F.col("empty") > 0, "Empty rows", "FAIL",
              F.concat("empty", F.lit(" row(s) with all data columns NULL"))),
        issue(F.col("no_description") > 0, "Missing item_description", "FAIL",
              F.concat("no_description", F.lit(" row(s) with NULL or blank item_description"))),
        issue(junk_total > 0, "Junk values", "FAIL",
              F.concat(junk_total, F.lit(" junk value(s) in "), junk_columns, F.lit(" column(s)"))),
    ]
    for c in ledger.data_columns:
        filled = F.col(f"filled_{c}")
        nulls = F.col("total") - filled
        share = F.round(nulls / F.col("total") * 100, 0).cast("int")
        detail = F.concat(
            F.lit(f"'{c}': "), _grouped(filled), F.lit(" rows have a value, "), _grouped(nulls),
            F.lit(" are NULL ("), share, F.lit("% NULL)"),
        )
        found.append(issue((filled > 0) & (nulls > 0), "Sparse column", "WARN", detail))
    result = (
        counts.select(by, F.explode(F.array_compact(F.array(*found))).alias("i")).select(by, "i.*")
    )
    if metadata is not None:
        skipped = F.col("raw_rows") - F.col("loaded_rows")
        text = F.concat(
            F.lit("'"), "sheet_name", F.lit("': "), skipped, F.lit(" row(s) skipped ("),
            _grouped(F.col("loaded_rows")), F.lit(" loaded from "),
            _grouped(F.col("raw_rows")), F.lit(" rows in range)"),
        )
        base = metadata.withColumnRenamed(FILE, by) if by != FILE else metadata
        loaded = F.col("status") == "loaded"
        result = result.unionByName(
            base.filter(loaded & (skipped > 0) & ~F.col("has_explicit_filter")).select(
                by, F.lit("Skipped rows").alias("check"), F.lit("WARN").alias("severity"),
                text.alias("detail"),
            )
        ).unionByName(
            base.filter(~loaded).select(
                by, F.lit("Load failed").alias("check"), F.lit("LOAD").alias("severity"),
                F.concat_ws(
                    "; ",
                    F.when(F.col("missing_columns") != "", F.concat(F.lit("missing column for: "), "missing_columns")),
                    F.when(F.col("condition_error") != "", F.concat(F.lit("condition: "), "condition_error")),
                ).alias("detail"),
            )
        )
    if not with_samples:
        return result
    return result.join(_sample_text(df, ledger, by), [by, "check"], "left")


def key_violations(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys that are missing or used more than once."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("uses"))
        .filter(F.col(key).isNull() | (F.col("uses") > 1))
    )


def run_summary(df: DataFrame, found: DataFrame, metadata: DataFrame, by: str = FILE) -> DataFrame:
    """One row: files, load and quality failures, files with warnings, rows added."""
    meta = metadata.withColumnRenamed(FILE, by) if by != FILE else metadata
    per_file = found.groupBy(by).agg(
        F.max(F.col("severity") == "FAIL").alias("quality"),
        F.max(F.col("severity") == "WARN").alias("warned"),
        F.max(F.col("severity") == "LOAD").alias("load"),
    )
    checked = per_file.agg(
        F.count_if("load").alias("load_failures"),
        F.count_if("quality").alias("quality_failures"),
        F.count_if("warned").alias("warnings"),
    )
    files = meta.agg(F.count_distinct(by).alias("files"))
    added = df.agg(F.count(F.lit(1)).alias("rows_added"))
    parts = files.unionByName(checked, allowMissingColumns=True).unionByName(
        added, allowMissingColumns=True
    )
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])
