"""Writers for ledgers, reports, documents and configuration tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.config import TEMPLATE_FIELDS, TEMPLATE_TITLE, Ledger
from saleswright.operators.keys import with_key_faults
from saleswright.scale import settled, shuffles_removed
from saleswright.sources import versions


def create_ledger(spark: SparkSession, table: str, ledger: Ledger) -> None:
    """Create an empty ledger table unless it exists.

    Spark does not enforce keys; ``operators.ledger_checks.key_violations``
    reports missing and repeated ones.
    """
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], ledger.schema).write.saveAsTable(table)


def append_ledger(df: DataFrame, table: str, ledger: Ledger) -> None:
    """Append typed rows, in the ledger's column order."""
    df.select(*ledger.names).write.mode("append").insertInto(table)


def append_ledger_files(df: DataFrame, path: str, ledger: Ledger) -> None:
    """Append typed rows to a Parquet ledger, in the ledger's column order."""
    with shuffles_removed(df.sparkSession):
        df.select(*ledger.names).write.mode("append").parquet(path)


def read_ledger_files(spark: SparkSession, path: str, ledger: Ledger) -> DataFrame:
    return spark.read.schema(ledger.schema).parquet(path)


def append_checked(
    df: DataFrame, path: str, quarantine: str, ledger: Ledger, key: str = "transaction_id"
) -> None:
    """Append the rows with good keys to a Parquet ledger, and the others to a quarantine table.

    The quarantine has the ledger's columns and ``key_fault`` (see ``operators.keys``).
    """
    spark = df.sparkSession
    try:
        held = read_ledger_files(spark, path, ledger)
        held.limit(0).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        held = spark.createDataFrame([], ledger.schema)
    checked = settled(with_key_faults(df.select(*ledger.names), held, key))
    append_ledger_files(checked.filter("key_fault IS NULL"), path, ledger)
    checked.filter("key_fault IS NOT NULL").write.mode("append").parquet(quarantine)


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header, also when there are no rows."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_dated_report(
    df: DataFrame, path: str, run_date: dt.date, run_id: str | None = None
) -> str:
    """CSV under run_date= and run_id= folders, so that runs do not replace one another."""
    run_id = run_id or uuid.uuid4().hex[:12]
    target = f"{path.rstrip('/')}/run_date={run_date.isoformat()}/run_id={run_id}"
    write_report(df, target)
    return target


def write_documents(df: DataFrame, path: str) -> None:
    """Nested JSON, one document per line."""
    df.write.mode("overwrite").json(path)


def template_banner(files: DataFrame) -> DataFrame:
    """The four lines above a converted file, one row per file."""
    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    return files.select(
        "file_name",
        F.lit(TEMPLATE_TITLE).alias("title"),
        F.concat(F.lit("Submitted by: "), text("wholesaler_name")).alias("submitted_by"),
        text("wholesaler_address").alias("address"),
        text("date_of_this_report").alias("report_date"),
    )


def write_conversion(records: DataFrame, files: DataFrame, path: str) -> None:
    """Converted records and the banner lines, as two tables keyed by file."""
    records.select("file_name", *TEMPLATE_FIELDS).write.mode("overwrite").parquet(
        f"{path}/records"
    )
    template_banner(files).write.mode("overwrite").parquet(f"{path}/banner")


def _filled(rows: DataFrame) -> DataFrame:
    """All values as text; missing ones are empty."""
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])


def append_profile_table(rows: DataFrame, path: str) -> None:
    """Append profile rows of any variant to one mapping table; columns meet by name."""
    _filled(rows).write.mode("append").parquet(path)


def read_profile_table(spark: SparkSession, path: str) -> DataFrame:
    """All profile rows with the columns of all variants; those a variant lacks are empty."""
    return _filled(spark.read.option("mergeSchema", True).parquet(path))


def append_profile(rows: DataFrame, path: str) -> None:
    """Append profile rows to a CSV folder of one variant.

    CSV columns meet by place, so rows with other columns than the folder has are refused;
    ``append_profile_table`` takes all variants.
    """
    spark = rows.sparkSession
    try:
        held = spark.read.option("header", True).option("escape", '"').csv(path).columns
    except AnalysisException:
        held = rows.columns
    if held and held != rows.columns:
        raise ValueError(f"{path} has the columns {held}")
    filled = _filled(rows)
    filled.write.mode("append").option("header", True).option("escape", '"').csv(path)


def newest_mappings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Saved mappings with the newest version of each signature, whole."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    latest = both.groupBy("signature").agg(
        F.max(F.struct("_age", "saved_at")).alias("latest")
    )
    return (
        both.join(latest, "signature")
        .filter(
            F.struct("_age", "saved_at").eqNullSafe(F.col("latest"))
        )
        .drop("_age", "latest")
    )


def save_mappings(old: DataFrame, new: DataFrame, path: str) -> None:
    """Replace the saved mappings by the newest version of each signature.

    A version is written beside the one it may be made from, and then becomes the current one.
    """
    versions.replace(newest_mappings(old, new), path, "json")
