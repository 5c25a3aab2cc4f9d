"""Tables that are replaced whole, without a moment in which there is none.

A version is written to a folder of its own. Only when it is complete, a pointer to it is added;
a reader follows the newest pointer. A write that fails adds no pointer, so readers keep what they
had, and a table can be made from its own last version.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "number long, version string"


def _pointers(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(POINTER).json(f"{path.rstrip('/')}/pointers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The newest pointer; of two of one number, which writers at one time make, the greater name."""
    pointers = _pointers(spark, path)
    newest = None if pointers is None else pointers.agg(F.max(F.struct("number", "version"))).first()[0]
    return None if newest is None else (newest[0], newest[1])


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version, or None where there is none."""
    newest = _newest(spark, path)
    return None if newest is None else f"{path.rstrip('/')}/versions/{newest[1]}"


def replace(df: DataFrame, path: str, kind: str = "parquet") -> str:
    """Write a version and make it the current one; its folder is returned."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/versions/{version}"
    df.write.format(kind).save(folder)
    newest = _newest(spark, path)
    pointer = spark.createDataFrame([((newest[0] if newest else 0) + 1, version)], POINTER)
    # One row is one file, which Spark's commit makes visible whole.
    pointer.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/pointers")
    return folder


def read_current(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """The current version, or no rows."""
    folder = current_folder(spark, path)
    if folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(kind).load(folder)
