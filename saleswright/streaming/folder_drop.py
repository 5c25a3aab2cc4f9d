"""Files that arrive in a folder, processed as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_drops(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    file_format: str = "json",
    max_files: int | None = None,
    **options: str,
) -> None:
    """Process the files that are new since the last call, then stop.

    Each micro-batch replaces its own ``batch_id`` folder of the Parquet target, so a
    batch that runs again after a failure does not repeat rows.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrived = reader.load(folder).withColumn("source_file", F.col("_metadata.file_name"))

    def store(batch: DataFrame, batch_id: int) -> None:
        result = transform(batch) if transform is not None else batch
        result.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_id={batch_id}")

    query = (
        arrived.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
