"""Incremental input: process only files not seen before.

``ingest`` uses a file stream with a checkpoint; ``unprocessed`` works with a
ledger table of processed paths for jobs that stay in batch mode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    state: str,
    pattern: str | None = None,
    step: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_batch: int = 1000,
) -> None:
    """Run ``step`` over the new files below ``source`` and append the result to ``target``.

    The file sink's log and the checkpoint in ``state`` make a restart exact:
    finished files are skipped and a half-written batch is not read.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.parquet(source)
    (
        (step(df) if step is not None else df)
        .writeStream.format("parquet")
        .option("checkpointLocation", state)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def unprocessed(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of files that the ledger (``file_id``) does not list."""
    return df.withColumn("file_id", F.col("_metadata.file_path")).join(ledger.select("file_id"), "file_id", "left_anti")


def ledger_entries(df: DataFrame) -> DataFrame:
    return df.select("file_id").distinct()
