"""Writing tables: compressed copies, skim-bin partitions, buckets, curves, scored samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bins import first_bin
from ..session import fresh_path


def write_table(df: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """Compressed Parquet copy; returns the table read back."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_skim_bin(df: DataFrame, c: str, lows: Sequence[float], highs: Sequence[float]) -> DataFrame:
    """Add ``skim_bin``; rows outside all bins are dropped."""
    return df.withColumn("skim_bin", first_bin(c, lows, highs)).where("skim_bin is not null")


def write_skimmed(df: DataFrame, path: str, keys: Sequence[str] = ("skim_bin",), files_per_bin: int | None = None) -> DataFrame:
    """Directory per skim bin, so a query on one bin reads that directory only.

    Rows are first spread over ``files_per_bin`` tasks per bin (by default a quarter of the
    shuffle partitions, which follow the data), which bounds the number of files without
    sending a large bin to one task.  The slot is the input partition, not a random
    number, so a task that runs again after a lost executor sends the same rows.
    """
    if files_per_bin is None:
        files_per_bin = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    slot = F.spark_partition_id() % files_per_bin
    df = df.withColumn("__slot", slot).repartition(*keys, "__slot").drop("__slot")
    df.write.mode("overwrite").partitionBy(*keys).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Table bucketed by the event key: later joins of two such tables need no shuffle.

    The files go to ``path``, by default a new one below the shared folder.
    """
    target = path or fresh_path(df.sparkSession, table)
    df.write.mode("overwrite").option("path", target).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path
