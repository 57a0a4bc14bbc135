"""Reading tables: column lists, file trees, periods, file samples, curves, run lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import take_by_hash
from ..functions.predicates import condition, float_columns, select_rows
from ..session import small_side
from .schemas import CURVE, require


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    query: str | None = None,
) -> DataFrame:
    """Parquet scan restricted to a column list; both the list and the query reach the reader."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    if query is not None:
        df = select_rows(df, query)
    return df if columns is None else require(df, columns).select(*columns)


def with_file_id(df: DataFrame, name: str = "file_id") -> DataFrame:
    """Input file of each row; part of every event key, as keys are unique per file only."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def find_files(
    spark: SparkSession,
    root: str,
    file_name: str,
    select: Sequence[str] | None = None,
    max_files: int | None = None,
) -> list[str]:
    """Sorted paths below ``root`` with the given name, holding one of the sub-strings, at most ``max_files``.

    The listing is Spark's own (distributed for large trees); only names reach the driver.
    """
    listing = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", file_name)
    paths = sorted(listing.parquet(root).inputFiles())
    if select is not None:
        paths = [p for p in paths if any(s in p for s in select)]
    return paths if max_files is None else paths[:max_files]


def scan_tree(spark: SparkSession, root: str, file_name: str, select=None, max_files=None) -> DataFrame:
    return with_file_id(spark.read.parquet(*find_files(spark, root, file_name, select, max_files)))


def union_periods(tables: Mapping[str, DataFrame], name: str = "period") -> DataFrame:
    """Tables of several periods under one ``period`` column."""
    out = None
    for period, df in tables.items():
        df = df.withColumn(name, F.lit(period))
        out = df if out is None else out.unionByName(df)
    return out


def concatenate(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def sample_files(
    tables: Mapping[str, DataFrame], files: DataFrame, fraction: float, seed: int, name: str = "file_id"
) -> dict[str, DataFrame]:
    """Keep the same ``floor(n * fraction)`` input files in every table.

    The list of kept files is broadcast after a check of its size, so the tables are
    filtered in place.
    """
    kept = small_side(take_by_hash(files.select(name).distinct(), [name], seed=seed, fraction=fraction))
    return {k: t.join(kept, name, "left_semi") for k, t in tables.items()}


def read_curve(spark: SparkSession, path: str, columns: Sequence[str] = ("pt", "central", "min", "max")) -> DataFrame:
    """Theory curve: CSV with a header and blanks after the commas."""
    schema = CURVE if tuple(columns) == ("pt", "central", "min", "max") else T.StructType(
        [T.StructField(c, T.DoubleType()) for c in columns]
    )
    return spark.read.schema(schema).csv(path, header=True, ignoreLeadingWhiteSpace=True)


def run_lists(spark: SparkSession, lists: Mapping[str, Sequence[int]]) -> DataFrame:
    """Configured lists of good runs as (list_name, run_number)."""
    rows = [(name, int(r)) for name, runs in lists.items() for r in runs]
    return spark.createDataFrame(rows, "list_name string, run_number long")


def select_runs(df: DataFrame, runs: DataFrame, run_col: str = "run_number") -> DataFrame:
    """Rows taken in a good run."""
    return df.join(runs.select(F.col("run_number").alias(run_col)).distinct(), run_col, "left_semi")


def apply_cut_table(df: DataFrame, label: Column, cuts: Mapping[str, str]) -> DataFrame:
    """Per-file selection: a row whose label contains key k must pass the condition of k.

    A row matching no key ends the job: an input without a configured selection
    is a configuration mistake.
    """
    floats = float_columns(df)
    chosen = F.raise_error(F.concat(F.lit("no selection configured for "), label)).cast("boolean")
    for key, query in reversed(list(cuts.items())):
        chosen = F.when(label.contains(key), condition(query, floats)).otherwise(chosen)
    return df.where(chosen)
