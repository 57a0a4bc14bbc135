"""Event selection, training samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import in_fraction, take_by_hash
from ..functions.predicates import col, gt, select_rows
from ..sources.scan import select_runs


def select_events(
    events: DataFrame,
    trigger: str | None = None,
    runs: DataFrame | None = None,
    event: str | None = None,
    run_col: str = "run_number",
) -> DataFrame:
    """Trigger, run list and event selection, each optional.

    The row conditions come first so that they reach the scan; the run join follows.
    """
    df = select_rows(select_rows(events, trigger), event)
    return df if runs is None else select_runs(df, runs, run_col)


def signal_background(df: DataFrame, signal: str, background: str, background_table: DataFrame | None = None):
    return select_rows(df, signal), select_rows(df if background_table is None else background_table, background)


def split_by_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label) == 1), df.where(F.col(label) == 0)


def tof_split(df: DataFrame, by: Sequence[str], c: str, border: float = -998.0) -> DataFrame:
    """Counts without and with the detector response; the border value itself is in neither; no column, no counts."""
    if c not in df.columns:
        return df.groupBy(*by).agg(F.lit(None).cast("long").alias("n_without"), F.lit(None).cast("long").alias("n_with"))
    return df.groupBy(*by).agg(F.count_if(F.col(c) < border).alias("n_without"), F.count_if(gt(c, border)).alias("n_with"))


def training_set(
    signal: DataFrame,
    background: DataFrame,
    keys: Sequence[str],
    n_signal: int,
    n_background: int,
    seed: int,
    label: str = "signal",
    zero_on_background: Sequence[str] = (),
) -> DataFrame:
    """Up to n rows of each class in hash order, labelled 1 and 0; simulation flags are 0 on background."""
    sig = take_by_hash(signal, keys, seed, n=n_signal).withColumn(label, F.lit(1))
    bkg = take_by_hash(background, keys, seed, n=n_background)
    bkg = bkg.withColumns({c: F.lit(0) for c in zero_on_background}).withColumn(label, F.lit(0))
    return sig.unionByName(bkg)


def train_test(df: DataFrame, keys: Sequence[str], test_fraction: float, seed: int) -> DataFrame:
    """Add ``is_test``; membership depends on the key only."""
    return df.withColumn("is_test", in_fraction(keys, test_fraction, seed))
