"""Joins between events, candidates, bins and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import overlapping_bins
from ..session import small_side


def join_events(candidates: DataFrame, events: DataFrame, keys: Sequence[str], event_columns: Sequence[str]) -> DataFrame:
    """Candidates with the columns of their event; candidates of absent events drop out.

    Only the needed event columns travel.  The key must hold the file id.  The
    size of the event side decides at run time between broadcast and
    sort-merge; hot events are split by the skew join.
    """
    return candidates.join(events.select(*keys, *event_columns), list(keys), "inner")


def join_suffixed(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Many-to-many inner join; columns present on both sides get a suffix each."""
    both = (set(left.columns) & set(right.columns)) - set(keys)
    lhs = left.select(*[F.col(c).alias(c + suffixes[0]) if c in both else F.col(c) for c in left.columns])
    rhs = right.select(*[F.col(c).alias(c + suffixes[1]) if c in both else F.col(c) for c in right.columns])
    return lhs.join(rhs, list(keys), "inner")


def merge_all(first: DataFrame, others: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Inner joins in order, each further table with its own key list."""
    return reduce(lambda left, right: left.join(right[0], list(right[1]), "inner"), others, first)


TASK_ROWS = 500_000


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The table dealt by its keys for about TASK_ROWS of ``rows`` rows per task.

    The number of partitions follows from the rows, and is not merged at run time, so the memory of a task
    stays the same however large the table is.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(parts, *keys)


def match_bin(bin_index: Column, matching: Sequence[int]) -> Column:
    """Analysis bin number -> skim bin number."""
    table = F.array(*[F.lit(int(m)) for m in matching])
    return F.when(bin_index.between(0, len(matching) - 1), F.element_at(table, bin_index + 1))


def explode_bins(df: DataFrame, c: str, lows, highs, name: str = "ibin2", closed: bool = True) -> DataFrame:
    """One output row per bin holding the value; rows in no bin drop out."""
    return df.withColumn(name, F.explode(overlapping_bins(c, lows, highs, closed)))


def lookup_content(df: DataFrame, hist: DataFrame, keys: Sequence[str], name: str, default: float | None = None) -> DataFrame:
    """Content of the histogram bin a row falls into, as column ``name``.

    ``keys`` are bin-number columns present on both sides.  The histogram has at
    most as many rows as configured bins; it is broadcast after a check of its size.
    """
    table = small_side(hist.select(*keys, F.col("content").alias(name)))
    out = df.join(table, list(keys), "left")
    return out if default is None else out.withColumn(name, F.coalesce(name, F.lit(default)))


def match_periods(data: DataFrame, mc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Data and simulation histograms of the same period and bin.

    The first key is the period.  A period on one side only is an error; an empty bin, which a
    histogram does not list, is 0.
    """
    period = keys[0]
    d = data.select(*keys, F.col("content").alias("data"), F.col("sumw2").alias("data_w2"), F.lit(1).alias("__d"))
    m = mc.select(*keys, F.col("content").alias("mc"), F.col("sumw2").alias("mc_w2"), F.lit(1).alias("__m"))
    both = d.join(m, list(keys), "full")
    # the window covers the bins of one period, a configured number of rows
    whole = Window.partitionBy(period)
    one_sided = F.max("__d").over(whole).isNull() | F.max("__m").over(whole).isNull()
    check = F.when(one_sided, F.raise_error(F.lit("histogram without partner")).cast("boolean")).otherwise(F.lit(True))
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in ("data", "data_w2", "mc", "mc_w2")}
    return both.withColumn("__ok", check).where("__ok").withColumns(filled).drop("__d", "__m", "__ok")


def align(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str] = ("content", "sumw2")
) -> DataFrame:
    """Bin-wise pairing of two histograms: ``a_content, a_sumw2, b_content, b_sumw2``; absent bins are 0.

    Both inputs go through one shuffle with map-side sums instead of a full outer join.
    """
    def part(df: DataFrame, own: str, other: str) -> DataFrame:
        return df.select(
            *keys,
            *[F.col(v).alias(f"{own}_{v}") for v in values],
            *[F.lit(0.0).alias(f"{other}_{v}") for v in values],
        )

    both = part(left, "a", "b").unionByName(part(right, "b", "a"))
    names = [f"{s}_{v}" for s in "ab" for v in values]
    return both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def align_many(tables: Mapping[str, DataFrame], keys: Sequence[str], value: str = "content") -> DataFrame:
    """Bin-wise pairing of any number of tables, one value column each."""
    union = None
    for name, df in tables.items():
        part = df.select(*keys, *[(F.col(value) if n == name else F.lit(None).cast("double")).alias(n) for n in tables])
        union = part if union is None else union.unionByName(part)
    return union.groupBy(*keys).agg(*[F.max(n).alias(n) for n in tables])


def same_binning(left: DataFrame, right: DataFrame, keys: Sequence[str], edges: Sequence[str] = ("x_low", "x_up")) -> DataFrame:
    """Full outer join on bin numbers that fails when the edges of a bin disagree; an empty bin, absent on one side, is 0."""
    l = left.select(*keys, *[F.col(e).alias(f"l_{e}") for e in edges], F.col("content").alias("a_content"), F.col("sumw2").alias("a_sumw2"))
    r = right.select(*keys, *[F.col(e).alias(f"r_{e}") for e in edges], F.col("content").alias("b_content"), F.col("sumw2").alias("b_sumw2"))
    agree = F.lit(True)
    for e in edges:
        agree = agree & (F.col("a_content").isNull() | F.col("b_content").isNull() | F.col(f"l_{e}").eqNullSafe(F.col(f"r_{e}")))
    check = F.when(agree, F.lit(True)).otherwise(F.raise_error(F.lit("different binning")).cast("boolean"))
    joined = l.join(r, list(keys), "full").where(check)
    values = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("a_content", "a_sumw2", "b_content", "b_sumw2")]
    return joined.select(*keys, *[F.coalesce(f"l_{e}", f"r_{e}").alias(e) for e in edges], *values)


def count_trials(df: DataFrame, by: Sequence[str], trials: Mapping[str, Column], weight: Column | None = None) -> DataFrame:
    """Counts of all trials in one scan: (by..., trial, content).

    Each trial is a conditional sum; rows are never multiplied.  The unpivot works
    on the aggregated rows.
    """
    w = F.lit(1.0) if weight is None else weight
    wide = df.groupBy(*by).agg(*[F.sum(F.when(p, w).otherwise(0.0)).alias(t) for t, p in trials.items()])
    return wide.unpivot(list(by), list(trials), "trial", "content")
