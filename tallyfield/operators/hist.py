"""Histograms as DataFrames.

Contract: group columns, bin numbers (``ix``, ``iy``, ``iz``), ``content`` and
``sumw2`` (both double).  Bin 0 and n+1 are the flow bins.  Edges belong to the
:class:`~tallyfield.functions.bins.Uniform` / ``Edges`` objects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bits
from ..functions.bins import Axis, bin_mask, inside, mask_bins
from ..functions.predicates import Operand, col, condition, float_columns, select_rows
from ..session import small_side

AXES = ("ix", "iy", "iz", "iv")


def fill(
    df: DataFrame,
    axes: Sequence[tuple[Operand, Axis]],
    by: Sequence[str] = (),
    weight: Operand | None = None,
    flow: bool = True,
) -> DataFrame:
    """Weighted 1-, 2- or 3-D histogram per group: one partial + final aggregation."""
    names = AXES[: len(axes)]
    w = F.lit(1.0) if weight is None else col(weight).cast("double")
    binned = df.select(*by, *[a.index(x).alias(n) for n, (x, a) in zip(names, axes)], w.alias("__w"))
    keep = F.lit(True)
    for n, (_, a) in zip(names, axes):
        keep = keep & (F.col(n).isNotNull() if flow else inside(n, a))
    if weight is None:
        return (
            binned.where(keep).groupBy(*by, *names).agg(F.count("*").cast("double").alias("content"))
            .withColumn("sumw2", F.col("content"))
        )
    return binned.where(keep).groupBy(*by, *names).agg(
        F.sum("__w").alias("content"), F.sum(F.col("__w") * F.col("__w")).alias("sumw2")
    )


def fill_classes(
    df: DataFrame,
    axes: Sequence[tuple[Operand, Axis]],
    classes: Mapping[str, Column],
    by: Sequence[str] = (),
    weight: Operand | None = None,
    flow: bool = True,
) -> DataFrame:
    """Histograms of several classes of rows by one aggregation: by..., ix/iy/iz, ``<class>_content``, ``<class>_sumw2``.

    Classes are conditions and may overlap; a row in none of them is left out before the shuffle.  A class without a
    row in a bin is null there.
    """
    names = AXES[: len(axes)]
    w = F.lit(1.0) if weight is None else col(weight).cast("double")
    member = {c: F.coalesce(when, F.lit(False)) for c, when in classes.items()}
    binned = df.where(reduce(or_, member.values())).select(
        *by, *[a.index(x).alias(n) for n, (x, a) in zip(names, axes)], w.alias("__w"), *[m.alias(f"__in_{c}") for c, m in member.items()])
    keep = F.lit(True)
    for n, (_, a) in zip(names, axes):
        keep = keep & (F.col(n).isNotNull() if flow else inside(n, a))
    sums = []
    for c in classes:
        sums += [F.sum(F.when(F.col(f"__in_{c}"), F.col("__w"))).alias(f"{c}_content"),
                 F.sum(F.when(F.col(f"__in_{c}"), F.col("__w") * F.col("__w"))).alias(f"{c}_sumw2")]
    return binned.where(keep).groupBy(*by, *names).agg(*sums)


def grid(groups: DataFrame, axes: Sequence[Axis], flow: bool = False) -> DataFrame:
    """All bins of every group row."""
    for name, a in zip(AXES, axes):
        first, last = (0, a.n + 1) if flow else (1, a.n)
        groups = groups.withColumn(name, F.explode(F.sequence(F.lit(first), F.lit(last))))
    return groups


def zero_fill(hist: DataFrame, groups: DataFrame, by: Sequence[str], axes: Sequence[Axis], flow: bool = False) -> DataFrame:
    """Add the empty bins, so that ratios keep all of them."""
    keys = [*by, *AXES[: len(axes)]]
    return (
        grid(groups.select(*by), axes, flow)
        .join(hist, keys, "left")
        .fillna(0.0, subset=["content", "sumw2"])
    )


def merge(*hists: DataFrame) -> DataFrame:
    """Sum of histograms filled apart (per file, per period)."""
    both = hists[0]
    for h in hists[1:]:
        both = both.unionByName(h)
    keys = [c for c in both.columns if c not in ("content", "sumw2")]
    return both.groupBy(*keys).agg(F.sum("content").alias("content"), F.sum("sumw2").alias("sumw2"))


def project(hist: DataFrame, keep: Sequence[str], where: Column | None = None) -> DataFrame:
    """Sum over all axes not kept, optionally inside a range; errors add in quadrature."""
    h = hist if where is None else hist.where(where)
    return h.groupBy(*keep).agg(F.sum("content").alias("content"), F.sum("sumw2").alias("sumw2"))


def integral(hist: DataFrame, by: Sequence[str], axis: Axis, lo: float, hi: float, name: str = "ix") -> DataFrame:
    """Sum over the bins from the one holding ``lo`` to the one holding ``hi``, both included."""
    return project(hist, by, col(name).between(axis.find(lo), axis.find(hi)))


def profile(df: DataFrame, x: Operand, axis: Axis, y: Operand, by: Sequence[str] = ()) -> DataFrame:
    """Mean of y with its error per x bin."""
    v = df.select(*by, axis.index(x).alias("ix"), col(y).alias("__y")).where(inside("ix", axis))
    return v.groupBy(*by, "ix").agg(
        F.count("*").alias("n"),
        F.avg("__y").alias("mean"),
        (F.stddev_pop("__y") / F.sqrt(F.count("*"))).alias("error"),
    )


def coarse_bins(fine: Axis, coarse: Axis) -> list[int]:
    """Coarse bin number of every fine bin 0..n+1; the coarse edges must be fine edges."""
    for e in coarse.edges:
        if not any(abs(e - f) < 1e-9 for f in fine.edges):
            raise ValueError(f"edge {e} is not an edge of the finer axis")
    centres = [(a + b) / 2 for a, b in zip(fine.edges, fine.edges[1:])]
    return [0] + [coarse.find(c) for c in centres] + [coarse.n + 1]


def rebin(hist: DataFrame, fine: Axis, coarse: Axis, axis: str = "ix") -> DataFrame:
    numbers = F.array(*[F.lit(i) for i in coarse_bins(fine, coarse)])
    keys = [c for c in hist.columns if c not in ("content", "sumw2")]
    return project(hist.withColumn(axis, F.element_at(numbers, col(axis) + 1)), keys)


def rebin_by(hist: DataFrame, factor: Operand | int, axis: str = "ix") -> DataFrame:
    """Join ``factor`` neighbouring bins (factor may differ per group)."""
    f = F.lit(factor) if isinstance(factor, int) else col(factor)
    keys = [c for c in hist.columns if c not in ("content", "sumw2")]
    return project(hist.withColumn(axis, (F.floor((col(axis) - 1) / f) + 1).cast("int")), keys)


def rebin_factor(
    hist: DataFrame, by: Sequence[str], n_bins: int, min_entries: float, hi: int, lo: int | None = None, first: int = 1
) -> DataFrame:
    """Factor that brings the mean bin content to ``min_entries``.

    At most ``hi``, at least ``lo``; without ``lo`` a factor below 1 becomes null,
    as does the factor of an empty histogram.  ``first=0`` counts the underflow too.
    """
    raw = F.lit(float(min_entries)) / (F.sum("content") / n_bins)
    factor = F.when(raw > hi, F.lit(hi))
    if lo is not None:
        factor = factor.when(raw < lo, F.lit(lo))
    factor = factor.when(raw >= 1, F.ceil(raw)).cast("int")
    return hist.where(F.col("ix").between(first, n_bins)).groupBy(*by).agg(
        F.when(F.sum("content") > 0, factor).alias("factor")
    )


def normalise(
    hist: DataFrame, by: Sequence[str], skip_first: bool = False, width: Column | None = None, axis: str = "ix"
) -> DataFrame:
    """Divide by the integral per group (optionally leaving out the first bin) and by the bin width.

    The window covers the bins of one histogram, a configured number of rows.
    """
    w = Window.partitionBy(*(by or [F.lit(1)]))
    counted = F.when(col(axis) > 1, F.col("content")).otherwise(0.0) if skip_first else F.col("content")
    total = F.sum(counted).over(w)
    scale = F.lit(1.0) / F.when(total != 0, total)
    if width is not None:
        scale = scale / width
    return (
        hist.withColumn("__scale", F.coalesce(scale, F.lit(0.0)))
        .withColumn("content", F.col("content") * F.col("__scale"))
        .withColumn("sumw2", F.col("sumw2") * F.col("__scale") * F.col("__scale"))
        .drop("__scale")
    )


def value_range(df: DataFrame, variables: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, lo, hi) of the finite values of every variable in one scan."""
    def finite(v: str) -> Column:
        x = F.col(v).cast("double")
        return F.when((x > float("-inf")) & (x < float("inf")), x)  # NaN is above infinity

    wide = df.groupBy(*by).agg(*[F.struct(F.min(finite(v)).alias("lo"), F.max(finite(v)).alias("hi")).alias(v) for v in variables])
    return wide.unpivot(list(by), list(variables), "variable", "__r").select(*by, "variable", "__r.lo", "__r.hi")


def limited_ranges(df: DataFrame, variables: Sequence[str], limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Configured limits where given, the data range elsewhere; no scan when all are configured."""
    fixed = [(v, *map(float, limits[v])) for v in variables if v in limits]
    free = [v for v in variables if v not in limits]
    given = df.sparkSession.createDataFrame(fixed, "variable string, lo double, hi double") if fixed else None
    if not free:
        return given
    found = value_range(df, free)
    return found if given is None else found.unionByName(given)


def range_bin(v: Operand, lo: Operand, hi: Operand, n: int) -> Column:
    """Bin 1..n of [lo, hi] with hi inside the last bin; null outside."""
    v, lo, hi = col(v), col(lo), col(hi)
    b = F.floor(F.try_divide(F.lit(n) * (v - lo), hi - lo)).cast("int") + 1
    return F.when((v >= lo) & (v < hi), b).when(v == hi, F.lit(n))


def melt(df: DataFrame, variables: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, variable): keep..., ``v`` (position in the variable list), ``x``.

    A number instead of the name keeps the grouping keys of fixed width.
    """
    columns = ", ".join(f"{i}, cast(`{v}` as double)" for i, v in enumerate(variables))
    return df.select(*keep, *[F.col(f"`{v}`") for v in dict.fromkeys(variables) if v not in keep]).select(
        *keep, F.expr(f"stack({len(variables)}, {columns}) as (v, x)"))


def variable_names(variables: Sequence[str], v: Operand = "v") -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in variables]), col(v) + 1)


def numbered(ranges: DataFrame, variables: Sequence[str]) -> DataFrame:
    """(v, lo, hi) from (variable, lo, hi)."""
    numbers = F.create_map(*[F.lit(x) for i, n in enumerate(variables) for x in (n, i)])
    return ranges.select(F.try_element_at(numbers, F.col("variable")).alias("v"), "lo", "hi").where("v is not null")


def auto_hist(
    df: DataFrame,
    variables: Sequence[str],
    by: Sequence[str] = (),
    n: int = 100,
    limits: Mapping[str, tuple[float, float]] | None = None,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Histograms of several variables between their own minimum and maximum.

    ``limits`` fixes the range of chosen variables; ``ranges`` (variable, lo, hi)
    can come from another selection.  One row per variable is joined back, so
    that side is bounded by the variable list.  Columns: variable, by...,
    ix, lo, hi, content.
    """
    r = limited_ranges(df, variables, limits or {}) if ranges is None else ranges
    r = numbered(r, variables)
    long = melt(df, variables, by).join(F.broadcast(r), "v")
    counts = (
        long.select("v", *by, range_bin("x", "lo", "hi", n).alias("ix"))
        .where("ix is not null")
        .groupBy("v", *by, "ix")
        .agg(F.count("*").cast("double").alias("content"))
    )
    return counts.join(F.broadcast(r), "v").select(variable_names(variables).alias("variable"), *by, "ix", "lo", "hi", "content")


def density(hist: DataFrame, by: Sequence[str], width: Column) -> DataFrame:
    """Counts over (sum of counts x bin width)."""
    total = F.sum("content").over(Window.partitionBy(*by))
    return hist.withColumn("density", F.try_divide(F.col("content"), total * width))


def with_edges(hist: DataFrame, axis: Axis, name: str = "ix") -> DataFrame:
    ok = inside(name, axis)
    return hist.withColumn("x_low", F.when(ok, axis.low(name))).withColumn("x_up", F.when(ok, axis.up(name)))


def cut_flow(df: DataFrame, stages: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows left after each stage of a selection cascade, in one pass."""
    passed, aggs = F.lit(True), []
    for name, p in stages.items():
        passed = passed & F.coalesce(p, F.lit(False))
        aggs.append(F.count_if(passed).alias(name))
    return df.groupBy(*by).agg(*aggs).unpivot(list(by), list(stages), "stage", "n")


def counts_by_class(
    df: DataFrame, by: Sequence[str], counters: Mapping[str, Column], second: tuple[str, Sequence[float], Sequence[float]] | None = None
) -> DataFrame:
    """Count and square-root error per counter, all in one aggregation.

    ``second`` (column, lows, highs) adds ``ibin2`` for overlapping closed bins; the
    rows are counted per set of bins first.
    """
    if second is None:
        counts = df.groupBy(*by).agg(*[F.count_if(p).alias(n) for n, p in counters.items()])
        keys = list(by)
    else:
        c, lows, highs = second
        sets = df.withColumn("__mask", bin_mask(c, lows, highs)).groupBy(*by, "__mask").agg(*[F.count_if(p).alias(n) for n, p in counters.items()])
        keys = [*by, "ibin2"]
        counts = sets.withColumn("ibin2", F.explode(mask_bins("__mask", len(lows)))).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in counters])
    return counts.select(*keys, *[e for n in counters for e in (F.col(n), F.sqrt(n).alias(f"{n}_err"))])


def reweighted_counts_by_class(
    df: DataFrame, by: Sequence[str], counters: Mapping[str, Column], weight: str, second: tuple[str, Sequence[float], Sequence[float]],
    reweighted: Sequence[bool],
) -> DataFrame:
    """As ``counts_by_class`` with second bins, of which those marked ``reweighted`` sum weights in place of rows.

    The error is the root of the sum of squared weights.  Counts, weights and their squares
    are summed in one aggregation per set of bins; a missing weight counts as 0.
    """
    c, lows, highs = second
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    sums = []
    for n, p in counters.items():
        sums += [F.count_if(p).cast("double").alias(f"{n}_n"), F.coalesce(F.sum(F.when(p, w)), F.lit(0.0)).alias(f"{n}_w"),
                 F.coalesce(F.sum(F.when(p, w * w)), F.lit(0.0)).alias(f"{n}_w2")]
    sets = df.withColumn("__mask", bin_mask(c, lows, highs)).groupBy(*by, "__mask").agg(*sums)
    spread = sets.withColumn("ibin2", F.explode(mask_bins("__mask", len(lows))))
    total = spread.groupBy(*by, "ibin2").agg(*[F.sum(f"{n}_{k}").alias(f"{n}_{k}") for n in counters for k in ("n", "w", "w2")])
    marked = F.col("ibin2").isin([i for i, r in enumerate(reweighted) if r])
    out = []
    for n in counters:
        out += [F.when(marked, F.col(f"{n}_w")).otherwise(F.col(f"{n}_n")).alias(n),
                F.sqrt(F.when(marked, F.col(f"{n}_w2")).otherwise(F.col(f"{n}_n"))).alias(f"{n}_err")]
    return total.select(*by, "ibin2", *out)


def event_norm(n_sel: Column, n_no_vertex: Column, n_vertex_out: Column) -> Column:
    """Selected events plus the share of vertex-less ones that would lie inside; -1 without accepted events."""
    den = n_sel + n_vertex_out
    return F.when(den > 0, n_sel + n_no_vertex - F.try_divide(n_no_vertex * n_vertex_out, den)).otherwise(F.lit(-1.0))


def response(df: DataFrame, reco: Sequence[tuple[Operand, Axis]], gen: Sequence[tuple[Operand, Axis]], by=(), weight=None) -> DataFrame:
    """Sparse response (ix_r, iy_r, ix_g, iy_g, w) of pairs inside all ranges."""
    axes = list(zip(("ix_r", "iy_r"), reco)) + list(zip(("ix_g", "iy_g"), gen))
    w = F.lit(1.0) if weight is None else col(weight)
    binned = df.select(*by, *[a.index(x).alias(n) for n, (x, a) in axes], w.alias("__w"))
    keep = F.lit(True)
    for n, (_, a) in axes:
        keep = keep & inside(n, a)
    return binned.where(keep).groupBy(*by, *[n for n, _ in axes]).agg(F.sum("__w").alias("w"))


def prior_weights(df: DataFrame, bins: Sequence[str]) -> DataFrame:
    """Add ``weight`` = 1 / number of rows in the same bin (1 for a bin without rows).

    The counts have one row per configured bin; they are joined back by bin number
    without a shuffle of the rows.
    """
    counts = small_side(df.groupBy(*bins).agg(F.count("*").cast("double").alias("__n")))
    return df.join(counts, list(bins), "left").withColumn(
        "weight", F.when(F.coalesce("__n", F.lit(0.0)) > 0, F.try_divide(F.lit(1.0), F.col("__n"))).otherwise(1.0)
    ).drop("__n")


def spec_histograms(df: DataFrame, specs: Sequence[Mapping]) -> DataFrame:
    """Named list of 1-D/2-D histograms over one scan.

    A spec holds ``name``, ``x`` (column, axis), optionally ``y`` and ``where``.
    Specs whose columns are absent are left out.  The bin numbers of all specs are
    laid out once per row and stacked; grouping keys are three numbers.
    """
    used = [s for s in specs if all(not isinstance(c, str) or c in df.columns for c, _ in [s["x"]] + ([s["y"]] if "y" in s else []))]
    columns, entries = [], []
    for i, s in enumerate(used):
        ix = s["x"][1].index(s["x"][0])
        columns.append((F.when(s["where"], ix) if s.get("where") is not None else ix).alias(f"x{i}"))
        columns.append((s["y"][1].index(s["y"][0]) if "y" in s else F.lit(0)).alias(f"y{i}"))
        entries.append(f"{i}, x{i}, y{i}")
    stacked = df.select(*columns).selectExpr(f"stack({len(used)}, {', '.join(entries)}) as (h, ix, iy)").where("ix is not null and iy is not null")
    counts = stacked.groupBy("h", "ix", "iy").agg(F.count("*").cast("double").alias("content"))
    return counts.select(variable_names([s["name"] for s in used], "h").alias("hist"), "ix", "iy", "content")


def with_meta(
    hist: DataFrame, first: tuple[str, Axis, str], second: tuple[str, Axis, str], working_point: Operand | float
) -> DataFrame:
    """Struct column describing the two analysis bins and the working point of each row."""
    wp = F.lit(float(working_point)) if isinstance(working_point, (int, float)) else col(working_point)
    parts = []
    for label, (name, axis, index) in (("first", first), ("second", second)):
        parts += [F.lit(name).alias(f"{label}_name"), axis.low(index).alias(f"{label}_low"), axis.up(index).alias(f"{label}_up")]
    return hist.withColumn("meta", F.struct(*parts, wp.alias("working_point")))


def simulated_yield(
    df: DataFrame, cuts: Sequence[Column], axes: Sequence[tuple[Operand, Axis]], scale: DataFrame
) -> DataFrame:
    """Histogram of the selected generated rows times a one-row ``scale`` (cross-section over entries)."""
    selected = df
    for c in cuts:
        selected = selected.where(c)
    h, s = fill(selected, axes), scale.scalar()
    return h.withColumn("content", F.col("content") * s).withColumn("sumw2", F.col("sumw2") * s * s)


def spectra_in_bins(
    df: DataFrame,
    axis: tuple[Operand, Axis],
    by: Sequence[str],
    second: str,
    lows: Sequence[float],
    highs: Sequence[float],
    weight: Operand | None = None,
) -> DataFrame:
    """Histogram per group and per (overlapping, closed) second bin.

    Rows are first aggregated on the set of second bins they belong to, and only
    these partial sums are spread over the bins.  Overlap therefore multiplies a
    few bins instead of every row.
    """
    h = fill(df.withColumn("__mask", bin_mask(second, lows, highs)), [axis], [*by, "__mask"], weight)
    spread = h.withColumn("ibin2", F.explode(mask_bins("__mask", len(lows)))).drop("__mask")
    return project(spread, [*by, "ibin2", "ix"])


def inverse_weight(w: Operand) -> Column:
    """1/w, a zero weight counting as 1."""
    w = col(w).cast("double")
    return F.lit(1.0) / F.when(w == 0, 1.0).otherwise(w)


# fixed bit numbers of the event-rejection map
NOT_VERTEX_RELATED = [0, 5, 6, 10, 11]
VERTEX_MISSING = [1, 2, 7, 12]
VERTEX_OUTSIDE = 3


def norm_parts(events: DataFrame, bitmap: str, selected: Column, by: Sequence[str]) -> DataFrame:
    """Selected, vertex-less and outside-vertex event counts in one aggregation."""
    kept = bits.has_bits(bitmap, off=NOT_VERTEX_RELATED)
    has_vertex = bits.has_bits(bitmap, off=VERTEX_MISSING)
    return events.groupBy(*by).agg(
        F.count_if(selected).alias("n_sel"),
        F.count_if(kept & ~has_vertex).alias("n_no_vertex"),
        F.count_if(kept & bits.has_bits(bitmap, [VERTEX_OUTSIDE], VERTEX_MISSING)).alias("n_vertex_out"),
    )


def range_counts(df: DataFrame, reco: Column, gen: Column, by: Sequence[str]) -> DataFrame:
    """Rows inside the reconstructed range, the generated range, and both."""
    return df.groupBy(*by).agg(
        F.count_if(reco).alias("n_reco"), F.count_if(gen).alias("n_gen"), F.count_if(reco & gen).alias("n_both"))


def with_total(df: DataFrame, period: str, by: Sequence[str], total: str = "all") -> DataFrame:
    """Counts per period plus the sum over periods.

    Rows are counted per period first; the total is formed from the counts.
    """
    counts = df.groupBy(period, *by).agg(F.count("*").cast("double").alias("content"))
    out = counts.rollup(*by, period).agg(F.grouping(period).alias("__t"), F.grouping(by[-1]).alias("__b"), F.sum("content").alias("content"))
    return out.where("__b = 0").withColumn(period, F.when(F.col("__t") == 1, F.lit(total)).otherwise(F.col(period))).drop("__t", "__b")


def distribution_job(
    df: DataFrame,
    query: str | None,
    unique: Sequence[str],
    columns: Sequence[str],
    axis: tuple[Operand, Axis],
    by: Sequence[str],
    slices: Mapping[str, str] | None = None,
) -> DataFrame:
    """Filter, keep one entry per key, and fill one histogram per group and slice.

    ``columns`` must be functions of the ``unique`` key (event quantities), so one
    entry per key is a plain aggregation and a repeated key never travels.
    """
    kept = select_rows(df, query).select(*unique, *columns).groupBy(*unique).agg(*[F.min(c).alias(c) for c in columns])
    if not slices:
        return fill(kept, [axis], by)
    floats = float_columns(kept)
    tags = F.array_compact(F.array(*[F.when(condition(q, floats), F.lit(s)) for s, q in slices.items()]))
    return fill(kept.withColumn("slice", F.explode(tags)), [axis], [*by, "slice"])
