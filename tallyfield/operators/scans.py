"""De-duplication, correlations, cut scans and spreads over trials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import Operand, col
from .hist import auto_hist, limited_ranges, melt, numbered, variable_names


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest in the given total order.

    A minimum over a struct is combined before the shuffle, so a key holding a
    third of the rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def duplicate_summary(df: DataFrame, file_col: str, keys: Sequence[str]) -> DataFrame:
    """Per file: rows, rows whose key occurs more than once, such keys, and their percentage."""
    copies = df.groupBy(file_col, *keys).agg(F.count("*").alias("copies"))
    twice = F.col("copies") > 1
    out = copies.groupBy(file_col).agg(
        F.sum("copies").alias("n_rows"),
        F.sum(F.when(twice, F.col("copies")).otherwise(0)).alias("n_duplicates"),
        F.count_if(twice).alias("n_keys"),
    )
    return out.withColumn("percent", F.try_divide(F.col("n_duplicates") * 100.0, F.col("n_rows")))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, with the number of copies.

    Copies are counted by an aggregation with map-side combine and joined back;
    a window would pull all copies of a hot key into one task, while the join is
    split by the skew handling or broadcast.
    """
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    return df.join(copies, list(keys))


def co_moments(df: DataFrame, variables: Sequence[str], by: Sequence[str], weight: str | None = None, diagonal: bool = True) -> DataFrame:
    """Weighted means, variances and covariances of all variable pairs for all groups at once: one aggregation.

    One row per group and pair i <= j (i < j without ``diagonal``): ``a``, ``b``, ``n`` rows, ``w`` their weight, ``mean_a``, ``mean_b``, ``var_a``, ``var_b``, ``cov`` (population).
    The sums are taken around rough centres (the means over all rows that count, one row of numbers), so that large
    offsets do not cancel.  A row with a NULL, NaN or infinite variable, or a weight that is not above 0, is left out.
    The products of a row live in its own task; one vector of sums per group and task is shuffled.
    """
    x = [F.col(f"`{v}`").cast("double") for v in variables]
    fine = [F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c) for c in x]
    w = F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")
    used = df.select(*by, F.array(*fine).alias("__x"), w.alias("__w")).where("__w > 0 and not isnan(__w) and not exists(__x, v -> v is null)")
    centre = used.agg(*[F.avg(F.col("__x")[i]) for i in range(len(variables))]).first()
    rows = used.withColumn("__x", F.zip_with("__x", F.array(*[F.lit(float(m or 0.0)) for m in centre]), lambda v, m: v - m))
    k = len(variables)
    products = F.flatten(F.transform("__x", lambda v, i: F.transform(F.slice("__x", i + 1, k), lambda u: u * v)))
    rows = rows.withColumn("__v", array_to_vector(F.concat("__x", products)))
    means = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("__w").alias("w"), vector_to_array(Summarizer.mean(F.col("__v"), F.col("__w"))).alias("m"))
    names, mids = F.array(*map(F.lit, variables)), F.array(*[F.lit(float(m or 0.0)) for m in centre])
    at = {(i, j): k + n for n, (i, j) in enumerate((i, j) for i in range(k) for j in range(i, k))}  # place of a product among the means
    pairs = F.explode(F.expr("array(" + ", ".join(f"struct({i} AS i, {j} AS j, {n} AS ij, {at[i, i]} AS ii, {at[j, j]} AS jj)" for (i, j), n in at.items() if diagonal or i < j) + ")"))
    each = means.withColumn("__p", pairs)
    m = F.col("m")

    def centred(product: str, one: str, other: str) -> Column:
        return m[F.col(f"__p.{product}")] - m[F.col(f"__p.{one}")] * m[F.col(f"__p.{other}")]

    return each.select(*by, names[F.col("__p.i")].alias("a"), names[F.col("__p.j")].alias("b"), "n", "w",
                       (m[F.col("__p.i")] + mids[F.col("__p.i")]).alias("mean_a"), (m[F.col("__p.j")] + mids[F.col("__p.j")]).alias("mean_b"),
                       centred("ii", "i", "i").alias("var_a"), centred("jj", "j", "j").alias("var_b"), centred("ij", "i", "j").alias("cov"))


def correlations(df: DataFrame, variables: Sequence[str], by: Sequence[str], weight: str | None = None) -> DataFrame:
    """Pearson coefficient of every variable pair per group, from the co-moments of all groups at once.

    A variable whose variance is 0 to rounding has no coefficient (null).
    """
    m = co_moments(df, variables, by, weight, diagonal=False)

    def spread(variance: str, mean: str) -> Column:
        return F.col(variance) > 1e-14 * F.col(mean) * F.col(mean)

    return m.select(*by, "a", "b", F.when(spread("var_a", "mean_a") & spread("var_b", "mean_b"), F.col("cov") / F.sqrt(F.col("var_a") * F.col("var_b"))).alias("corr"))


def trial_spread(trials: DataFrame, by: Sequence[str], value: str, nominal: Column) -> DataFrame:
    """Mean and RMS over trials and the relative difference of the mean to the nominal trial."""
    out = trials.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("rms"), F.max(F.when(nominal, F.col(value))).alias("nominal"))
    return out.withColumn("rel_diff", F.try_divide(F.col("mean") - F.col("nominal"), F.col("nominal")))


def _thresholds(lo: Operand, hi: Operand, n: int, k: Column) -> Column:
    return col(lo) + (col(hi) - col(lo)) / n * k


def cut_scan(
    df: DataFrame,
    variables: Mapping[str, str],
    centres: Mapping[str, float] | None = None,
    limits: Mapping[str, tuple[float, float]] | None = None,
    n: int = 100,
) -> DataFrame:
    """Share of rows passing each of n thresholds per variable: (variable, step, threshold, share).

    ``variables`` maps a column to a direction: ``lt`` keeps values above the
    threshold, ``st`` below, ``abslt``/``absst`` do so for the distance to the
    centre.  Each row is located once between the thresholds; the shares are
    running sums over at most n+2 counters per variable.
    """
    centres = centres or {}
    shifted = df.select(*[
        (F.abs(F.col(v) - float(centres[v])) if d.startswith("abs") else F.col(v)).cast("double").alias(v)
        for v, d in variables.items()
    ])
    names = list(variables)
    ranges = limited_ranges(shifted, names, limits or {})
    upward = [i for i, d in enumerate(variables.values()) if "lt" in d]
    # one row per variable: a checked size
    ranges = numbered(ranges, names).withColumn("__above", F.col("v").isin(upward))
    long = melt(shifted, names).where("x is not null and not isnan(x)").join(F.broadcast(ranges), "v")
    # number of thresholds passed: x > lo + w k for k = 0..n-1, or x < lo + w k for k = 1..n
    guess = F.try_divide((F.col("x") - F.col("lo")) * n, F.col("hi") - F.col("lo"))
    g = F.least(F.greatest(F.floor(guess), F.lit(-1)), F.lit(n + 1))

    def refine(k: Column, passes) -> Column:
        # floating-point rounding can misplace a value by one threshold at most
        return F.when(passes(k + 1), k + 1).when(passes(k), k).otherwise(k - 1)

    up = refine(g, lambda k: F.col("x") > _thresholds("lo", "hi", n, k))
    down = refine(g, lambda k: F.col("x") >= _thresholds("lo", "hi", n, k))
    pos = F.least(F.greatest(F.when(F.col("__above"), up).otherwise(down), F.lit(-1)), F.lit(n)).cast("int")
    counts = long.select("v", pos.alias("pos")).groupBy("v", "pos").agg(F.count("*").alias("c")).join(F.broadcast(ranges), "v")
    counts = counts.withColumn("variable", variable_names(names))
    steps = counts.groupBy("variable", "__above", "lo", "hi").agg(
        F.sum("c").alias("total"), F.map_from_entries(F.collect_list(F.struct("pos", "c"))).alias("m"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(-1), F.lit(n))).alias("pos")).withColumn(
        "c", F.coalesce(F.try_element_at("m", F.col("pos")), F.lit(0)))
    w = Window.partitionBy("variable").orderBy("pos")
    tail = F.sum("c").over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    head = F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = steps.withColumn("num", F.when(F.col("__above"), tail).otherwise(head)).where(f"pos between 0 and {n - 1}")
    return out.select(
        "variable",
        F.col("pos").alias("step"),
        _thresholds("lo", "hi", n, F.when(F.col("__above"), F.col("pos")).otherwise(F.col("pos") + 1)).alias("threshold"),
        F.try_divide(F.col("num").cast("double"), F.col("total")).alias("share"),
    )


def probability_scan(
    df: DataFrame, variables: Sequence[str], probability: Operand, thresholds: Sequence[float], n: int = 100,
    limits: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Histogram of every variable above growing thresholds and its ratio to the first: (variable, ix, threshold, content, ratio).

    A row is counted once, under the number of thresholds it exceeds; the content
    for one threshold is a running sum over that number.
    """
    cuts = sorted(thresholds)
    p = col(probability)
    passed = sum((F.when((p > c) & ~F.isnan(p), 1).otherwise(0) for c in cuts), F.lit(0))
    kept = df.withColumn("__k", passed).where("__k > 0").select(*variables, "__k")
    h = auto_hist(kept, variables, ["__k"], n, limits)
    bins = h.groupBy("variable", "ix").agg(F.map_from_entries(F.collect_list(F.struct("__k", "content"))).alias("m"))
    long = bins.select("variable", "ix", F.posexplode(F.array(*[F.lit(float(c)) for c in cuts])).alias("i", "threshold"), "m")
    parts = [F.when(F.col("i") < k, F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0.0))).otherwise(0.0) for k in range(1, len(cuts) + 1)]
    total = sum((F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0.0)) for k in range(1, len(cuts) + 1)), F.lit(0.0))
    return long.select("variable", "ix", "threshold", sum(parts, F.lit(0.0)).alias("content")
                       , F.try_divide(sum(parts, F.lit(0.0)), total).alias("ratio"))


def best_by(df: DataFrame, by: Sequence[str], value: str, score: str) -> DataFrame:
    """Value with the highest score per group."""
    return df.groupBy(*by).agg(F.max_by(value, score).alias("best"), F.max(score).alias("best_score"))
