"""Curves and tables from scored rows: ROC, precision/recall, confusion, thresholds, working points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import Edges, Uniform
from ..functions.predicates import Operand, chosen_by_bin, col
from ..session import stored
from .algebra import efficiency
from .hist import fill, project
from .peaks import curve_integral, polynomial_fit, significance


def _score_counts(scored: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("int")
    s = F.col(score).cast("double")
    s = F.when(s.isNull() | F.isnan(s), float("-inf")).otherwise(s)  # below all thresholds
    return scored.groupBy(*by, s.alias("threshold")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def score_curve(scored: DataFrame, label: str, score: str, by: Sequence[str] = (), slice_rows: int = 50_000) -> DataFrame:
    """(by..., threshold, tp, fp, pos, neg, n_pos, n_neg): rows at or above each distinct score.

    Rows are counted per distinct score first, and the counters are stored, so a score is
    evaluated once.  A running sum over all scores in one window would end in one
    task, so the scores are cut into slices of about ``slice_rows`` distinct ones; the slice
    totals give the offsets, and the running sums inside the slices are independent
    tasks.  Scores that are NaN or NULL lie below all others, at minus infinity.
    """
    counts = stored(_score_counts(scored, label, score, by), "scores")
    slices = 1 + counts.count() // slice_rows
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted({c for c in counts.approxQuantile("threshold", shares, 0.5 / slices) if abs(c) != float("inf")}) if shares else []
    sliced = (
        Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="threshold", outputCol="__slice").transform(counts)
        if cuts else counts.withColumn("__slice", F.lit(0.0))
    )
    totals = sliced.groupBy(*by, "__slice").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    above = group.orderBy(F.desc("__slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "__slice", F.coalesce(F.sum("__p").over(above), F.lit(0)).alias("__p0"), F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__n0"),
        F.sum("__p").over(group).alias("n_pos"), F.sum("__n").over(group).alias("n_neg"))
    inside = Window.partitionBy(*by, "__slice").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sliced.join(offsets, [*by, "__slice"]).select(
        *by, "threshold", (F.col("__p0") + F.sum("pos").over(inside)).alias("tp"), (F.col("__n0") + F.sum("neg").over(inside)).alias("fp"),
        "pos", "neg", "n_pos", "n_neg")


def precision_recall(curve: DataFrame) -> DataFrame:
    keys = [c for c in curve.columns if c not in ("tp", "fp", "pos", "neg", "n_pos", "n_neg")]
    return curve.select(*keys, F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), F.try_divide(F.col("tp"), F.col("n_pos")).alias("recall"))


def roc(curve: DataFrame) -> DataFrame:
    keys = [c for c in curve.columns if c not in ("tp", "fp", "pos", "neg", "n_pos", "n_neg")]
    return curve.select(*keys, F.try_divide(F.col("fp"), F.col("n_neg")).alias("fpr"), F.try_divide(F.col("tp"), F.col("n_pos")).alias("tpr"))


def area_under_curve(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, ties counting half.

    Each distinct score adds its negatives times the positives above it plus half
    of those at it, which is the trapezoid rule.
    """
    curve = score_curve(scored, label, score, by)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") * 0.5))
    return curve.groupBy(*by).agg(F.try_divide(area, F.max("n_pos") * F.max("n_neg").cast("double")).alias("auc"))


def accuracy(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    hit = F.col(label).cast("double") == F.col(prediction).cast("double")
    return scored.groupBy(*by).agg(F.avg(hit.cast("double")).alias("accuracy"))


def confusion(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n, share, error_share): raw, per true class, and with the diagonal set to 0.

    The last form is normalised like the second; only the mistakes keep their value.
    """
    n = scored.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(F.count("*").alias("n"))
    share = F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy("label")))
    return n.withColumn("share", share).withColumn("error_share", F.when(F.col("label") == F.col("prediction"), 0.0).otherwise(F.col("share")))


def score_densities(scored: DataFrame, score: str, by: Sequence[str], axis: Uniform = Uniform(25, 0.0, 1.0)) -> DataFrame:
    """Normalised score distribution per group (class, train/test) with its error; the upper edge belongs to the last bin."""
    top = F.when(F.col(score) == axis.hi, F.lit(axis.hi - axis.width / 2)).otherwise(F.col(score))
    h = fill(scored.withColumn("__s", top), [("__s", axis)], by, flow=False)
    n = F.sum("content").over(Window.partitionBy(*by))
    return h.select(*by, "ix", F.try_divide(F.col("content"), n * axis.width).alias("density"), F.try_divide(F.sqrt("content"), n * axis.width).alias("error"))


def scan_thresholds(n_steps: int) -> list[float]:
    """int(n/10)-1 steps on [0, 0.49], the rest on [0.5, 1]."""
    left = int(n_steps / 10) - 1
    right = n_steps - left

    def spaced(a: float, b: float, n: int) -> list[float]:
        return [a] if n == 1 else [a + (b - a) / (n - 1) * i for i in range(n)]

    return spaced(0.0, 0.49, left) + spaced(0.5, 1.0, right)


def thresholds_passed(score: Operand, thresholds: Sequence[float]) -> Column:
    """How many of the sorted thresholds are at or below the score (NaN and NULL pass none)."""
    s = col(score).cast("double")
    return F.when(s.isNull() | F.isnan(s), F.lit(0)).otherwise(Edges(tuple(thresholds)).index(s))


def signal_efficiency(signal: DataFrame, score: str, thresholds: Sequence[float], keep_empty: bool = True) -> DataFrame:
    """(step, threshold, eff, eff_err) with ``score >= threshold``.

    Rows are counted per number of thresholds passed; the efficiency at a step is a
    running sum over those counters.  Without any signal row it is 0, or with ``keep_empty`` off there are no steps.
    """
    n = len(thresholds)
    counts = signal.groupBy(thresholds_passed(score, thresholds).alias("k")).agg(F.count("*").alias("c"))
    table = counts.agg(F.map_from_entries(F.collect_list(F.struct("k", "c"))).alias("m"), F.coalesce(F.sum("c"), F.lit(0)).alias("total"))
    table = table if keep_empty else table.where("total > 0")
    steps = table.select("m", "total", F.posexplode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("step", "threshold"))
    steps = steps.withColumn("num", F.aggregate(F.sequence(F.col("step") + 1, F.lit(n)), F.lit(0).cast("long"), lambda a, k: a + F.coalesce(F.try_element_at("m", k), F.lit(0))))
    eff, err = efficiency("num", "total")
    return steps.select("step", "threshold", F.coalesce(eff, F.lit(0.0)).alias("eff"), F.coalesce(err, F.lit(0.0)).alias("eff_err"))


def background_scan(
    data: DataFrame, score: str, mass: str, thresholds: Sequence[float], axis: Uniform, lo: float, hi: float, order: int = 1, min_entries: int = 5,
    flow: bool = False, quotients: bool = False,
) -> DataFrame:
    """(step, threshold, bkg, bkg_err): polynomial through the side bands above each threshold, integrated over [lo, hi].

    One scan fills (thresholds passed, mass bin) counters; only these are spread over
    the thresholds.  A threshold with at most ``min_entries`` rows gets 0, and so does one without a solution (all rows
    in one bin); with ``quotients`` the latter gets what the division of the determinants gives, NaN mostly.  With ``flow``
    the rows beyond both ends count as one more bin at each.
    """
    n = len(thresholds)
    h = fill(data.withColumn("k", thresholds_passed(score, thresholds)).where("k > 0"), [(mass, axis)], ["k"], flow=flow)
    per = project(h.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("k") - 1))), ["step", "ix"])
    centre, half = (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    fit = polynomial_fit(per.withColumn("x", axis.centre("ix")), ["step"], order, "x", "content", F.try_divide(F.lit(1.0), F.col("sumw2")), centre, half, quotients=quotients)
    total = per.groupBy("step").agg(F.sum("content").alias("n_side"))
    bkg = curve_integral(F.lit(lo), F.lit(hi), [f"c{i}" for i in range(order + 1)], axis) / axis.width
    enough = (F.col("n_side") > min_entries) & bkg.isNotNull()
    found = fit.join(total, "step").select(
        "step", F.when(enough, bkg).otherwise(0.0).alias("bkg"), F.when(enough, F.abs(bkg) / F.sqrt("n_side")).otherwise(0.0).alias("bkg_err"))
    steps = data.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("step", "threshold"))
    # fillna would turn NaN into 0 as well
    return steps.join(found, "step", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("bkg", "bkg_err")})


def expected_signal(
    curve: DataFrame, lo: float, hi: float, band: str, fragmentation: float, br: float, acceptance: Operand | float, taa: float,
    sigma_mb: float, f_prompt: float,
) -> DataFrame:
    """Signal expected per event from a theory curve (pb per unit pt) between lo and hi; one row ``expected``."""
    acc = F.lit(float(acceptance)) if isinstance(acceptance, (int, float)) else col(acceptance)
    width = hi - lo
    production = F.sum(band) * fragmentation * 1e-12 / width
    out = curve.where((F.col("pt") >= lo) & (F.col("pt") < hi)).agg(production.alias("__p"))
    return out.select((2.0 * F.col("__p") * width * br * acc * taa / (sigma_mb * f_prompt)).alias("expected"))


def significance_scan(eff: DataFrame, bkg: DataFrame, expected: Column | float, background_events: float, event_counts: Mapping[str, float]) -> DataFrame:
    """Significance per event at each threshold, and scaled with sqrt(N) to the given event counts."""
    x = F.lit(float(expected)) if isinstance(expected, (int, float)) else expected
    df = eff.join(bkg.drop("threshold"), "step").withColumn("__x", x)
    s, es = F.col("eff") * F.col("__x"), F.col("eff_err") * F.col("__x")
    b, eb = F.col("bkg") / background_events, F.col("bkg_err") / background_events
    v = significance(s, b, es, eb)
    out = df.select("step", "threshold", v["signif"].alias("per_event"), v["signif_err"].alias("per_event_err"))
    return out.withColumns({name: F.col("per_event") * float(n) ** 0.5 for name, n in event_counts.items()})


def working_point_limits(
    df: DataFrame, bin_col: str, score: str, denominator: Column, centre: Mapping[int, float], low: Mapping[int, float], high: Mapping[int, float],
    n_steps: int, max_change: float,
) -> DataFrame:
    """(bin, min_cut, max_cut): outermost cuts per bin whose efficiency differs from the nominal one by less than ``max_change``.

    Each row is located once among the 2n + 1 cuts of its bin; counts per
    position are aggregated in one scan and summed up per cut afterwards.  The first
    step (from outside inwards) that fulfils the condition wins, null if none does.
    """
    cuts = {
        b: [low[b] + i * (c - low[b]) / n_steps for i in range(n_steps)] + [c] + [high[b] - i * (high[b] - c) / n_steps for i in range(n_steps)]
        for b, c in centre.items()
    }
    s = F.col(score)
    pos = F.lit(None).cast("int")
    for b, values in cuts.items():
        pos = F.when(F.col(bin_col) == b, Edges(tuple(sorted(values))).index(s, strict=True)).otherwise(pos)
    pos = F.when(F.isnan(s), F.lit(0)).otherwise(pos)
    counts = df.where(denominator & F.col(bin_col).isin(list(cuts))).groupBy(bin_col, pos.alias("__pos")).agg(F.count("*").alias("__c"))
    per_bin = counts.groupBy(bin_col).agg(F.collect_list(F.struct("__pos", "__c")).alias("__l"))  # at most 2n + 2 positions
    side = lambda k: "lo" if k < n_steps else "nominal" if k == n_steps else "hi"
    rows = [(b, side(k), k, float(c), sorted(v).index(c) + 1) for b, v in cuts.items() for k, c in enumerate(v)]
    steps = df.sparkSession.createDataFrame(rows, "__b int, __side string, __step int, __cut double, __rank int")
    above = F.aggregate("__l", F.lit(0).cast("long"), lambda a, e: a + F.when(e["__pos"] >= F.col("__rank"), e["__c"]).otherwise(F.lit(0)))
    tried = per_bin.join(steps, F.col(bin_col) == F.col("__b")).select(bin_col, "__side", "__step", "__cut", above.alias("__n"))
    nominal = F.max(F.when(F.col("__side") == "nominal", F.col("__n"))).over(Window.partitionBy(bin_col))
    near = F.coalesce(F.abs(F.try_divide(F.col("__n") - F.col("__nom"), F.col("__nom"))) < max_change, F.lit(False))
    scored = tried.withColumn("__nom", nominal).withColumn("__ok", near)

    def first_hit(which: str) -> Column:
        hit = F.col("__ok") & (F.col("__side") == which)
        return F.min(F.when(hit, F.struct("__step", "__cut")))["__cut"]

    return scored.groupBy(bin_col).agg(first_hit("lo").alias("min_cut"), first_hit("hi").alias("max_cut"))


def working_point_grid(limits: DataFrame, bin_col: str, centre: Mapping[int, float], n: int) -> DataFrame:
    """(bin, trial, cut): n cuts from the lower limit up to the centre, then n from above the centre to the upper limit."""
    c = chosen_by_bin(bin_col, centre)
    lo, hi = F.col("min_cut"), F.col("max_cut")
    lower = [lo + i * ((c - lo) / n) for i in range(n)]
    upper = [c + (i + 1) * ((hi - c) / n) for i in range(n)]
    return limits.select(bin_col, F.posexplode(F.array(*lower, *upper)).alias("trial", "cut"))
