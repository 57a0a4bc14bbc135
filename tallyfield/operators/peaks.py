"""Peak position, background curve, signal yield and significance from histograms.

Everything is a closed-form aggregate per group, so any number of groups and
trials is estimated in one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import Uniform
from ..functions.predicates import Operand, col
from .fits import curve_error, with_named
from .hist import rebin_by


def clipped_moments(
    hist: DataFrame, by: Sequence[str], axis: Uniform, n_sigma: float = 3.0, rounds: int = 3
) -> DataFrame:
    """Mean and width (by..., mean, sigma) of a labelled peak, re-estimated inside mean +- n_sigma sigma.

    Works on binned content: the rows were counted once, the rounds only touch
    the bins of each group.
    """
    w = Window.partitionBy(*(by or [F.lit(1)]))
    df = hist.where(F.col("ix").between(1, axis.n)).withColumn("x", axis.centre("ix"))
    inside = F.lit(True)
    for i in range(rounds):
        c = F.when(inside, F.col("content")).otherwise(0.0)
        df = df.withColumn(f"__m{i}", F.try_divide(F.sum(c * F.col("x")).over(w), F.sum(c).over(w)))
        spread = F.try_divide(F.sum(c * (F.col("x") - F.col(f"__m{i}")) * (F.col("x") - F.col(f"__m{i}"))).over(w), F.sum(c).over(w))
        df = df.withColumn(f"__s{i}", F.sqrt(spread))
        inside = F.abs(F.col("x") - F.col(f"__m{i}")) <= n_sigma * F.col(f"__s{i}")
    last = rounds - 1
    return df.groupBy(*by).agg(F.max(f"__m{last}").alias("mean"), F.max(f"__s{last}").alias("sigma"))


def determinant(m: Sequence[Sequence[str]]) -> str:
    """Laplace expansion over column names; matrices here are at most 4 x 4."""
    if len(m) == 1:
        return m[0][0]
    terms = []
    for j, head in enumerate(m[0]):
        minor = determinant([[*r[:j], *r[j + 1:]] for r in m[1:]])
        terms.append(f"{'+' if j % 2 == 0 else '-'} {head} * {minor}")
    return "(" + " ".join(terms).lstrip("+ ") + ")"


def solve(sums: Sequence[str], rhs: Sequence[str], quotients: bool = False) -> list[Column]:
    """Least-squares coefficients from the columns of power sums S_0..S_2k and right-hand sides T_0..T_k; null if singular.

    With ``quotients`` a singular system gives NaN or infinity, as a division of doubles does in SQL.
    """
    k = len(rhs)
    m = [[sums[i + j] for j in range(k)] for i in range(k)]
    det = determinant(m)
    tops = [determinant([[rhs[r] if c == p else m[r][c] for c in range(k)] for r in range(k)]) for p in range(k)]
    if quotients:
        return [F.expr(f"CASE WHEN {det} = 0 THEN {top} * double('Infinity') ELSE {top} / {det} END") for top in tops]
    return [F.expr(f"try_divide({top}, {det})") for top in tops]


def polynomial_fit(
    points: DataFrame,
    by: Sequence[str],
    order: int,
    x: Operand,
    y: Operand,
    weight: Operand,
    centre: float,
    half_width: float,
    keep: Column | None = None,
    quotients: bool = False,
) -> DataFrame:
    """Weighted polynomial through the points: (by..., c0..ck, n_points) in t = (x - centre) / half_width.

    Scaling x keeps the power sums well conditioned.  Null coefficients when
    there are no more points than the order, or the system is singular; with ``quotients``
    what the division of the determinants gives there.
    """
    sums = _power_sums(points, by, order, x, y, weight, centre, half_width, keep)
    return sums.select(*by, *[c.alias(f"c{i}") for i, c in enumerate(_coefficients(order, quotients))], "n_points")


def _power_sums(points, by, order, x, y, weight, centre, half_width, keep) -> DataFrame:
    """(by..., n_points, __s0..__s2k, __t0..__tk) in one aggregation."""
    t = (col(x) - centre) / half_width
    v = points.select(*by, t.alias("__t"), col(y).alias("__y"), col(weight).alias("__w"), (keep if keep is not None else F.lit(True)).alias("__k"))
    v = v.where("__k and __w is not null and __y is not null")
    power = [F.lit(1.0)]
    for _ in range(2 * order):
        power.append(power[-1] * F.col("__t"))
    w, yv = F.col("__w"), F.col("__y")
    return v.groupBy(*by).agg(
        F.count("*").alias("n_points"),
        *[F.sum(w * p).alias(f"__s{i}") for i, p in enumerate(power)],
        *[F.sum(w * yv * p).alias(f"__t{i}") for i, p in enumerate(power[: order + 1])],
    )


def _coefficients(order: int, quotients: bool = False) -> list[Column]:
    """Solution for one order; power sums of a higher order contain those of the lower ones."""
    coeff = solve([f"__s{i}" for i in range(2 * order + 1)], [f"__t{i}" for i in range(order + 1)], quotients)
    return coeff if quotients else [F.when(F.col("n_points") > order, c) for c in coeff]


def sideband_fit(hist: DataFrame, by: Sequence[str], axis: Uniform, order: int, lo: Operand, hi: Operand) -> DataFrame:
    """Polynomial background from the bins outside [lo, hi], weighted with 1/variance."""
    centre, half = (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    pts = hist.where(F.col("ix").between(1, axis.n)).withColumn("x", axis.centre("ix"))
    outside = (F.col("x") < col(lo)) | (F.col("x") > col(hi))
    weight = F.try_divide(F.lit(1.0), F.col("sumw2"))
    return polynomial_fit(pts, by, order, "x", "content", weight, centre, half, outside)


def exponential_fit(hist: DataFrame, by: Sequence[str], axis: Uniform, lo: Operand, hi: Operand) -> DataFrame:
    """Background exp(c0 + c1 t): straight line through ln(content), weighted with the content."""
    centre, half = (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    pts = hist.where(F.col("ix").between(1, axis.n) & (F.col("content") > 0)).withColumn("x", axis.centre("ix"))
    outside = (F.col("x") < col(lo)) | (F.col("x") > col(hi))
    return polynomial_fit(pts, by, 1, "x", F.ln("content"), "content", centre, half, outside)


def curve(x: Operand, coeff: Sequence[str], axis: Uniform) -> Column:
    """Value of a fitted polynomial at x."""
    t = (col(x) - (axis.lo + axis.hi) / 2) / ((axis.hi - axis.lo) / 2)
    out = F.lit(0.0)
    for c in reversed(coeff):
        out = out * t + F.col(c)
    return out


def curve_integral(lo: Operand, hi: Operand, coeff: Sequence[str], axis: Uniform) -> Column:
    """Integral of a fitted polynomial over x in [lo, hi]."""
    centre, half = (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    a, b = (col(lo) - centre) / half, (col(hi) - centre) / half
    out, pa, pb = F.lit(0.0), a, b
    for k, c in enumerate(coeff):
        out = out + F.col(c) * (pb - pa) / (k + 1)
        pa, pb = pa * a, pb * b
    return out * half


def exponential_integral(lo: Operand, hi: Operand, axis: Uniform) -> Column:
    """Integral of exp(c0 + c1 t) over x in [lo, hi]."""
    centre, half = (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    a, b = (col(lo) - centre) / half, (col(hi) - centre) / half
    c0, c1 = F.col("c0"), F.col("c1")
    sloped = F.exp(c0) * F.try_divide(F.exp(c1 * b) - F.exp(c1 * a), c1)
    return half * F.when(c1 == 0, F.exp(c0) * (b - a)).otherwise(sloped)


def background_under_peak(
    fits: DataFrame, peaks: DataFrame, sidebands: DataFrame, by: Sequence[str], axis: Uniform, n_sigma: float,
    coeff: Sequence[str],
) -> DataFrame:
    """(by..., bkg, bkg_err): curve over mean +- n_sigma sigma per bin width; relative error from the sideband counts.

    ``sidebands`` holds (by..., n_side), the counts the curve was fitted to.
    """
    df = fits.join(peaks, list(by)).join(sidebands, list(by))
    lo, hi = F.col("mean") - n_sigma * F.col("sigma"), F.col("mean") + n_sigma * F.col("sigma")
    bkg = curve_integral(lo, hi, coeff, axis) / axis.width
    err = F.when(F.col("n_side") > 0, F.abs(bkg) / F.sqrt("n_side")).otherwise(0.0)
    return df.select(*by, bkg.alias("bkg"), err.alias("bkg_err"))


def counted_yield(
    hist: DataFrame, fits: DataFrame, peaks: DataFrame, by: Sequence[str], axis: Uniform, n_sigma: float,
    coeff: Sequence[str],
) -> DataFrame:
    """(by..., signal, signal_err): content minus curve summed over the bins whose centre is within mean +- n_sigma sigma."""
    df = hist.where(F.col("ix").between(1, axis.n)).withColumn("x", axis.centre("ix")).join(fits, list(by)).join(peaks, list(by))
    near = F.abs(F.col("x") - F.col("mean")) <= n_sigma * F.col("sigma")
    return df.where(near).groupBy(*by).agg(
        F.sum(F.col("content") - curve("x", coeff, axis)).alias("signal"), F.sqrt(F.sum("sumw2")).alias("signal_err"))


def significance(s: Operand, b: Operand, s_err: Operand, b_err: Operand) -> dict[str, Column]:
    """S/B, S/sqrt(S+B) and its error; 0 when S or S+B is not positive."""
    s, b, es, eb = map(col, (s, b, s_err, b_err))
    ok = (s > 0) & (s + b > 0)
    value = F.try_divide(s, F.sqrt(F.greatest(s + b, F.lit(0.0))))
    inner = F.try_divide(es * es + eb * eb, 4 * (s + b) * (s + b)) + F.try_divide(b, s + b) * F.try_divide(es * es, s * s)
    return {
        "s_over_b": F.when(ok, F.coalesce(F.try_divide(s, b), F.lit(0.0))).otherwise(0.0),
        "signif": F.when(ok, value).otherwise(0.0),
        "signif_err": F.when(ok, value * F.sqrt(F.greatest(inner, F.lit(0.0)))).otherwise(0.0),
    }


def multi_trial(
    hist: DataFrame,
    peaks: DataFrame,
    by: Sequence[str],
    axis: Uniform,
    trials: Sequence[Mapping],
    max_chi2: float,
    min_significance: float,
    reject_sigma: float = 3.0,
) -> DataFrame:
    """Signal yield for a grid of fit settings: (by..., trial, signal, signal_err, chi2, signif, accepted, bkg, bkg_err, signif_err).

    A trial holds ``rebin``, ``lo``, ``hi`` (fit range), ``order`` (1 or 2) or ``background``
    "exponential", ``window`` (count window in sigma) and ``width`` (factor on sigma, 1 for the
    nominal width).  Trials multiply bins, never rows: all fits are one
    aggregation over (group, trial), whose power sums serve both orders; an exponential is a line through
    the logarithms.  The error of the background follows from the inverse of the normal equations.
    """
    def one(i: int, t: Mapping) -> str:
        bent = t.get("background") == "exponential"
        return (
            f"named_struct('trial', {i}, 'rebin', {int(t['rebin'])}, 'fit_lo', {float(t['lo'])!r}D, 'fit_hi', {float(t['hi'])!r}D, "
            f"'order', {1 if bent else int(t['order'])}, 'bent', {str(bent).lower()}, 'window', {float(t['window'])!r}D, 'width', {float(t.get('width', 1.0))!r}D)"
        )

    grid = F.expr("array(" + ", ".join(one(i, t) for i, t in enumerate(trials)) + ")")
    fine = hist.where(F.col("ix").between(1, axis.n)).select(*by, "ix", "content", "sumw2", F.explode(grid).alias("t"))
    bins = rebin_by(fine.select(*by, "t.*", "ix", "content", "sumw2"), "rebin").join(peaks, list(by))
    x = F.lit(axis.lo) + (F.col("ix") - 0.5) * F.col("rebin") * axis.width
    sigma, bent = F.col("sigma") * F.col("width"), F.col("bent")
    bins = bins.withColumn("x", x).withColumn("__y", F.col("content") / F.col("rebin")).withColumn("__v", F.col("sumw2") / (F.col("rebin") * F.col("rebin")))
    away = F.abs(F.col("x") - F.col("mean")) > reject_sigma * sigma
    used = away & F.col("x").between(F.col("fit_lo"), F.col("fit_hi")) & (F.col("__v") > 0) & (~bent | (F.col("__y") > 0))
    centre, half = (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    weight = F.try_divide(F.when(bent, F.col("__y") * F.col("__y")).otherwise(1.0), F.col("__v"))
    value = F.when(bent, F.ln(F.greatest("__y", F.lit(1e-300)))).otherwise(F.col("__y"))
    sums = _power_sums(bins, [*by, "trial", "order"], 2, "x", value, weight, centre, half, used)
    line, parabola, first = _coefficients(1) + [F.lit(0.0)], _coefficients(2), F.col("order") == 1
    powers = [f"__s{i}" for i in range(5)]
    fits = sums.select(
        *by, "trial", *[F.when(first, a).otherwise(b).alias(f"c{k}") for k, (a, b) in enumerate(zip(line, parabola))],
        "n_points", (F.col("order") + 1).alias("n_par"), *powers)
    scored = bins.join(fits, [*by, "trial"])
    straight = curve("x", ["c0", "c1", "c2"], axis)
    model = F.when(bent, F.exp(straight)).otherwise(straight)
    near = F.abs(F.col("x") - F.col("mean")) <= F.col("window") * sigma
    pull = F.try_divide((F.col("__y") - model) * (F.col("__y") - model), F.col("__v"))
    ndf = F.max("n_points") - F.max("n_par")
    t = (F.col("x") - centre) / half
    slope = F.col("rebin") * F.when(bent, model).otherwise(1.0)  # of the background by its constant term
    out = scored.groupBy(*by, "trial").agg(
        F.sum(F.when(near, F.col("content") - model * F.col("rebin"))).alias("signal"),
        F.sqrt(F.sum(F.when(near, F.col("sumw2")))).alias("signal_err"),
        F.sum(F.when(near, model * F.col("rebin"))).alias("bkg"),
        F.try_divide(F.sum(F.when(used, pull)), ndf).alias("chi2"),
        F.max("n_par").alias("n_par"),
        *[F.max(c).alias(c) for c in powers],
        *[F.sum(F.when(near, slope * p)).alias(f"__i{k}") for k, p in enumerate([F.lit(1.0), t, t * t])],
    )
    kept = [*by, "trial", "signal", "signal_err", "bkg", "chi2", "n_par"]
    third = with_named(out, curve_error(3, powers, ["__i0", "__i1", "__i2"])).select(*kept, *powers, "__i0", "__i1", F.col("variance").alias("third"))
    both = with_named(third, curve_error(2, powers, ["__i0", "__i1"])).select(*kept, F.when(F.col("n_par") == 3, F.col("third")).otherwise(F.col("variance")).alias("variance"))
    out = both.withColumn("bkg_err", F.sqrt(F.greatest("variance", F.lit(0.0))))
    scores = significance("signal", "bkg", "signal_err", "bkg_err")
    out = out.withColumns({"signif": scores["signif"], "signif_err": scores["signif_err"]})
    good = (F.col("chi2") <= max_chi2) & (F.col("signif") >= min_significance)
    accepted = F.coalesce(good, F.lit(False)).alias("accepted")
    return out.select(*by, "trial", "signal", "signal_err", "chi2", "signif", accepted, "bkg", "bkg_err", "signif_err")


def seed_chain(nominal: DataFrame, by: Sequence[str], parameters: Sequence[str], stages: Sequence[DataFrame], locked: Sequence[str] = ()) -> DataFrame:
    """Start values per group: the first stage that has a parameter wins, the nominal value is the last resort.

    Parameters in ``locked`` always keep the nominal value.
    """
    out = nominal.select(*by, *[F.col(p).alias(f"__n_{p}") for p in parameters])
    for i, s in enumerate(stages):
        out = out.join(s.select(*by, *[F.col(p).alias(f"__{i}_{p}") for p in parameters]), list(by), "left")
    return _chosen(out, by, parameters, len(stages), locked)


def moment_seeds(df: DataFrame, by: Sequence[str], x: str, stages: Sequence[Column], locked: Sequence[str] = ()) -> DataFrame:
    """`seed_chain` of mean and width where all stages are conditions on the same rows: one aggregation for all of them."""
    out = df.groupBy(*by).agg(F.avg(x).alias("__n_mean"), F.stddev_pop(x).alias("__n_sigma"), *[
        f(F.when(s, F.col(x))).alias(f"__{i}_{p}") for i, s in enumerate(stages) for p, f in (("mean", F.avg), ("sigma", F.stddev_pop))])
    return _chosen(out, by, ["mean", "sigma"], len(stages), locked)


def _chosen(out: DataFrame, by: Sequence[str], parameters: Sequence[str], n: int, locked: Sequence[str]) -> DataFrame:
    chosen = {
        p: F.col(f"__n_{p}") if p in locked else F.coalesce(*[F.col(f"__{i}_{p}") for i in range(n)], F.col(f"__n_{p}"))
        for p in parameters
    }
    return out.select(*by, *[c.alias(p) for p, c in chosen.items()])
