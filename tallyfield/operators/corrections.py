"""Sidebands, feed-down, corrected yields and cross-sections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import Axis, Uniform
from ..functions.predicates import Operand, col
from .algebra import add, clip_negative, divide, fold, ratio, ratio_variance, scale, scale_by
from .hist import normalise, project
from .joins import align
from .peaks import curve_integral


@dataclass(frozen=True)
class Regions:
    """Windows in units of the peak width."""

    signal: float = 2.0
    inner_left: float = 4.0
    outer_left: float = 9.0
    inner_right: float = 4.0
    outer_right: float = 9.0
    left_only: bool = False
    signal_share: float = 0.9545  # part of the peak inside the signal window


def sideband_regions(hist: DataFrame, fits: DataFrame, by: Sequence[str], axis: Uniform, regions: Regions) -> DataFrame:
    """Signal window and side bands per (by..., iy) in one pass: sig, left, right and their variances.

    ``hist`` has the mass on ``ix``; ``fits`` holds (by..., mean, sigma, ...) and
    groups without a fit drop out.  A window covers the bins that hold its ends.
    """
    m, s = F.col("mean"), F.col("sigma")
    df = hist.join(fits, list(by))

    def window(lo: Column, hi: Column) -> Column:
        return F.col("ix").between(axis.index(lo), axis.index(hi))

    r = regions
    areas = {
        "sig": window(m - r.signal * s, m + r.signal * s),
        "left": window(m - r.outer_left * s, m - r.inner_left * s),
        "right": window(m + r.inner_right * s, m + r.outer_right * s),
    }
    aggs = []
    for name, inside in areas.items():
        aggs += [F.sum(F.when(inside, F.col("content")).otherwise(0.0)).alias(name),
                 F.sum(F.when(inside, F.col("sumw2")).otherwise(0.0)).alias(f"{name}_w2")]
    return df.groupBy(*by, "iy").agg(*aggs)


def subtract_sidebands(
    hist: DataFrame, fits: DataFrame, eff: DataFrame, by: Sequence[str], eff_keys: Sequence[str], axis: Uniform,
    coeff: Sequence[str], regions: Regions = Regions(),
) -> DataFrame:
    """Background-subtracted, efficiency-corrected shape per (by..., iy).

    The side-band shape is scaled with the ratio of the background curve under
    the signal window to that under the bands.  Bins not above 0 become 0.  A bin
    with efficiency 0 is left uncorrected.
    """
    m, s, r = F.col("mean"), F.col("sigma"), regions
    band = curve_integral(m - r.outer_left * s, m - r.inner_left * s, coeff, axis)
    if not r.left_only:
        band = band + curve_integral(m + r.inner_right * s, m + r.outer_right * s, coeff, axis)
    area = F.try_divide(curve_integral(m - r.signal * s, m + r.signal * s, coeff, axis), band)
    scales = fits.select(*by, area.alias("__area")).where("__area is not null")
    df = sideband_regions(hist, fits, by, axis, r).join(scales, list(by))
    bkg, bkg_w2 = F.col("left"), F.col("left_w2")
    if not r.left_only:
        bkg, bkg_w2 = bkg + F.col("right"), bkg_w2 + F.col("right_w2")
    a = F.col("__area")
    sub = df.select(*by, "iy", (F.col("sig") - a * bkg).alias("content"), (F.col("sig_w2") + a * a * bkg_w2).alias("sumw2"))
    sub = clip_negative(sub).join(eff.select(*eff_keys, F.col("content").alias("__eff")), list(eff_keys), "left")
    k = F.when(F.col("__eff") > 0, F.lit(1.0) / (F.col("__eff") * r.signal_share)).otherwise(1.0)
    return scale(sub, k).drop("__eff")


def sideband_ratio(areas: DataFrame, by: Sequence[str]) -> DataFrame:
    """Right over left side band, each normalised to 1 per group."""
    left = normalise(areas.select(*by, "iy", F.col("left").alias("content"), F.col("left_w2").alias("sumw2")), by, axis="iy")
    right = normalise(areas.select(*by, "iy", F.col("right").alias("content"), F.col("right_w2").alias("sumw2")), by, axis="iy")
    return divide(right, left, [*by, "iy"])


def bin_contributions(parts: DataFrame, total_keys: Sequence[str]) -> DataFrame:
    """Share of signal and of variance each part (pt bin) adds to the total over parts, in percent.

    ``improves`` is 1 when the part lowers the relative error, 2 when not;
    ``gain_incl`` and ``gain_excl`` are the changes of the relative error when the part is
    added or left out.
    """
    w = Window.partitionBy(*total_keys)
    c, v = F.col("content"), F.col("sumw2")
    df = parts.withColumn("__s", F.sum(c).over(w)).withColumn("__v", F.sum(v).over(w)).where("__s > 0 and __v > 0")
    s, u = F.col("__s"), F.sqrt("__v")
    fs, fv = c / s, v / F.col("__v")
    full = u / s
    rest = F.try_divide(F.sqrt(F.greatest(F.col("__v") - v, F.lit(0.0))), s - c)
    usable = (c > 0) & (fs < 1 - 1e-7) & (fv < 1 - 1e-7)
    return df.where(c > 0).select(
        *[k for k in parts.columns if k not in ("content", "sumw2")],
        (100 * fs).alias("signal_share"),
        (100 * fv).alias("variance_share"),
        F.when(usable, F.when(fs + F.try_divide(fv, fs) < 2, 1).otherwise(2)).alias("improves"),
        F.when(usable, 100 * F.try_divide(full - rest, rest)).alias("gain_incl"),
        F.when(usable, 100 * F.try_divide(rest - full, full)).alias("gain_excl"),
    )


def feeddown_yield(
    simulated: DataFrame, eff_fd: DataFrame, eff_pr: DataFrame, eff_keys: Sequence[str], gen: Sequence[str],
    kin_gen: DataFrame, response: DataFrame, reco: Sequence[str], kin_reco: DataFrame, factor: float,
) -> DataFrame:
    """Simulated feed-down at reconstructed level.

    Per pt bin times non-prompt over prompt efficiency (0 if either is 0), summed over pt, times the gen-level
    kinematic efficiency and ``factor`` (events x branching ratio / cross-section), folded, divided by the reco-level
    kinematic efficiency.
    """
    pair = align(eff_fd, eff_pr, eff_keys)
    both = (F.col("a_content") != 0) & (F.col("b_content") != 0)
    r = F.when(both, F.try_divide(F.col("a_content"), F.col("b_content"))).otherwise(0.0)
    weighted = simulated.join(pair.select(*eff_keys, r.alias("__r")), list(eff_keys), "left")
    summed = project(scale(weighted, F.coalesce("__r", F.lit(0.0))), gen)
    seen = fold(scale(scale_by(summed, kin_gen, gen), factor), response, [], gen, reco)
    return scale_by(seen, kin_reco, reco, "divide")


def subtract_feeddown(data: DataFrame, feeddown: DataFrame, keys: Sequence[str]) -> DataFrame:
    return clip_negative(add(data, feeddown, keys, -1.0), strict=True)


def feeddown_fraction(feeddown: DataFrame, data: DataFrame, keys: Sequence[str]) -> DataFrame:
    return divide(feeddown, data, keys)


def shape_and_cross_section(hist: DataFrame, by: Sequence[str], axis: Axis, sigma: float, n_events: Operand | float, br: float, name: str = "ix") -> DataFrame:
    """Self-normalised density and cross-section per unit of the axis, with errors."""
    n = F.lit(float(n_events)) if isinstance(n_events, (int, float)) else col(n_events)
    w = Window.partitionBy(*(by or [F.lit(1)]))
    width, total = axis.widths(name), F.sum("content").over(w)
    k = F.lit(float(sigma)) / (n * br * width)
    shape = F.try_divide(F.lit(1.0), total * width)
    c, e = F.col("content"), F.sqrt("sumw2")
    return hist.select(*by, name, (c * shape).alias("shape"), (e * shape).alias("shape_err"), (c * k).alias("xsec"), (e * k).alias("xsec_err"))


def corrected_cross_section(
    bins: DataFrame, width: Column, delta_y: float, br: float, lumi: tuple[float, float], trigger: tuple[float, float],
    eff_global: float = 0.0, both_charges: bool = True,
) -> DataFrame:
    """Corrected yield per bin width and cross-section.

    ``bins`` holds yield, yield_err, yield_syst, f_prompt, eff, eff_err, mc_fd, eff_fd.
    Adds corr_yield, corr_yield_err, sigma, sigma_err, sigma_syst.
    """
    y, eff = F.col("yield"), F.col("eff")
    usable = (y > 0) & (F.col("mc_fd") > 0) & (F.col("eff_fd") > 0)
    corr = F.greatest(F.when(usable, y * F.col("f_prompt")).otherwise(0.0) / width, F.lit(0.0))
    corr_err = F.when(corr != 0, F.col("yield_err")).otherwise(0.0) / width
    charges = 2.0 if both_charges else 1.0
    norm = eff * (delta_y * br * charges * lumi[0])
    sigma = F.when((eff != 0) & (y > 0), F.try_divide(F.col("corr_yield"), norm)).otherwise(0.0)
    rel = F.try_divide(F.col("corr_yield_err"), F.col("corr_yield"))
    syst_rel = F.try_divide(F.col("yield_syst") / width, F.col("corr_yield"))
    eff_rel = F.try_divide(F.col("eff_err"), eff)
    syst = F.sqrt(syst_rel * syst_rel + (lumi[1] / lumi[0]) ** 2 + (trigger[1] / trigger[0]) ** 2 + eff_rel * eff_rel + eff_global**2)
    positive = F.col("sigma") > 0
    return (
        bins.withColumn("corr_yield", corr).withColumn("corr_yield_err", corr_err).withColumn("sigma", sigma)
        .withColumn("sigma_err", F.when(positive, F.col("sigma") * rel).otherwise(0.0))
        .withColumn("sigma_syst", F.when(positive, F.col("sigma") * syst).otherwise(0.0))
    )


def subtract_expected_feeddown(y: Operand, width: Column, lumi: float, delta_y: float, br: float, trigger: float, eff_fd: Operand, expected: Operand) -> Column:
    """(reco - L dy BR eff_trig eff_b N_b) / width, not below 0."""
    return F.greatest((col(y) - lumi * delta_y * br * trigger * col(eff_fd) * col(expected)) / width, F.lit(0.0))


def feeddown_union(first: Sequence[Operand], second: Sequence[Operand]) -> dict[str, Column]:
    """Range covered by two methods (value, err_low, err_high), given around the second one."""
    v1, l1, h1 = map(col, first)
    v2, l2, h2 = map(col, second)
    low, high = v2 - F.least(v1 - l1, v2 - l2), F.greatest(v1 + h1, v2 + h2) - v2
    return {"value": v2, "err_low": low, "err_high": high, "rel_low": F.try_divide(low, v2), "rel_high": F.try_divide(high, v2)}


def simple_cross_section(yields: DataFrame, eff: DataFrame, keys: Sequence[str], br: float, n_events: Operand | float, sigma: float, width: Column | None = None) -> DataFrame:
    """yield / efficiency / (2 BR N / sigma), optionally per bin width."""
    h = divide(yields, eff, keys)
    n = F.lit(float(n_events)) if isinstance(n_events, (int, float)) else col(n_events)
    k = F.lit(1.0) / (2.0 * br * n / sigma)
    return scale(h, k if width is None else k / width)


def ratio_to_nominal(trials: DataFrame, keys: Sequence[str], trial: str, nominal) -> DataFrame:
    """content of each trial over the nominal trial per bin; 0 for an empty nominal bin."""
    ref = trials.where(F.col(trial) == nominal).select(*keys, F.col("content").alias("__ref"))
    return trials.join(ref, list(keys), "left").withColumn("ratio", ratio(F.col("content"), F.coalesce("__ref", F.lit(0.0)))).drop("__ref")


def ratio_to_reference(hist: DataFrame, keys: Sequence[str], member: str, reference, factor: Column | None = None) -> DataFrame:
    """Ratio of every member (particle, period) to the reference member, after scaling by a per-member factor."""
    h = hist if factor is None else scale(hist, factor)
    ref = h.where(F.col(member) == reference).select(*keys, F.col("content").alias("b"), F.col("sumw2").alias("vb"))
    joined = h.where(F.col(member) != reference).join(ref, list(keys))
    c, v, b, vb = F.col("content"), F.col("sumw2"), F.col("b"), F.col("vb")
    return joined.select(member, *keys, ratio(c, b).alias("content"), ratio_variance(c, v, b, vb).alias("sumw2"))


def data_over_simulation(data: DataFrame, mc: DataFrame, by: Sequence[str], name: str = "ix") -> DataFrame:
    """Per-row weights: both distributions normalised to 1, divided bin by bin."""
    return divide(normalise(data, by), normalise(mc, by), [*by, name])
