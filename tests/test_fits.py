"""Peak fits and the covariance of unfolding: known peaks, numerical derivatives."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.functions.bins import Uniform
from tallyfield.operators import algebra, fits

AXIS = Uniform(80, 1.7, 2.1)


def truth(kind, signal, mean, sigma, level):
    x = np.array([AXIS.lo + (i + 0.5) * AXIS.width for i in range(AXIS.n)])
    t = (x - 1.9) / 0.2
    below = level * {"line": 1 - 0.3 * t, "parabola": 1 - 0.3 * t + 0.2 * t * t, "exponential": np.exp(-0.8 * t)}[kind]
    return signal * AXIS.width * np.exp(-0.5 * ((x - mean) / sigma) ** 2) / (sigma * math.sqrt(2 * math.pi)) + below


@pytest.mark.parametrize("kind", ["line", "parabola", "exponential"])
def test_known_peaks_are_recovered(spark, kind):
    known = {(g, h): (2000.0 + 700 * g, 1.87 + 0.01 * g, 0.008 + 0.003 * h) for g in range(3) for h in range(2)}
    rows = [(g, h, i + 1, float(y), float(y)) for (g, h), (s, m, w) in known.items() for i, y in enumerate(truth(kind, s, m, w, 150.0))]
    df = spark.createDataFrame(rows, "g int, h int, ix int, content double, sumw2 double")
    start = spark.createDataFrame([(g, h, m + 0.006, w * 1.5) for (g, h), (_, m, w) in known.items()], "g int, h int, mean double, sigma double")
    got = {(r.g, r.h): r for r in fits.peak_fit(df, ["g", "h"], AXIS, start, kind).collect()}
    assert set(got) == set(known)
    for k, (s, m, w) in known.items():
        r = got[k]
        assert r.converged and r.chi2 < 0.5 and r.ndf == AXIS.n - 3 - fits.BACKGROUNDS[kind]
        assert abs(r.signal / s - 1) < 0.01 and abs(r.mean - m) < 0.01 * w and abs(r.sigma / w - 1) < 0.01
        assert math.sqrt(s) < r.signal_err < 0.2 * s and 0.5 * w / math.sqrt(s) < r.mean_err < 5 * w / math.sqrt(s)


def test_errors_are_those_of_the_inverse_matrix(spark):
    y = truth("line", 1500.0, 1.9, 0.012, 100.0)
    df = spark.createDataFrame([(i + 1, float(v), float(v)) for i, v in enumerate(y)], "ix int, content double, sumw2 double")
    start = spark.createDataFrame([(1.9, 0.012)], "mean double, sigma double")
    r = fits.peak_fit(df.withColumn("g", F.lit(1)), ["g"], AXIS, start.withColumn("g", F.lit(1)), "line").first()
    t = np.array([(AXIS.lo + (i + 0.5) * AXIS.width - 1.9) / 0.2 for i in range(AXIS.n)])
    u, s = (r.mean - 1.9) / 0.2, r.sigma / 0.2
    z = (t - u) / s
    bell = np.exp(-0.5 * z * z)
    j = np.stack([bell, r.height * bell * z / s, r.height * bell * z * z / s, np.ones_like(t), t])
    cov = np.linalg.inv((j / y) @ j.T)
    got = [r.height_err, r.mean_err / 0.2, r.sigma_err / 0.2, r.c0_err, r.c1_err]
    assert np.allclose(got, np.sqrt(np.diag(cov)), rtol=1e-9)
    a = np.array([s, 0, r.height, 0, 0]) * math.sqrt(2 * math.pi) * 0.2 / AXIS.width
    assert abs(r.signal_err / math.sqrt(a @ cov @ a) - 1) < 1e-9


def test_fits_without_enough_bins(spark):
    df = spark.createDataFrame([("few", i + 1, 5.0, 5.0) for i in range(3)] + [("zero", i + 1, 0.0, 0.0) for i in range(40)], "g string, ix int, content double, sumw2 double")
    start = spark.createDataFrame([("few", 1.9, 0.01), ("zero", 1.9, 0.01)], "g string, mean double, sigma double")
    got = fits.peak_fit(df, ["g"], AXIS, start, "line", rounds=2).collect()
    assert [r.g for r in got if not r.converged] == ["few"] == [r.g for r in got]
    assert fits.peak_fit(df.limit(0), ["g"], AXIS, start, "line", rounds=1).count() == 0


def unfolded(resp, d, rounds):
    p, u = resp / resp.sum(axis=0), resp.sum(axis=0)
    for _ in range(rounds):
        j = p * u
        u = ((j / j.sum(axis=1, keepdims=True)) * d[:, None]).sum(axis=0)
    return u


@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_covariance_equals_numerical_derivatives(spark, rounds):
    r = np.random.default_rng(8)
    resp = np.diag(r.integers(20, 60, 5)).astype(float) + r.integers(1, 12, (5, 5))
    d, e2 = r.integers(30, 90, 5).astype(float), r.integers(20, 70, 5).astype(float)
    table = spark.createDataFrame([(i, k, float(resp[i, k]), g) for i in range(5) for k in range(5) for g in (1, 2)], "r int, t int, w double, g int")
    data = spark.createDataFrame([(i, float(d[i]) * g, float(e2[i]), g) for i in range(5) for g in (1, 2)], "r int, content double, sumw2 double, g int")
    got = algebra.unfold_covariance(data, table, ["g"], ["t"], ["r"], rounds)
    for g in (1, 2):
        slope = np.stack([(unfolded(resp, d * g + h, rounds) - unfolded(resp, d * g - h, rounds)) / 2e-4 for h in np.eye(5) * 1e-4], axis=1)
        want = slope @ np.diag(e2) @ slope.T
        mine = np.zeros((5, 5))
        for row in got.where(F.col("g") == g).collect():
            mine[row.t, row.t_2] = row.covariance
        assert np.allclose(mine, want, rtol=1e-6, atol=1e-6 * np.abs(want).max())


def test_trials_with_an_exponential_background(spark):
    from tallyfield.operators import peaks

    y = truth("exponential", 3000.0, 1.9, 0.01, 200.0)
    df = spark.createDataFrame([("a", i + 1, float(v), float(v)) for i, v in enumerate(y)], "g string, ix int, content double, sumw2 double")
    pk = spark.createDataFrame([("a", 1.9, 0.01)], "g string, mean double, sigma double")
    trials = [{"rebin": r, "lo": 1.7, "hi": 2.1, "order": o, "background": b, "window": 3.0} for r in (1, 2) for o, b in ((0, "exponential"), (2, "polynomial"))]
    got = {r.trial: r for r in peaks.multi_trial(df, pk, ["g"], AXIS, trials, 2.0, 3.0, reject_sigma=4.0).collect()}
    assert set(got) == {0, 1, 2, 3} and all(r.accepted and abs(r.signal / 3000 - 1) < 0.02 for r in got.values())
    # as many counts under the peak as fitted beside it would give the root of the counts times the ratio
    assert all(0.1 * math.sqrt(r.bkg) < r.bkg_err < 2 * math.sqrt(r.bkg) and r.signif_err > 0 for r in got.values())
    assert got[0].bkg_err < got[1].bkg_err  # fewer parameters
