"""Bin algebra, unfolding, corrections, budgets and peaks: properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallyfield.functions.bins import Edges, Uniform
from tallyfield.operators import algebra, budgets, corrections, hist, peaks


def h(spark, *bins):
    return spark.createDataFrame([(i + 1, float(c), float(v)) for i, (c, v) in enumerate(bins)], "ix int, content double, sumw2 double")


def test_empty_denominators(spark):
    a, b = h(spark, (4, 4), (0, 0), (3, 3)), h(spark, (8, 8), (0, 0))
    assert rows(algebra.divide(a, b, ["ix"]).select("ix", "content")) == [(1, 0.5), (2, 0.0), (3, 0.0)]
    r = rows(algebra.divide_binomial(a, b, ["ix"]))
    assert r[0][1] == 0.5 and r[0][2] == pytest.approx(0.5 * 0.5 / 8) and r[2] == (3, 0.0, 0.0)
    c = rows(algebra.divide_correlated(a, b, ["ix"]))
    assert c[1][1] is None and c[0][1] == 0.5


def test_efficiencies_stay_between_0_and_1(spark):
    df = spark.range(500).select((F.rand(1) * 10).alias("x"), (F.rand(2) < 0.4).alias("ok"))
    ax = [("x", Uniform(10, 0.0, 10.0))]
    e = algebra.divide_binomial(hist.fill(df.where("ok"), ax), hist.fill(df, ax), ["ix"])
    assert e.where("content < 0 or content > 1 or sumw2 < 0").count() == 0


def response(spark, matrix):
    return spark.createDataFrame([(r + 1, g + 1, float(w)) for r, row in enumerate(matrix) for g, w in enumerate(row) if w], "r int, g int, w double")


def test_fold_with_identity(spark):
    d = h(spark, (5, 5), (7, 7)).withColumnRenamed("ix", "g")
    assert rows(algebra.fold(d, response(spark, [[3, 0], [0, 9]]), [], ["g"], ["r"])) == [(1, 5.0, 5.0), (2, 7.0, 7.0)]


def test_unfold_recovers_the_truth_of_the_response_and_matches_numpy(spark):
    m = np.array([[40.0, 10, 0], [10, 60, 15], [0, 10, 45]])
    resp = response(spark, m)
    d = h(spark, *[(c, c) for c in m.sum(axis=1)]).withColumnRenamed("ix", "r")
    out = rows(algebra.unfold(d, resp, [], ["g"], ["r"], 3))
    assert [c for _, c, _ in out] == pytest.approx(list(m.sum(axis=0)))  # measured from the same pairs: closure
    data = np.array([70.0, 60, 80])
    p, u = m / m.sum(axis=0), m.sum(axis=0)
    for _ in range(6):
        post = p * u / (p * u).sum(axis=1, keepdims=True)
        u = (post * data[:, None]).sum(axis=0)
    d = h(spark, *[(c, c) for c in data]).withColumnRenamed("ix", "r")
    out = rows(algebra.unfold(d, resp, [], ["g"], ["r"], 6, cut_every=2))
    assert [c for _, c, _ in out] == pytest.approx(list(u))


def test_unfold_many_groups_at_once(spark):
    resp = response(spark, [[40, 10], [10, 60]])
    d = h(spark, (50, 50), (70, 70)).withColumnRenamed("ix", "r")
    both = d.withColumn("t", F.lit(1)).unionByName(algebra.scale(d, 2.0).withColumn("t", F.lit(2)))
    got = {(t, g): c for t, g, c, _ in rows(algebra.unfold(both, resp, ["t"], ["g"], ["r"], 4))}
    assert got[2, 1] == pytest.approx(2 * got[1, 1]) and got[2, 2] == pytest.approx(2 * got[1, 2])


def test_closure_is_one_for_equal_halves(spark):
    resp = response(spark, [[40, 10], [10, 60]])
    d = h(spark, (50, 50), (70, 70)).withColumnRenamed("ix", "r")
    truth = h(spark, (50, 50), (70, 70)).withColumnRenamed("ix", "g")
    out = algebra.closure(algebra.unfold(d, resp, [], ["g"], ["r"], 2), truth, [], ["g"], ["g"])
    assert [c for _, c, _ in rows(out)] == pytest.approx([1.0, 1.0])
    assert [c for _, c, _ in rows(algebra.refold(truth, d, resp, [], ["g"], ["r"], ["r"]))] == pytest.approx([1.0, 1.0])


def test_clip(spark):
    d = h(spark, (-1, 2), (0, 3), (2, 4))
    assert rows(algebra.clip_negative(d)) == [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 2.0, 4.0)]
    assert rows(algebra.clip_negative(d, strict=True))[1] == (2, 0.0, 3.0)


@pytest.fixture(scope="module")
def peak(spark):
    """Gaussian peak (mean 1.86, sigma 0.012, 3000 entries) on a straight line, in two groups."""
    axis = Uniform(120, 1.7, 2.06)
    out = []
    for g, n in (("a", 3000.0), ("b", 0.0)):
        for i in range(axis.n):
            x = axis.lo + (i + 0.5) * axis.width
            bkg = 200 - 60 * (x - 1.7)
            sig = n * axis.width / (0.012 * math.sqrt(2 * math.pi)) * math.exp(-0.5 * ((x - 1.86) / 0.012) ** 2)
            out.append((g, i + 1, bkg + sig, bkg + sig, sig, bkg))
    return axis, spark.createDataFrame(out, "g string, ix int, content double, sumw2 double, sig double, bkg double").cache()


def test_planted_peak_is_recovered(spark, peak):
    axis, df = peak
    pk = peaks.clipped_moments(df.where("g = 'a'").select("g", "ix", F.col("sig").alias("content")), ["g"], axis, 4.0)
    r = pk.first()
    assert r["mean"] == pytest.approx(1.86, abs=1e-4) and r.sigma == pytest.approx(0.012, rel=0.02)
    both = spark.createDataFrame([("a", 1.86, 0.012), ("b", 1.86, 0.012)], "g string, mean double, sigma double")
    fit = peaks.sideband_fit(df, ["g"], axis, 1, F.lit(1.86 - 0.06), F.lit(1.86 + 0.06))
    got = {r.g: r.signal for r in peaks.counted_yield(df, fit, both, ["g"], axis, 3.0, ["c0", "c1"]).collect()}
    assert got["a"] == pytest.approx(3000, rel=0.01) and abs(got["b"]) < 1
    side = df.groupBy("g").agg(F.sum("bkg").alias("n_side"))
    b = {r.g: r.bkg for r in peaks.background_under_peak(fit, both, side, ["g"], axis, 3.0, ["c0", "c1"]).collect()}
    want = (200 * 0.072 - 60 * ((1.896 - 1.7) ** 2 - (1.824 - 1.7) ** 2) / 2) / axis.width
    assert b["b"] == pytest.approx(want, rel=1e-4)


def test_fits_match_numpy_and_skip_short_groups(spark):
    rng = np.random.default_rng(1)
    x, y, w = rng.uniform(10, 20, 40), rng.normal(5, 1, 40), rng.uniform(0.5, 2, 40)
    df = spark.createDataFrame([("a", float(a), float(b), float(c)) for a, b, c in zip(x, y, w)] + [("b", 11.0, 1.0, 1.0), ("b", 12.0, 2.0, 1.0)], "g string, x double, y double, w double")
    for order in (1, 2, 3):
        got = {r.g: r for r in peaks.polynomial_fit(df, ["g"], order, "x", "y", "w", 15.0, 5.0).collect()}
        want = np.polynomial.polynomial.polyfit((x - 15) / 5, y, order, w=np.sqrt(w))
        assert [got["a"][f"c{i}"] for i in range(order + 1)] == pytest.approx(list(want), abs=1e-8)
        assert (got["b"].c0 is None) == (order > 1)


def test_exponential(spark):
    axis = Uniform(30, 0.0, 3.0)
    df = spark.createDataFrame([("a", i + 1, 100 * math.exp(-0.7 * (i + 0.5) * 0.1)) for i in range(30)], "g string, ix int, content double")
    fit = peaks.exponential_fit(df, ["g"], axis, F.lit(1.0), F.lit(1.2))
    v = fit.select(peaks.exponential_integral(F.lit(0.0), F.lit(3.0), axis)).first()[0]
    assert v == pytest.approx(100 / 0.7 * (1 - math.exp(-2.1)), rel=1e-6)


def test_significance_guards(spark):
    df = spark.createDataFrame([(9.0, 16.0), (0.0, 5.0), (-3.0, 1.0)], "s double, b double")
    v = peaks.significance("s", "b", F.lit(3.0), F.lit(4.0))
    got = rows(df.select(v["signif"], v["signif_err"], v["s_over_b"]))
    assert got[:2] == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0)] and got[2][0] == pytest.approx(1.8)
    assert got[2][1] == pytest.approx(1.8 * math.sqrt(25 / (4 * 625) + 16 / 25 * 9 / 81))


def test_multi_trial(spark, peak):
    axis, df = peak
    pk = spark.createDataFrame([("a", 1.86, 0.012), ("b", 1.86, 0.012)], "g string, mean double, sigma double")
    trials = [{"rebin": r, "lo": 1.7, "hi": 2.06, "order": o, "window": 3.0} for r in (1, 2, 3) for o in (1, 2)]
    out = peaks.multi_trial(df.select("g", "ix", "content", "sumw2"), pk, ["g"], axis, trials, 2.0, 3.0, reject_sigma=5.0)
    a = [r for r in out.collect() if r.g == "a"]
    assert len(a) == 6 and all(r.accepted and r.signal == pytest.approx(3000, rel=0.02) for r in a)
    assert not any(r.accepted for r in out.collect() if r.g == "b")


def test_sidebands_remove_a_flat_background(spark, peak):
    axis, df = peak
    df = df.where("g = 'a'")
    shape = df.withColumn("iy", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "content", F.col("bkg") / 2 + F.when(F.col("iy") == 1, F.col("sig")).otherwise(0.0)).withColumn("sumw2", F.col("content")).select("g", "ix", "iy", "content", "sumw2")
    pk = spark.createDataFrame([("a", 1.86, 0.012)], "g string, mean double, sigma double")
    fit = peaks.sideband_fit(df, ["g"], axis, 1, F.lit(1.80), F.lit(1.92)).join(pk, "g")
    eff = spark.createDataFrame([("a", 0.5)], "g string, content double")
    out = rows(corrections.subtract_sidebands(shape, fit, eff, ["g"], ["g"], axis, ["c0", "c1"], corrections.Regions(signal_share=0.9545)))
    assert out[0][2] == pytest.approx(3000 / 0.5, rel=0.05) and out[1][2] < 200


def test_missing_fit_drops_the_group(spark, peak):
    axis, df = peak
    fit = spark.createDataFrame([("a", 1.86, 0.012, None, None)], "g string, mean double, sigma double, c0 double, c1 double")
    eff = spark.createDataFrame([("a", 0.5)], "g string, content double")
    shape = df.select("g", "ix", F.lit(1).alias("iy"), "content", "sumw2")
    assert corrections.subtract_sidebands(shape, fit, eff, ["g"], ["g"], axis, ["c0", "c1"]).count() == 0


def test_bin_contributions_sum_up(spark):
    d = spark.createDataFrame([(1, 1, 60.0, 60.0), (2, 1, 40.0, 400.0), (1, 2, 0.0, 0.0)], "ipt int, iy int, content double, sumw2 double")
    out = {r.ipt: r for r in corrections.bin_contributions(d, ["iy"]).collect()}
    assert out[1].signal_share == pytest.approx(60) and out[2].variance_share == pytest.approx(100 * 400 / 460)
    assert out[1].improves == 1 and out[2].improves == 2 and out[2].gain_incl > 0


def test_envelope_and_categories(spark):
    central = h(spark, (10, 0))
    v = spark.createDataFrame([(1, "cut", 13.0, False, False, False), (1, "cut", 8.0, False, False, False), (1, "rms", 12.0, True, False, True), (1, "rms", 14.0, True, False, True)],
                              "ix int, category string, content double, rms boolean, rms_both_sides boolean, symmetrise boolean")
    e = budgets.envelope(v, central, ["ix"]).first()
    assert (e.err_up, e.err_down) == (4.0, 2.0)
    per, total = budgets.combine_categories(v, central, ["ix"])
    got = {r.category: (r.up, r.down) for r in per.collect()}
    assert got["cut"] == (3.0, 2.0) and got["rms"] == (pytest.approx(math.sqrt(10)), pytest.approx(math.sqrt(10)))
    t = total.first()
    assert t.up == pytest.approx(math.sqrt(19)) and t.down == pytest.approx(math.sqrt(14))


def err(spark, *items, central=10.0):
    return spark.createDataFrame([(s, 1, 0.0, 0.0, float(a), float(b), central) for s, a, b in items], "source string, ibin int, x_low double, x_up double, y_low double, y_up double, central double")


def test_ratio_rules(spark):
    n = err(spark, ("yield", 0.3, 0.3), ("pid", 0.9, 0.9), ("ptshape", 0.5, 0.1), ("statunceff", 0.2, 0.2))
    d = err(spark, ("yield", 0.4, 0.1), ("pid", 0.1, 0.1), ("ptshape", 0.1, 0.1), ("statunceff", 0.1, 0.1))
    r = budgets.ratio_errors(n, d, budgets.HIGH_OVER_MINIMUM_BIAS).first()
    assert r.y_low == pytest.approx(math.sqrt(0.16 + 0.16 + 0.05)) and r.y_up == pytest.approx(math.sqrt(0.09 + 0.05))
    r = budgets.ratio_errors(n, d, budgets.HIGH_OVER_MINIMUM_BIAS, same_simulation=True).first()
    assert r.y_low == pytest.approx(math.sqrt(0.16 + 0.16 + 0.03))
    assert budgets.ratio_errors(n, d, budgets.HIGH_OVER_MINIMUM_BIAS, only_feeddown=True).count() == 0
    with pytest.raises(Exception, match="unknown error source"):
        budgets.ratio_errors(err(spark, ("other", 1, 1)), err(spark, ("other", 1, 1)), budgets.HIGH_OVER_MINIMUM_BIAS).collect()
    with pytest.raises(Exception, match="different sources"):
        budgets.ratio_errors(n, err(spark, ("yield", 1, 1)), budgets.HIGH_OVER_MINIMUM_BIAS).collect()


def test_envelope_rules(spark):
    n, d = err(spark, ("feeddown_NB", 1.0, 2.0), central=10.0), err(spark, ("feeddown_NB", 1.0, 1.0), central=20.0)
    r = budgets.ratio_errors(n, d, budgets.PARTICLE_RATIO).first()
    ratios = [9 / 19, 10 / 20, 12 / 21]
    assert r.y_low == pytest.approx((0.5 - min(ratios)) / 0.5) and r.y_up == pytest.approx((max(ratios) - 0.5) / 0.5) and r.x_low == 0


def test_channel_average(spark):
    cols = "ibin int, y1 double, e1 double, u1 double, br1 double, f1 double, f_low1 double, f_high1 double, y2 double, e2 double, u2 double, br2 double, f2 double, f_low2 double, f_high2 double"
    df = spark.createDataFrame([(1, 10.0, 1.0, 0.1, 0.05, 0.9, 0.1, 0.1, 12.0, 1.2, 0.1, 0.05, 0.9, 0.1, 0.1), (2, None, 1.0, 0.1, 0.05, 0.9, 0.1, 0.1, 7.0, 0.5, 0.2, 0.05, 0.8, 0.1, 0.1)], cols)
    w = budgets.channel_weights(df)
    out = {r.ibin: r for r in budgets.average_channels(w).collect()}
    assert out[1].y == pytest.approx(11.0) and out[1].e == pytest.approx(math.hypot(1.0, 1.2) / 2) and out[2].y == 7.0 and out[2].f == 0.8
    t = spark.createDataFrame([("cut", 1, 0.0, 0.0, 0.3, 0.3), ("track", 1, 0.0, 0.0, 0.3, 0.3)], "source string, ibin int, x_low double, x_up double, y_low double, y_up double")
    got = {r.source: r.y_low for r in budgets.average_errors(t, t, w).collect()}
    assert got["track"] == pytest.approx(0.3) and got["cut"] == pytest.approx(0.3 / math.sqrt(2))


def test_cross_section_guards(spark):
    df = spark.createDataFrame([(1, 100.0, 10.0, 5.0, 0.9, 0.5, 0.01, 1.0, 0.3), (2, 0.0, 0.0, 0.0, 0.9, 0.5, 0.01, 1.0, 0.3), (3, 100.0, 10.0, 5.0, 0.9, 0.0, 0.0, 1.0, 0.3)],
                               "ix int, `yield` double, yield_err double, yield_syst double, f_prompt double, eff double, eff_err double, mc_fd double, eff_fd double")
    out = {r.ix: r for r in corrections.corrected_cross_section(df, F.lit(2.0), 1.0, 0.04, (100.0, 1.0), (1.0, 0.0)).collect()}
    assert out[1].corr_yield == pytest.approx(45) and out[1].sigma == pytest.approx(45 / (0.04 * 2 * 100 * 0.5))
    assert out[2].sigma == 0 and out[2].sigma_err == 0 and out[3].sigma == 0


ONE_SCAN = ["G01_add", "G02_multiply", "G03_divide", "G04_divide_binomial", "G06_divide_lists", "G07_divide_correlated", "G23_total_error",
            "G24_high_over_minimum_bias", "G25_particle_ratio_errors", "G26_double_ratio_errors", "G27_average_channels", "G27_average_errors",
            "G35_trigger_turn_on", "G37_clip_negative", "H08_seed_chain"]


@pytest.mark.parametrize("key", ONE_SCAN)
def test_operands_come_from_one_scan(spark, key):
    import __spark_entry__ as contract

    out = contract.queries()[key](spark, "/root/testdata/sf0.001")
    physical = out._jdf.queryExecution().sparkPlan().toString()
    for name in ("lineitem", "orders"):
        assert physical.count(f"/{name}.parquet") <= 1, physical


def test_operands_keep_bins_of_either_side(spark):
    df = spark.createDataFrame([("a", 0.5, 2.0), ("a", 1.5, 3.0), ("b", 1.5, 4.0), (None, 2.5, 5.0), ("c", 2.5, 1.0)], "cls string, x double, w double")
    axis = Edges.of(0.0, 1.0, 2.0, 3.0)
    h = hist.fill_classes(df, [("x", axis)], {"a": F.col("cls") == "a", "b": F.col("cls") == "b"}, weight="w")
    both = algebra.operands(h, ["ix"], "a", "b")
    assert rows(both.select("ix", "a_content", "a_sumw2", "b_content", "b_sumw2")) == [(1, 2.0, 4.0, 0.0, 0.0), (2, 3.0, 9.0, 4.0, 16.0)]
    apart = [hist.fill(df.where(F.col("cls") == c), [("x", axis)], weight="w") for c in "ab"]
    for op in (algebra.add, algebra.multiply, algebra.divide, algebra.divide_binomial, algebra.divide_correlated):
        assert rows(op(both, None, ["ix"])) == rows(op(*apart, ["ix"]))
    by_class = hist.fill(df, [("x", axis)], ["cls"], weight="w")
    again = algebra.operands(by_class, ["ix"], F.col("cls") == "a", F.col("cls") == "b")
    assert rows(again.select(*both.columns)) == rows(both)
    empty = hist.fill_classes(df.where("false"), [("x", axis)], {"a": F.lit(True), "b": F.lit(True)})
    assert algebra.operands(empty, ["ix"], "a", "b").count() == 0
