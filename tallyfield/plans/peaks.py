"""Peak and background estimates on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import Uniform, inside
from ..operators import fits, hist, peaks, scans
from ..session import stored
from .registry import SHAPE, query, rounded, sql_bin
from .selections import items
from .spectra import IPT_SQL, N, with_ipt

PK = Uniform(40, 900.0, 105000.0)
CENTRE, HALF = (PK.lo + PK.hi) / 2, (PK.hi - PK.lo) / 2
CLIP = 1.0


def mass_sql(flag: str) -> str:
    return f"""(SELECT ipt, ix, {N} AS content, {N} AS sumw2, 900.0 + (ix - 0.5) * {PK.width} AS x FROM
        (SELECT {IPT_SQL} AS ipt, {sql_bin('l_extendedprice', PK)} AS ix FROM lineitem WHERE l_returnflag = '{flag}') WHERE ix BETWEEN 1 AND {PK.n} GROUP BY ALL)"""


def mass_cube(spark, sf):
    """(ipt, l_returnflag, l_linestatus, ix mass, iy shape): all a peak study needs, from one scan."""
    df = with_ipt(items(spark, sf))
    axes = [("l_extendedprice", PK), ("l_discount", SHAPE)]
    return stored(hist.fill(df, axes, ["ipt", "l_returnflag", "l_linestatus"]), "mass")


def mass(cube, flag):
    return hist.project(cube, ["ipt", "ix"], (F.col("l_returnflag") == flag) & inside("ix", PK))


def _moments(source: str) -> str:
    return f"""(SELECT ipt, m AS mean, sqrt(sum(content * (x - m) * (x - m)) / sum(content)) AS sigma
        FROM {source} h JOIN (SELECT ipt, sum(content * x) / sum(content) AS m FROM {source} GROUP BY 1) USING (ipt) GROUP BY ipt, m)"""


def peak_ctes(rounds: int = 3) -> str:
    """WITH-list ending in pk(ipt, mean, sigma); also mh (labelled) and dh (data) histograms."""
    parts = [f"mh AS {mass_sql('R')}", f"dh AS {mass_sql('N')}", f"pk0 AS {_moments('mh')}"]
    for i in range(1, rounds):
        parts.append(f"in{i} AS (SELECT mh.* FROM mh JOIN pk{i - 1} USING (ipt) WHERE abs(x - mean) <= {CLIP} * sigma)")
        parts.append(f"pk{i} AS {_moments(f'in{i}')}")
    parts.append(f"pk AS (SELECT * FROM pk{rounds - 1})")
    return "WITH " + ", ".join(parts)


def sql_det(m) -> str:
    if len(m) == 1:
        return m[0][0]
    return "(" + " ".join(
        ("+" if j % 2 == 0 else "-") + f" {m[0][j]} * {sql_det([r[:j] + r[j + 1:] for r in m[1:]])}" for j in range(len(m[0]))) + ")"


def fit_sql(source: str, by: str, order: int, where: str, y: str = "content", w: str = "1 / sumw2", x: str = "x",
            centre: float = CENTRE, half: float = HALF) -> str:
    """Weighted least squares by determinants."""
    powers = ", ".join(f"sum(({w}) * pow(({x} - {centre}) / {half}, {i})) AS s{i}" for i in range(2 * order + 1))
    rhs = ", ".join(f"sum(({w}) * ({y}) * pow(({x} - {centre}) / {half}, {i})) AS t{i}" for i in range(order + 1))
    m = [[f"s{i + j}" for j in range(order + 1)] for i in range(order + 1)]
    cs = []
    for p in range(order + 1):
        mp = [[f"t{r}" if c == p else m[r][c] for c in range(order + 1)] for r in range(order + 1)]
        cs.append(f"{sql_det(mp)} / {sql_det(m)} AS c{p}")
    return f"(SELECT {by}, {', '.join(cs)}, n_points FROM (SELECT {by}, count(*) AS n_points, {powers}, {rhs} FROM {source} WHERE {where} GROUP BY {by}))"


OUT = "(x < mean - 1.5 * sigma OR x > mean + 1.5 * sigma)"
LIN = fit_sql("(SELECT * FROM dh JOIN pk USING (ipt))", "ipt", 1, OUT)


def labelled_peaks(cube):
    return peaks.clipped_moments(mass(cube, "R"), ["ipt"], PK, CLIP, 3)


def linear_background(data, pk):
    """Straight line through the data outside mean +- 1.5 sigma: (ipt, c0, c1, n_points)."""
    m, s = F.col("mean"), F.col("sigma")
    return peaks.sideband_fit(data.join(pk, "ipt"), ["ipt"], PK, 1, m - 1.5 * s, m + 1.5 * s)


@query("H01_peak_moments", peak_ctes() + " SELECT ipt, round(mean, 4) AS mean, round(sigma, 4) AS sigma FROM pk")
def h01(spark, sf):
    return labelled_peaks(mass_cube(spark, sf)).select("ipt", rounded("mean", 4).alias("mean"), rounded("sigma", 4).alias("sigma"))


def cramer(n: int, right: list[str], matrix: str = "n") -> list[str]:
    """Solutions of a symmetric system by determinants."""
    m = [[f"{matrix}{max(i, j)}_{min(i, j)}" for j in range(n)] for i in range(n)]
    det = sql_det(m)
    return [f"{sql_det([[right[r] if c == p else m[r][c] for c in range(n)] for r in range(n)])} / {det}" for p in range(n)]


FIT_ROUNDS = 4


def peak_fit_sql() -> str:
    """Gauss-Newton rounds of a Gaussian on a line through the labelled histogram, from its moments."""
    z = "((t - u) / s)"
    bell = f"exp(-0.5 * {z} * {z})"
    slopes = [bell, f"h * {bell} * {z} / s", f"h * {bell} * {z} * {z} / s", "1.0", "t"]
    cells = ", ".join(f"sum(w * q{i} * q{j}) AS n{i}_{j}" for i in range(5) for j in range(i + 1))
    right = ", ".join(f"sum(w * q{i} * r) AS g{i}" for i in range(5))
    parts = [
        peak_ctes(),
        f"fb AS (SELECT ipt, (x - {CENTRE}) / {HALF} AS t, content AS y, 1.0 / sumw2 AS w FROM mh WHERE sumw2 > 0)",
        f"p0 AS (SELECT ipt, max(y)::DOUBLE AS h, any_value((mean - {CENTRE}) / {HALF}) AS u, any_value(sigma / {HALF}) AS s, 0.0::DOUBLE AS c0, 0.0::DOUBLE AS c1 FROM fb JOIN pk USING (ipt) GROUP BY ipt)",
    ]
    for k in range(FIT_ROUNDS + 1):
        q = ", ".join(f"{e} AS q{i}" for i, e in enumerate(slopes))
        parts.append(f"a{k} AS (SELECT ipt, {cells}, {right}, sum(w * r * r) AS chi2, count(*) AS np FROM (SELECT ipt, w, y - (h * {bell} + c0 + c1 * t) AS r, {q} FROM fb JOIN p{k} USING (ipt)) GROUP BY ipt)")
        if k < FIT_ROUNDS:
            damp = 1 + (fits.DAMPING[k] if k < len(fits.DAMPING) else 0.0)
            scaled = ", ".join(f"n{i}_{j} * {damp if i == j else 1.0} AS n{i}_{j}" for i in range(5) for j in range(i + 1))
            x = ", ".join(f"{e} AS x{i}" for i, e in enumerate(cramer(5, [f"g{i}" for i in range(5)])))
            parts.append(f"x{k} AS (SELECT ipt, {x} FROM (SELECT ipt, {scaled}, {', '.join(f'g{i}' for i in range(5))} FROM a{k}))")
            parts.append(f"p{k + 1} AS (SELECT ipt, h + x0 AS h, u + greatest(-2 * s, least(2 * s, x1)) AS u, greatest(s / 3, least(3 * s, s + x2)) AS s, c0 + x3 AS c0, c1 + x4 AS c1 FROM p{k} JOIN x{k} USING (ipt))")
    # the diagonal of the inverse: minors over the determinant
    m = [[f"n{max(i, j)}_{min(i, j)}" for j in range(5)] for i in range(5)]
    minor = lambda p: sql_det([[m[r][c] for c in range(5) if c != p] for r in range(5) if r != p])
    return ", ".join(parts) + f""" SELECT ipt, round({CENTRE} + u * {HALF}, 2) AS mean, round(s * {HALF}, 2) AS sigma, round(h, 4) AS height, round(sqrt({minor(1)} / {sql_det(m)}) * {HALF}, 2) AS mean_err,
        round(sqrt({minor(0)} / {sql_det(m)}), 4) AS height_err, round(h * s * sqrt(2 * pi()) * {HALF / PK.width}, 3) AS signal, round(chi2, 4) AS chi2, np - 5 AS ndf
        FROM p{FIT_ROUNDS} JOIN a{FIT_ROUNDS} USING (ipt)"""


@query("H01_peak_fit", peak_fit_sql())
def h01_fit(spark, sf):
    cube = mass_cube(spark, sf)
    fit = fits.peak_fit(mass(cube, "R"), ["ipt"], PK, labelled_peaks(cube), "line", FIT_ROUNDS)
    return fit.select("ipt", rounded("mean", 2).alias("mean"), rounded("sigma", 2).alias("sigma"), rounded("height", 4).alias("height"), rounded("mean_err", 2).alias("mean_err"),
                      rounded("height_err", 4).alias("height_err"), rounded("signal", 3).alias("signal"), rounded("chi2", 4).alias("chi2"), "ndf")


@query(
    "H02_polynomial_background",
    f"WITH dh AS {mass_sql('N')} SELECT ipt, round(c0, 5) AS c0, round(c1, 5) AS c1, round(c2, 5) AS c2, n_points FROM "
    + fit_sql("dh", "ipt", 2, "(x < 40000 OR x > 60000)"),
)
def h02(spark, sf):
    fit = peaks.sideband_fit(mass(mass_cube(spark, sf), "N"), ["ipt"], PK, 2, F.lit(40000.0), F.lit(60000.0))
    return fit.select("ipt", *[rounded(f"c{i}", 5).alias(f"c{i}") for i in range(3)], "n_points")


EXP_FIT = fit_sql("dh", "ipt", 1, "(x < 40000 OR x > 60000) AND content > 0", y="ln(content)", w="content")


@query(
    "H03_exponential_background",
    f"""WITH dh AS {mass_sql('N')} SELECT ipt, round(c0, 5) AS c0, round(c1, 5) AS c1,
        round({HALF} * exp(c0) * (exp(c1 * ((60000 - {CENTRE}) / {HALF})) - exp(c1 * ((40000 - {CENTRE}) / {HALF}))) / c1 / {PK.width}, 4) AS under FROM {EXP_FIT}""",
)
def h03(spark, sf):
    fit = peaks.exponential_fit(mass(mass_cube(spark, sf), "N"), ["ipt"], PK, F.lit(40000.0), F.lit(60000.0))
    under = peaks.exponential_integral(F.lit(40000.0), F.lit(60000.0), PK) / PK.width
    return fit.select("ipt", rounded("c0", 5).alias("c0"), rounded("c1", 5).alias("c1"), rounded(under, 4).alias("under"))


def line_integral_sql(lo: str, hi: str) -> str:
    a, b = f"(({lo} - {CENTRE}) / {HALF})", f"(({hi} - {CENTRE}) / {HALF})"
    return f"({HALF} * (c0 * ({b} - {a}) + c1 * ({b} * {b} - {a} * {a}) / 2))"


BKG_CTE = f""", lin AS {LIN}, side AS (SELECT ipt, sum(content) AS n_side FROM dh JOIN pk USING (ipt) WHERE {OUT} GROUP BY 1),
   bkg AS (SELECT ipt, {line_integral_sql('(mean - 1.5 * sigma)', '(mean + 1.5 * sigma)')} / {PK.width} AS bkg, n_side FROM lin JOIN pk USING (ipt) JOIN side USING (ipt)),
   sig AS (SELECT ipt, sum(content - (c0 + c1 * ((x - {CENTRE}) / {HALF}))) AS signal, sqrt(sum(sumw2)) AS signal_err FROM dh JOIN pk USING (ipt) JOIN lin USING (ipt)
           WHERE abs(x - mean) <= 1.5 * sigma GROUP BY 1)"""


def background(spark, sf):
    cube = mass_cube(spark, sf)
    data, pk = mass(cube, "N"), labelled_peaks(cube)
    m, s, x = F.col("mean"), F.col("sigma"), PK.centre("ix")
    side = data.join(pk, "ipt").where((x < m - 1.5 * s) | (x > m + 1.5 * s)).groupBy("ipt").agg(F.sum("content").alias("n_side"))
    return peaks.background_under_peak(linear_background(data, pk), pk, side, ["ipt"], PK, 1.5, ["c0", "c1"])


def signal(spark, sf):
    cube = mass_cube(spark, sf)
    data, pk = mass(cube, "N"), labelled_peaks(cube)
    return peaks.counted_yield(data, linear_background(data, pk), pk, ["ipt"], PK, 1.5, ["c0", "c1"])


@query("H04_background_under_peak", peak_ctes() + BKG_CTE + " SELECT ipt, round(bkg, 4) AS bkg, round(abs(bkg) / sqrt(n_side), 4) AS bkg_err FROM bkg")
def h04(spark, sf):
    return background(spark, sf).select("ipt", rounded("bkg", 4).alias("bkg"), rounded("bkg_err", 4).alias("bkg_err"))


@query("H05_counted_yield", peak_ctes() + BKG_CTE + " SELECT ipt, round(signal, 4) AS signal, round(signal_err, 4) AS signal_err FROM sig")
def h05(spark, sf):
    return signal(spark, sf).select("ipt", rounded("signal", 4).alias("signal"), rounded("signal_err", 4).alias("signal_err"))


@query(
    "H06_significance",
    """WITH s AS (SELECT l_linenumber, count(*) FILTER (l_returnflag = 'R') - count(*) FILTER (l_linenumber = 1) AS s, count(*) FILTER (l_returnflag = 'N') AS b FROM lineitem GROUP BY 1)
       SELECT l_linenumber, round(CASE WHEN s > 0 THEN s / b ELSE 0 END, 6) AS s_over_b, round(CASE WHEN s > 0 THEN s / sqrt(s + b) ELSE 0 END, 6) AS signif,
              round(CASE WHEN s > 0 THEN s / sqrt(s + b) * sqrt((s + b) / (4.0 * (s + b) * (s + b)) + b / (s + b) * s / (s * s)) ELSE 0 END, 6) AS signif_err FROM s""",
)
def h06(spark, sf):
    c = items(spark, sf).groupBy("l_linenumber").agg(
        (F.count_if(F.col("l_returnflag") == "R") - F.count_if(F.col("l_linenumber") == 1)).cast("double").alias("s"),
        F.count_if(F.col("l_returnflag") == "N").cast("double").alias("b"))
    v = peaks.significance("s", "b", F.sqrt(F.greatest("s", F.lit(0.0))), F.sqrt("b"))
    return c.select("l_linenumber", *[rounded(e).alias(n) for n, e in v.items()])


TRIALS = [
    {"rebin": r, "lo": lo, "hi": hi, "order": o, "window": w, "width": k}
    for r in (1, 2) for lo in (900.0, 9000.0) for hi in (84000.0, 100000.0) for o in (1, 2) for w, k in ((1.5, 1.0), (2.0, 0.8))
]


def _trial_ctes() -> str:
    rows = ", ".join(f"({i}, {t['rebin']}, {t['lo']}, {t['hi']}, {t['order']}, {t['window']}, {t['width']})" for i, t in enumerate(TRIALS))
    used = "abs(x - mean) > 1.5 * sigma * width AND x BETWEEN lo AND hi"
    fits = [fit_sql("tb", "ipt, trial", o, used, y="content / rebin", w="rebin * rebin / sumw2") for o in (1, 2)]
    return f"""{peak_ctes()}, tr AS (SELECT trial, rebin, lo::DOUBLE AS lo, hi::DOUBLE AS hi, ord, win::DOUBLE AS win, width::DOUBLE AS width FROM (VALUES {rows}) v(trial, rebin, lo, hi, ord, win, width)),
      tb AS (SELECT *, 900.0 + (ix - 0.5) * rebin * {PK.width} AS x FROM (SELECT dh.ipt, trial, rebin, lo, hi, ord, win, width, floor((ix - 1) / rebin) + 1 AS ix, sum(content) AS content, sum(sumw2) AS sumw2
              FROM dh, tr GROUP BY ALL) JOIN pk USING (ipt)),
      f AS (SELECT l.ipt, l.trial, CASE WHEN ord = 1 THEN l.c0 ELSE q.c0 END AS c0, CASE WHEN ord = 1 THEN l.c1 ELSE q.c1 END AS c1, CASE WHEN ord = 1 THEN 0 ELSE q.c2 END AS c2,
                   l.n_points - ord - 1 AS ndf FROM {fits[0]} l JOIN {fits[1]} q USING (ipt, trial) JOIN tr USING (trial)),
      m AS (SELECT *, (c0 + c1 * ((x - {CENTRE}) / {HALF}) + c2 * pow((x - {CENTRE}) / {HALF}, 2)) AS mod, abs(x - mean) <= win * sigma * width AS near, {used} AS used FROM tb JOIN f USING (ipt, trial)),
      res AS (SELECT ipt, trial, sum(content - mod * rebin) FILTER (near) AS signal, sqrt(sum(sumw2) FILTER (near)) AS signal_err, sum(mod * rebin) FILTER (near) AS bkg,
                sum(pow(content / rebin - mod, 2) / (sumw2 / (rebin * rebin))) FILTER (used) / any_value(ndf) AS chi2 FROM m GROUP BY ALL),
      sc AS (SELECT *, CASE WHEN signal > 0 AND signal + bkg > 0 THEN signal / sqrt(signal + bkg) ELSE 0 END AS signif FROM res)"""


def trials(spark, sf):
    cube = mass_cube(spark, sf)
    return peaks.multi_trial(mass(cube, "N"), labelled_peaks(cube), ["ipt"], PK, TRIALS, 3.0, 0.2, reject_sigma=1.5)


@query(
    "H07_multi_trial",
    _trial_ctes() + """ SELECT ipt, CAST(trial AS INTEGER) AS trial, round(signal, 3) AS signal, round(signal_err, 4) AS signal_err, round(chi2, 4) AS chi2, round(signif, 4) AS signif,
       chi2 <= 3 AND signif >= 0.2 AS accepted FROM sc""",
)
def h07(spark, sf):
    out = trials(spark, sf)
    return out.select("ipt", "trial", rounded("signal", 3).alias("signal"), *[rounded(c, 4).alias(c) for c in ("signal_err", "chi2", "signif")], "accepted")


@query(
    "H07_trial_spread",
    _trial_ctes() + """ SELECT ipt, round(avg(signal), 3) AS mean, round(stddev_pop(signal), 3) AS rms FROM sc WHERE chi2 <= 3 AND signif >= 0.2 GROUP BY ipt""",
)
def h07_spread(spark, sf):
    t = trials(spark, sf).where("accepted")
    out = scans.trial_spread(t, ["ipt"], "signal", F.col("trial") == 0)
    return out.select("ipt", rounded("mean", 3).alias("mean"), rounded("rms", 3).alias("rms"))


ERROR_TRIALS = [
    {"rebin": r, "lo": 900.0, "hi": 90000.0, "order": 0 if b == "exponential" else b, "background": b, "window": 1.5, "width": 1.0} for r in (1, 2) for b in (1, 2, "exponential")
]


def _error_sql() -> str:
    """The trials one by one: fit by determinants, error of the background by the inverse of the power sums."""
    trials = []
    for i, t in enumerate(ERROR_TRIALS):
        n, bent, r = 3 if t["order"] == 2 else 2, t["background"] == "exponential", t["rebin"]
        y, v, tt = f"(content / {r})", f"(sumw2 / {r * r})", f"((x - {CENTRE}) / {HALF})"
        w = f"{y} * {y} / {v}" if bent else f"1.0 / {v}"
        used = f"abs(x - mean) > 1.5 * sigma AND x BETWEEN {t['lo']} AND {t['hi']} AND sumw2 > 0" + (" AND content > 0" if bent else "")
        near = f"abs(x - mean) <= {t['window']} * sigma"
        value = f"ln(CASE WHEN content > 0 THEN {y} END)" if bent else y
        sums = ", ".join(f"sum({w} * pow({tt}, {k})) FILTER ({used}) AS s{k}" for k in range(2 * n - 1)) + ", " + ", ".join(f"sum({w} * {value} * pow({tt}, {k})) FILTER ({used}) AS g{k}" for k in range(n))
        m = [[f"s{a + b}" for b in range(n)] for a in range(n)]
        solve = lambda right, m=m, n=n: [f"{sql_det([[right[q] if c == p else m[q][c] for c in range(n)] for q in range(n)])} / {sql_det(m)}" for p in range(n)]
        coeff = ", ".join(f"{e} AS c{k}" for k, e in enumerate(solve([f"g{k}" for k in range(n)])))
        poly = " + ".join(f"c{k} * pow({tt}, {k})" for k in range(n))
        model = f"exp({poly})" if bent else f"({poly})"
        inner = ", ".join(f"sum({r} * pow({tt}, {k})" + (f" * {model}" if bent else "") + f") FILTER ({near}) AS i{k}" for k in range(n))
        back = " + ".join(f"i{k} * ({e})" for k, e in enumerate(solve([f"i{k}" for k in range(n)])))
        s_cols = ", ".join(f"any_value(s{k}) AS s{k}" for k in range(2 * n - 1))
        trials.append(f"""SELECT ipt, {i} AS trial, signal, signal_err, bkg, sqrt({back}) AS bkg_err FROM (
          SELECT ipt, sum(content - {r} * {model}) FILTER ({near}) AS signal, sqrt(sum(sumw2) FILTER ({near})) AS signal_err, sum({r} * {model}) FILTER ({near}) AS bkg, {inner}, {s_cols}
          FROM e{r} JOIN (SELECT *, {coeff} FROM (SELECT ipt, {sums} FROM e{r} GROUP BY ipt)) USING (ipt) GROUP BY ipt)""")
    bins = [f"""e{r} AS (SELECT ipt, mean, sigma, 900.0 + (ix - 0.5) * {r} * {PK.width} AS x, content, sumw2 FROM (
        SELECT ipt, floor((ix - 1) / {r}) + 1 AS ix, sum(content) AS content, sum(sumw2) AS sumw2 FROM dh GROUP BY ALL) JOIN pk USING (ipt))""" for r in (1, 2)]
    return peak_ctes() + ", " + ", ".join(bins) + ", res AS (" + " UNION ALL ".join(trials) + """) SELECT ipt, trial::INTEGER AS trial, round(signal, 3) AS signal, round(bkg, 3) AS bkg, round(bkg_err, 3) AS bkg_err,
        round(CASE WHEN signal > 0 AND signal + bkg > 0 THEN signal / sqrt(signal + bkg) * sqrt((signal_err * signal_err + bkg_err * bkg_err) / (4 * (signal + bkg) * (signal + bkg))
          + bkg / (signal + bkg) * signal_err * signal_err / (signal * signal)) ELSE 0 END, 4) AS signif_err FROM res"""


@query("H07_trial_errors", _error_sql())
def h07_errors(spark, sf):
    cube = mass_cube(spark, sf)
    out = peaks.multi_trial(mass(cube, "N"), labelled_peaks(cube), ["ipt"], PK, ERROR_TRIALS, 3.0, 0.2, reject_sigma=1.5)
    return out.select("ipt", "trial", *[rounded(c, 3).alias(c) for c in ("signal", "bkg", "bkg_err")], rounded("signif_err", 4).alias("signif_err"))


@query(
    "H08_seed_chain",
    f"""WITH n AS (SELECT {IPT_SQL} AS ipt, avg(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sigma FROM lineitem GROUP BY 1),
             s AS (SELECT {IPT_SQL} AS ipt, avg(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sigma FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 12 GROUP BY 1),
             d AS (SELECT {IPT_SQL} AS ipt, avg(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sigma FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 6 GROUP BY 1)
        SELECT n.ipt, round(coalesce(s.mean, d.mean, n.mean), 4) AS mean, round(n.sigma, 4) AS sigma FROM n LEFT JOIN s USING (ipt) LEFT JOIN d USING (ipt)""",
)
def h08(spark, sf):
    df = with_ipt(items(spark, sf))
    stages = [F.expr("l_returnflag = 'R' and l_quantity > 12"), F.expr("l_returnflag = 'N' and l_quantity > 6")]
    out = peaks.moment_seeds(df, ["ipt"], "l_extendedprice", stages, locked=["sigma"])
    return out.select("ipt", rounded("mean", 4).alias("mean"), rounded("sigma", 4).alias("sigma"))
