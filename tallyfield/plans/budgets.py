"""Systematic uncertainties on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import budgets
from ..session import stored
from .registry import PT, query, rounded, sql_bin
from .selections import items
from .spectra import N

SOURCES = list(budgets.HIGH_OVER_MINIMUM_BIAS)
SOURCE_SQL = f"list_extract({SOURCES}, CAST(l_partkey % {len(SOURCES)} AS INTEGER) + 1)"


def err_sql(where: str) -> str:
    """Error table (source, ibin, x_low, x_up, y_low, y_up, central) of one channel."""
    return f"""(SELECT {SOURCE_SQL} AS source, {sql_bin('l_quantity', PT)} AS ibin, avg(l_tax) / 2 AS x_low, avg(l_tax) / 2 AS x_up, avg(l_discount) AS y_low, avg(l_tax) AS y_up,
        avg(l_extendedprice) / 1000 AS central FROM lineitem WHERE {where} GROUP BY 1, 2)"""


SUMS = ("l_tax", "l_discount", "l_extendedprice")


def error_cube(spark, sf):
    """Sums per source, bin and both class columns, from one scan; every error table of a query is taken out of it."""
    names = F.array(*[F.lit(s) for s in SOURCES])
    df = items(spark, sf).withColumn("source", F.element_at(names, (F.col("l_partkey") % len(SOURCES)).cast("int") + 1))
    sums = [x for c in SUMS for x in (F.sum(c).cast("double").alias(c), F.count(c).alias(f"n_{c}"))]
    return stored(df.groupBy("source", PT.index("l_quantity").alias("ibin"), "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), *sums), "errors")


def mean(c):
    """Mean over the rows behind the cells."""
    return F.try_divide(F.sum(c), F.sum(f"n_{c}"))


def errors(cube, where="true"):
    half = mean("l_tax") / 2
    return cube.where(where).groupBy("source", "ibin").agg(
        half.alias("x_low"), half.alias("x_up"), mean("l_discount").alias("y_low"), mean("l_tax").alias("y_up"), (mean("l_extendedprice") / 1000).alias("central"))


def sides(df, keys=("ibin",)):
    return df.select(*keys, *[rounded(s).alias(s) for s in budgets.SIDES])


# variations: line numbers 2..7 against 1, grouped into three categories with different flags
VAR_SQL = f"""(SELECT {sql_bin('l_quantity', PT)} AS ix, l_linenumber AS v, avg(l_extendedprice) AS content FROM lineitem GROUP BY ALL)"""
CATS = {2: "cut", 3: "cut", 4: "fit", 5: "fit", 6: "track", 7: "track"}
FLAGS = {"cut": (False, False, False), "fit": (True, False, True), "track": (True, True, False)}


def variations(spark, sf):
    v = items(spark, sf).groupBy(PT.index("l_quantity").alias("ix"), F.col("l_linenumber").alias("v")).agg(F.avg("l_extendedprice").alias("content"))
    return v.where("v = 1").select("ix", "content"), v.where("v > 1")


@query(
    "G20_envelope",
    f"""SELECT c.ix, round(c.content, 4) AS content, round(max(greatest(v.content - c.content, 0)), 4) AS err_up, round(max(greatest(c.content - v.content, 0)), 4) AS err_down
        FROM {VAR_SQL} c JOIN {VAR_SQL} v ON c.ix = v.ix AND c.v = 1 AND v.v > 1 GROUP BY c.ix, c.content""",
)
def g20(spark, sf):
    central, v = variations(spark, sf)
    return budgets.envelope(v, central, ["ix"]).select("ix", *[rounded(c, 4).alias(c) for c in ("content", "err_up", "err_down")])


CAT_SQL = f"""(SELECT ix, category, CASE WHEN category = 'fit' THEN greatest(u, d) ELSE u END AS up, CASE WHEN category = 'fit' THEN greatest(u, d) WHEN category = 'track' THEN u ELSE d END AS down, cc FROM
   (SELECT ix, category, cc, CASE category WHEN 'cut' THEN coalesce(max(e) FILTER (e >= 0), 0) WHEN 'fit' THEN sqrt(coalesce(avg(e * e) FILTER (e >= 0), 0)) ELSE sqrt(avg(e * e)) END AS u,
      CASE category WHEN 'cut' THEN coalesce(max(-e) FILTER (e < 0), 0) ELSE sqrt(coalesce(avg(e * e) FILTER (e < 0), 0)) END AS d
    FROM (SELECT c.ix, CASE WHEN v.v < 4 THEN 'cut' WHEN v.v < 6 THEN 'fit' ELSE 'track' END AS category, c.content AS cc, v.content - c.content AS e FROM {VAR_SQL} c JOIN {VAR_SQL} v ON c.ix = v.ix AND c.v = 1 AND v.v > 1)
    GROUP BY ix, category, cc))"""


def categories(spark, sf):
    central, v = variations(spark, sf)
    cat = F.create_map(*[F.lit(x) for kv in CATS.items() for x in kv])
    v = v.withColumn("category", F.element_at(cat, F.col("v")))
    for i, flag in enumerate(("rms", "rms_both_sides", "symmetrise")):
        table = F.create_map(*[F.lit(x) for c, f in FLAGS.items() for x in (c, f[i])])
        v = v.withColumn(flag, F.element_at(table, F.col("category")))
    return central, *budgets.combine_categories(v, central, ["ix"])


@query("G21_combine_categories", f"SELECT ix, round(sqrt(sum(up * up)), 4) AS up, round(sqrt(sum(down * down)), 4) AS down FROM {CAT_SQL} GROUP BY ix")
def g21(spark, sf):
    _, _, total = categories(spark, sf)
    return total.select("ix", rounded("up", 4).alias("up"), rounded("down", 4).alias("down"))


@query("G22_relative_per_category", f"SELECT ix, category, round(up / cc, 6) AS up, round(down / cc, 6) AS down FROM {CAT_SQL}")
def g22(spark, sf):
    central, per, _ = categories(spark, sf)
    return budgets.relative(per, central, ["ix"]).select("ix", "category", rounded("up").alias("up"), rounded("down").alias("down"))


def _sum_sql(terms: dict[str, str]) -> str:
    return ", ".join(f"round(sqrt(sum({t})), 6) AS {s}" for s, t in terms.items())


def _quad(where: str) -> str:
    return _sum_sql({s: f"CASE WHEN {where} THEN {s} * {s} ELSE 0 END" for s in budgets.SIDES})


@query(
    "G23_total_error",
    " UNION ALL ".join(
        f"SELECT '{k}' AS kind, ibin, {_quad(w)} FROM {err_sql('true')} GROUP BY ibin"
        for k, w in {"all": "true", "spectra": "source NOT IN ('sigmav0', 'feeddown_mult')", "spectra_feeddown": "source IN ('feeddown_NB', 'feeddown_mult_spectra')",
                     "uncorrelated": "source IN ('yield', 'cut', 'pid', 'branching_ratio', 'statunceff')"}.items()),
)
def g23(spark, sf):
    e = errors(error_cube(spark, sf))
    kinds = {"all": None, "spectra": budgets.spectra_sources(), "spectra_feeddown": budgets.spectra_sources(True), "uncorrelated": budgets.uncorrelated_sources()}
    return sides(budgets.totals(e, kinds), ["kind", "ibin"])


@query(
    "G23_branching_ratio",
    f"SELECT round(CASE WHEN y_low = 0 THEN y_up ELSE y_low END, 6) AS br FROM {err_sql('true')} WHERE source = 'branching_ratio' ORDER BY ibin DESC LIMIT 1",
)
def g23_br(spark, sf):
    return budgets.branching_ratio_error(errors(error_cube(spark, sf))).select(rounded("br").alias("br"))


PAIR_SQL = f"(SELECT source, ibin, {', '.join(f'a.{c} AS a_{c}, b.{c} AS b_{c}' for c in (*budgets.SIDES, 'central'))} FROM {{a}} a JOIN {{b}} b USING (source, ibin))"
CH_A, CH_R = "l_returnflag = 'A'", "l_returnflag = 'R'"
AR_SQL = PAIR_SQL.format(a=err_sql(CH_A), b=err_sql(CH_R))


def _hm_term(s: str) -> str:
    a, b = f"a_{s}", f"b_{s}"
    return f"""CASE WHEN source IN ('yield', 'cut') THEN pow(greatest({a}, {b}), 2) WHEN source IN ('feeddown_mult', 'trigger', 'multiplicity_interval') THEN {a} * {a}
        WHEN source = 'multiplicity_weights' THEN {a} * {a} + {b} * {b} WHEN source = 'ptshape' THEN pow({a} - {b}, 2) WHEN source = 'statunceff' THEN abs({a} * {a} - {b} * {b}) ELSE 0 END"""


@query("G24_high_over_minimum_bias", f"SELECT ibin, {_sum_sql({s: _hm_term(s) for s in budgets.SIDES})} FROM {AR_SQL} GROUP BY ibin")
def g24(spark, sf):
    cube = error_cube(spark, sf)
    return sides(budgets.ratio_errors(errors(cube, CH_A), errors(cube, CH_R), budgets.HIGH_OVER_MINIMUM_BIAS, same_simulation=True))


def _pr_term(s: str) -> str:
    a, b = f"a_{s}", f"b_{s}"
    extra = ""
    if s in ("y_low", "y_up"):
        pick, = {"y_low": ("least",), "y_up": ("greatest",)}[s]
        rel = f"{pick}((yn - yn * a_y_low) / (yd - yd * b_y_low), yn / yd, (yn + yn * a_y_up) / (yd + yd * b_y_up))"
        absol = f"{pick}((yn - a_y_low) / (yd - b_y_low), yn / yd, (yn + a_y_up) / (yd + b_y_up))"
        extra = f"WHEN source = 'feeddown_mult_spectra' THEN pow((yn / yd - {rel}) / (yn / yd), 2) WHEN source = 'feeddown_NB' THEN pow((yn / yd - {absol}) / (yn / yd), 2)"
    return f"""CASE WHEN source IN ('yield', 'cut', 'ptshape', 'branching_ratio', 'statunceff') THEN {a} * {a} + {b} * {b} WHEN source IN ('pid', 'multiplicity_weights', 'track') THEN pow({a} - {b}, 2)
        WHEN source = 'multiplicity_interval' THEN {a} * {a} / 9 {extra} ELSE 0 END"""


@query(
    "G25_particle_ratio_errors",
    f"""SELECT ibin, {_sum_sql({s: _pr_term(s) for s in budgets.SIDES})} FROM {AR_SQL} JOIN (SELECT ibin, a_central AS yn, b_central AS yd FROM {AR_SQL} WHERE source = 'feeddown_NB') USING (ibin) GROUP BY ibin""",
)
def g25(spark, sf):
    cube = error_cube(spark, sf)
    return sides(budgets.ratio_errors(errors(cube, CH_A), errors(cube, CH_R), budgets.PARTICLE_RATIO))


FOUR = {"n1": "l_returnflag = 'A' AND l_linestatus = 'F'", "n2": "l_returnflag = 'A' AND l_linestatus = 'O'", "d1": "l_returnflag = 'R' AND l_linestatus = 'F'", "d2": "l_returnflag = 'R' AND l_linestatus = 'O'"}
BIN_MAP = [(1, 1, 2), (2, 3, 3), (3, 4, 5), (4, 3, 2)]  # bins 3 and 2 serve twice


def _dr_term(s: str) -> str:
    q = " + ".join(f"{t}.{s} * {t}.{s}" for t in FOUR)
    return f"CASE WHEN n1.source IN ('yield', 'cut', 'ptshape', 'statunceff') THEN {q} WHEN n1.source = 'multiplicity_interval' THEN d1.{s} * d1.{s} / 9 ELSE 0 END"


@query(
    "G26_double_ratio_errors",
    f"""SELECT CAST(m.o AS INTEGER) AS ibin, {_sum_sql({s: _dr_term(s) for s in budgets.SIDES})} FROM (VALUES (1, 1, 2), (2, 3, 3), (3, 4, 5), (4, 3, 2)) m(o, n, d)
        JOIN {err_sql(FOUR['n1'])} n1 ON n1.ibin = m.n JOIN {err_sql(FOUR['n2'])} n2 ON n2.ibin = m.n AND n2.source = n1.source
        JOIN {err_sql(FOUR['d1'])} d1 ON d1.ibin = m.d AND d1.source = n1.source JOIN {err_sql(FOUR['d2'])} d2 ON d2.ibin = m.d AND d2.source = n1.source GROUP BY 1""",
)
def g26(spark, sf):
    cube = error_cube(spark, sf)
    t = {k: errors(cube, w) for k, w in FOUR.items()}
    return sides(budgets.double_ratio_errors(t["n1"], t["n2"], t["d1"], t["d2"], bin_map=BIN_MAP))


def _channel_sql(where: str, i: int, cut: str) -> str:
    unc = f"(SELECT ibin, sqrt(sum(y_low * y_low)) AS u FROM {err_sql(where)} WHERE source IN ('yield', 'cut', 'pid', 'branching_ratio', 'statunceff') GROUP BY 1)"
    br = f"(SELECT CASE WHEN y_low = 0 THEN y_up ELSE y_low END FROM {err_sql(where)} WHERE source = 'branching_ratio' ORDER BY ibin DESC LIMIT 1)"
    return f"""(SELECT ibin, CASE WHEN {cut} THEN y END AS y{i}, e AS e{i}, u AS u{i}, {br} AS br{i}, f AS f{i}, fl AS f_low{i}, fh AS f_high{i} FROM {unc} JOIN
       (SELECT {sql_bin('l_quantity', PT)} AS ibin, {N} AS y, sqrt(count(*)) AS e, avg(l_discount) * 10 AS f, avg(l_tax) AS fl, avg(l_discount) AS fh FROM lineitem WHERE {where} GROUP BY 1) USING (ibin))"""


CHANNELS_SQL = f"""(SELECT *, (c22 - c12) / (c11 * c22 - c12 * c12) AS s1, (c11 - c12) / (c11 * c22 - c12 * c12) AS s2 FROM
   (SELECT *, u1 * u1 + pow(e1 / y1, 2) AS c11, u2 * u2 + pow(e2 / y2, 2) AS c22, 0.5 * br1 * br2 AS c12 FROM {_channel_sql(CH_A, 1, 'ibin <> 1')} JOIN {_channel_sql(CH_R, 2, 'ibin <> 5')} USING (ibin)))"""
WEIGHTS_SQL = f"(SELECT *, CASE WHEN y1 IS NOT NULL AND y2 IS NOT NULL THEN 1 / (pow(e1 / y1, 2) + 1 / s1) END AS w1, CASE WHEN y1 IS NOT NULL AND y2 IS NOT NULL THEN 1 / (pow(e2 / y2, 2) + 1 / s2) END AS w2 FROM {CHANNELS_SQL})"


def channel(cube, where, i, missing_bin):
    e = errors(cube, where)
    unc = budgets.total(e, sources=budgets.uncorrelated_sources()).select("ibin", F.col("y_low").alias(f"u{i}"))
    y = cube.where(where).groupBy("ibin").agg(
        F.sum("n").cast("double").alias("y"), F.sqrt(F.sum("n")).alias(f"e{i}"), (mean("l_discount") * 10).alias(f"f{i}"), mean("l_tax").alias(f"f_low{i}"), mean("l_discount").alias(f"f_high{i}"))
    y = y.withColumn(f"y{i}", F.when(F.col("ibin") != missing_bin, F.col("y"))).drop("y")
    return y.join(unc, "ibin").withColumn(f"br{i}", budgets.branching_ratio_error(e).scalar())


def weighted(cube):
    return budgets.channel_weights(channel(cube, CH_A, 1, 1).join(channel(cube, CH_R, 2, 5), "ibin"))


@query(
    "G27_average_channels",
    "SELECT ibin, " + ", ".join(
        f"round(CASE WHEN y1 IS NULL THEN {n}2 WHEN y2 IS NULL THEN {n}1 ELSE {e} END, {d}) AS {n}" for n, e, d in (
            ("y", "(w1 * y1 + w2 * y2) / (w1 + w2)", 4), ("e", "sqrt(pow(w1 * e1, 2) + pow(w2 * e2, 2)) / (w1 + w2)", 4), ("f", "(w1 * f1 + w2 * f2) / (w1 + w2)", 6),
            ("f_low", "(w1 * f_low1 / f1 + w2 * f_low2 / f2) / (w1 + w2) * (w1 * f1 + w2 * f2) / (w1 + w2)", 6),
            ("f_high", "(w1 * f_high1 / f1 + w2 * f_high2 / f2) / (w1 + w2) * (w1 * f1 + w2 * f2) / (w1 + w2)", 6))) + f" FROM {WEIGHTS_SQL}",
)
def g27(spark, sf):
    a = budgets.average_channels(weighted(error_cube(spark, sf)))
    return a.select("ibin", rounded("y", 4).alias("y"), rounded("e", 4).alias("e"), *[rounded(c).alias(c) for c in ("f", "f_low", "f_high")])


def _avg_term(s: str) -> str:
    a, b = f"a_{s} * w1", f"b_{s} * w2"
    return f"""round(CASE WHEN y1 IS NULL THEN b_{s} WHEN y2 IS NULL THEN a_{s} WHEN source IN ('yield', 'cut', 'pid', 'statunceff') THEN sqrt(pow({a}, 2) + pow({b}, 2)) / (w1 + w2)
        WHEN source = 'branching_ratio' THEN sqrt(pow({a}, 2) + pow({b}, 2) + {a} * {b}) / (w1 + w2) ELSE ({a} + {b}) / (w1 + w2) END, 6) AS {s}"""


@query("G27_average_errors", f"SELECT source, ibin, {', '.join(_avg_term(s) for s in budgets.SIDES)} FROM {AR_SQL} JOIN {WEIGHTS_SQL} USING (ibin)")
def g27_errors(spark, sf):
    cube = error_cube(spark, sf)
    return sides(budgets.average_errors(errors(cube, CH_A), errors(cube, CH_R), weighted(cube)), ["source", "ibin"])
