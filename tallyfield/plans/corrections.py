"""Sidebands, feed-down, corrected yields and ratios on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import Uniform
from ..operators import algebra, budgets, corrections, hist, joins, peaks
from ..session import stored
from .matching import MULT, orders
from .peaks import LIN, PK, fit_sql, labelled_peaks, line_integral_sql, linear_background, mass, mass_cube, peak_ctes
from .ratios import (DATA_SQL, G_KEYS, IN_G, KIN_G_SQL, KIN_R_SQL, P_SQL, R_KEYS, gen_level, kinematic, measured, out,
                     pair_cube, response)
from .registry import PT, SHAPE, query, rounded, sql_bin, table
from .selections import prob, PROB_SQL, items
from .spectra import IPT_SQL, N, PAIRS_SQL, with_ipt

REGIONS = corrections.Regions(1.0, 1.5, 3.0, 1.5, 3.0, signal_share=0.68)


def mass_shape(cube):
    return hist.project(cube, ["ipt", "ix", "iy"], F.col("l_returnflag") == "N")


def ipt_efficiency(cube, flag="A"):
    """Preselected over generated per pt bin."""
    sample = cube.where(F.col("l_returnflag") == flag)
    return algebra.divide_binomial(hist.project(sample, ["ipt"], F.col("l_linestatus") == "F"), hist.project(sample, ["ipt"]), ["ipt"])


def eff_sql(flag: str) -> str:
    return f"(SELECT {IPT_SQL} AS ipt, count(*) FILTER (l_linestatus = 'F') / count(*) AS eff FROM lineitem WHERE l_returnflag = '{flag}' GROUP BY 1)"


def _win(lo: str, hi: str) -> str:
    return f"ix BETWEEN {sql_bin(f'(mean {lo} * sigma)', PK)} AND {sql_bin(f'(mean {hi} * sigma)', PK)}"


SUB_CTES = peak_ctes() + f""", lin AS {LIN}, ms AS (SELECT {IPT_SQL} AS ipt, {sql_bin('l_extendedprice', PK)} AS ix, {sql_bin('l_discount', SHAPE)} AS iy, {N} AS c
      FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL),
   fits AS (SELECT * FROM lin JOIN pk USING (ipt)),
   ar AS (SELECT ipt, {line_integral_sql('(mean - 1.0 * sigma)', '(mean + 1.0 * sigma)')} / ({line_integral_sql('(mean - 3.0 * sigma)', '(mean - 1.5 * sigma)')} +
          {line_integral_sql('(mean + 1.5 * sigma)', '(mean + 3.0 * sigma)')}) AS area FROM fits),
   reg AS (SELECT ipt, iy, coalesce(sum(c) FILTER ({_win('- 1.0', '+ 1.0')}), 0) AS sig, coalesce(sum(c) FILTER ({_win('- 3.0', '- 1.5')}), 0) AS lft,
          coalesce(sum(c) FILTER ({_win('+ 1.5', '+ 3.0')}), 0) AS rgt FROM ms JOIN fits USING (ipt) GROUP BY ALL),
   sub AS (SELECT ipt, iy, CASE WHEN sig - area * (lft + rgt) <= 0 THEN 0 ELSE (sig - area * (lft + rgt)) / (eff * 0.68) END AS content,
                  CASE WHEN sig - area * (lft + rgt) <= 0 THEN 0 ELSE (sig + area * area * (lft + rgt)) / pow(eff * 0.68, 2) END AS sumw2
           FROM reg JOIN ar USING (ipt) JOIN {eff_sql('A')} e USING (ipt))"""


def fitted(cube):
    pk = labelled_peaks(cube)
    return linear_background(mass(cube, "N"), pk).join(pk, "ipt")


def subtracted(spark, sf):
    cube = mass_cube(spark, sf)
    fits = stored(fitted(cube), "fits")
    return corrections.subtract_sidebands(mass_shape(cube), fits, ipt_efficiency(cube), ["ipt"], ["ipt"], PK, ["c0", "c1"], REGIONS)


@query("G14_sideband_subtraction", SUB_CTES + " SELECT iy, round(sum(content), 4) AS content, round(sum(sumw2), 4) AS sumw2 FROM sub GROUP BY iy")
def g14(spark, sf):
    return out(hist.project(subtracted(spark, sf), ["iy"]), ["iy"], 4)


@query(
    "G15_bin_contributions",
    SUB_CTES + """, t AS (SELECT *, sum(content) OVER (PARTITION BY iy) AS s, sum(sumw2) OVER (PARTITION BY iy) AS v FROM sub)
      SELECT ipt, iy, round(100 * content / s, 4) AS signal_share, round(100 * sumw2 / v, 4) AS variance_share,
        CASE WHEN content / s < 1 - 1e-7 AND sumw2 / v < 1 - 1e-7 THEN CASE WHEN content / s + (sumw2 / v) / (content / s) < 2 THEN 1 ELSE 2 END END AS improves,
        CASE WHEN content / s < 1 - 1e-7 AND sumw2 / v < 1 - 1e-7 THEN round(100 * (sqrt(v) / s / (sqrt(v - sumw2) / (s - content)) - 1), 4) END AS gain_incl,
        CASE WHEN content / s < 1 - 1e-7 AND sumw2 / v < 1 - 1e-7 THEN round(100 * (sqrt(v - sumw2) / (s - content) / (sqrt(v) / s) - 1), 4) END AS gain_excl
      FROM t WHERE content > 0 AND s > 0 AND v > 0""",
)
def g15(spark, sf):
    c = corrections.bin_contributions(subtracted(spark, sf), ["iy"])
    return c.select("ipt", "iy", *[rounded(x, 4).alias(x) for x in ("signal_share", "variance_share")], "improves", *[rounded(x, 4).alias(x) for x in ("gain_incl", "gain_excl")])


@query(
    "G16_sideband_ratio",
    SUB_CTES + """ SELECT ipt, iy, round(CASE WHEN lft = 0 THEN 0 ELSE (rgt / nullif(sum(rgt) OVER w, 0)) / (lft / nullif(sum(lft) OVER w, 0)) END, 6) AS content FROM reg WINDOW w AS (PARTITION BY ipt)""",
)
def g16(spark, sf):
    cube = mass_cube(spark, sf)
    areas = corrections.sideband_regions(mass_shape(cube), fitted(cube), ["ipt"], PK, REGIONS)
    return corrections.sideband_ratio(areas, ["ipt"]).select("ipt", "iy", rounded("content").alias("content"))


FD_CTES = f"""WITH sim AS (SELECT {IPT_SQL} AS ipt, ix_g, iy_g, {N} AS c FROM {PAIRS_SQL} WHERE {IN_G} AND l_returnflag = 'R' GROUP BY ALL),
   s1 AS (SELECT ix_g, iy_g, sum(c * CASE WHEN f.eff = 0 OR p.eff = 0 THEN 0 ELSE f.eff / p.eff END) AS c FROM sim JOIN {eff_sql('R')} f USING (ipt) JOIN {eff_sql('A')} p USING (ipt) GROUP BY ALL),
   fd0 AS (SELECT ix_r, iy_r, sum(s1.c * k.e * 0.4 * p) AS c FROM s1 JOIN {KIN_G_SQL} k USING (ix_g, iy_g) JOIN {P_SQL} USING (ix_g, iy_g) GROUP BY ALL),
   fd AS (SELECT ix_r, iy_r, c / e AS c FROM fd0 JOIN {KIN_R_SQL} USING (ix_r, iy_r)), dat AS {DATA_SQL}"""


def feeddown(cube):
    sim = gen_level(cube.where(F.col("l_returnflag") == "R"), ["ipt"])
    return corrections.feeddown_yield(
        sim, ipt_efficiency(cube, "R"), ipt_efficiency(cube, "A"), ["ipt"], G_KEYS, kinematic(cube, "gen"), response(cube),
        R_KEYS, kinematic(cube, "reco"), 0.4)


@query("G17_feeddown_subtraction", FD_CTES + " SELECT ix_r, iy_r, round(greatest(d.c - fd.c, 0), 4) AS content FROM dat d JOIN fd USING (ix_r, iy_r)")
def g17(spark, sf):
    cube = pair_cube(spark, sf)
    h = corrections.subtract_feeddown(measured(cube), feeddown(cube), R_KEYS)
    return h.select(*R_KEYS, rounded("content", 4).alias("content"))


@query(
    "G18_feeddown_fraction",
    FD_CTES + """ SELECT ix_r, iy_r, round(fd.c / d.c, 6) AS content, round(greatest(fd.c * 1.2 / d.c - fd.c / d.c, fd.c * 0.7 / d.c - fd.c / d.c, 0), 6) AS err_up,
        round(greatest(fd.c / d.c - fd.c * 1.2 / d.c, fd.c / d.c - fd.c * 0.7 / d.c, 0), 6) AS err_down FROM dat d JOIN fd USING (ix_r, iy_r)""",
)
def g18(spark, sf):
    cube = pair_cube(spark, sf)
    central = stored(corrections.feeddown_fraction(feeddown(cube), measured(cube), R_KEYS), "fraction")
    factors = F.explode(F.array(F.lit(1.2), F.lit(0.7)))
    variations = algebra.scale(central.withColumn("k", factors), "k")
    e = budgets.envelope(variations, central, R_KEYS)
    return e.select(*R_KEYS, *[rounded(c).alias(c) for c in ("content", "err_up", "err_down")])


@query(
    "G19_shape_and_cross_section",
    f"""WITH h AS (SELECT l_returnflag, {sql_bin('l_discount', SHAPE)} AS ix, count(*) AS c FROM lineitem GROUP BY ALL),
          w AS (SELECT *, list_extract({SHAPE.edges}, ix + 1)::DOUBLE - list_extract({SHAPE.edges}, ix)::DOUBLE AS width, sum(c) OVER (PARTITION BY l_returnflag) AS t FROM h)
        SELECT l_returnflag, ix, round(c / t / width, 6) AS shape, round(sqrt(c) / t / width, 6) AS shape_err, round(c * 57.8 / ((SELECT count(*) FROM orders) * 0.04 * width), 4) AS xsec,
               round(sqrt(c) * 57.8 / ((SELECT count(*) FROM orders) * 0.04 * width), 4) AS xsec_err FROM w""",
)
def g19(spark, sf):
    n = table(spark, sf, "orders").agg(F.count("*").alias("n")).scalar()
    h = hist.fill(items(spark, sf), [("l_discount", SHAPE)], ["l_returnflag"], flow=False)
    x = corrections.shape_and_cross_section(h, ["l_returnflag"], SHAPE, 57.8, n, 0.04)
    return x.select("l_returnflag", "ix", *[rounded(c).alias(c) for c in ("shape", "shape_err")], *[rounded(c, 4).alias(c) for c in ("xsec", "xsec_err")])


BINS_SQL = f"""(SELECT *, list_extract({PT.edges}, ix + 1)::DOUBLE - list_extract({PT.edges}, ix)::DOUBLE AS width, r / 1000.0::DOUBLE AS mc_fd, rf / r AS eff_fd, af / a AS eff,
     sqrt(af / a * (1 - af / a) / a) AS eff_err, a / (a + r) AS f_prompt, n * 0.05::DOUBLE AS yield_syst FROM (SELECT {sql_bin('l_quantity', PT)} AS ix, {N} AS tot, count(*) FILTER (l_returnflag = 'N')::DOUBLE AS n,
     count(*) FILTER (l_returnflag = 'A')::DOUBLE AS a, count(*) FILTER (l_returnflag = 'R')::DOUBLE AS r, count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F')::DOUBLE AS af,
     count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F')::DOUBLE AS rf FROM lineitem GROUP BY 1))"""


def yield_bins(spark, sf):
    flag, pre = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    c = items(spark, sf).groupBy(PT.index("l_quantity").alias("ix")).agg(*[
        F.count_if(p).cast("double").alias(n)
        for n, p in {"n": flag == "N", "a": flag == "A", "r": flag == "R", "af": (flag == "A") & pre, "rf": (flag == "R") & pre}.items()])
    eff, err = algebra.efficiency("af", "a")
    return c.select(
        "ix", F.col("n").alias("yield"), F.sqrt("n").alias("yield_err"), (F.col("n") * 0.05).alias("yield_syst"),
        F.try_divide(F.col("a"), F.col("a") + F.col("r")).alias("f_prompt"), eff.alias("eff"), err.alias("eff_err"),
        (F.col("r") / 1000.0).alias("mc_fd"), F.try_divide(F.col("rf"), F.col("r")).alias("eff_fd"))


@query(
    "G28_corrected_cross_section",
    f"""SELECT ix, round(n * f_prompt / width, 4) AS corr_yield, round(sqrt(n) / width, 4) AS corr_yield_err, round(n * f_prompt / width / (1.0 * 0.04 * 2 * 300 * eff), 6) AS sigma,
          round(n * f_prompt / width / (1.0 * 0.04 * 2 * 300 * eff) * (sqrt(n) / (n * f_prompt)), 6) AS sigma_err,
          round(n * f_prompt / width / (1.0 * 0.04 * 2 * 300 * eff) * sqrt(pow(yield_syst / (n * f_prompt), 2) + pow(6.0 / 300, 2) + pow(eff_err / eff, 2) + 0.0009), 6) AS sigma_syst FROM {BINS_SQL}""",
)
def g28(spark, sf):
    x = corrections.corrected_cross_section(yield_bins(spark, sf), PT.widths("ix"), 1.0, 0.04, (300.0, 6.0), (1.0, 0.0), 0.03)
    return x.select("ix", *[rounded(c, 4).alias(c) for c in ("corr_yield", "corr_yield_err")], *[rounded(c).alias(c) for c in ("sigma", "sigma_err", "sigma_syst")])


@query("G29_expected_feeddown", f"SELECT ix, round(greatest((n - 300 * 1.0 * 0.04 * 0.95 * eff_fd * (mc_fd * 40)) / width, 0), 4) AS content FROM {BINS_SQL}")
def g29(spark, sf):
    c = corrections.subtract_expected_feeddown("yield", PT.widths("ix"), 300.0, 1.0, 0.04, 0.95, "eff_fd", F.col("mc_fd") * 40)
    return yield_bins(spark, sf).select("ix", rounded(c, 4).alias("content"))


@query(
    "G30_feeddown_union",
    f"""SELECT ix, round(n * f_prompt, 4) AS value, round(n * f_prompt - least(n * 0.45 - sqrt(n), n * f_prompt - yield_syst), 4) AS err_low,
          round(greatest(n * 0.45 + yield_syst, n * f_prompt + sqrt(n)) - n * f_prompt, 4) AS err_high,
          round((n * f_prompt - least(n * 0.45 - sqrt(n), n * f_prompt - yield_syst)) / (n * f_prompt), 6) AS rel_low FROM {BINS_SQL}""",
)
def g30(spark, sf):
    y = F.col("yield")
    u = corrections.feeddown_union([y * 0.45, F.sqrt(y), "yield_syst"], [y * F.col("f_prompt"), "yield_syst", F.sqrt(y)])
    return yield_bins(spark, sf).select("ix", *[rounded(u[c], 4).alias(c) for c in ("value", "err_low", "err_high")], rounded(u["rel_low"]).alias("rel_low"))


@query(
    "G31_simple_cross_section",
    f"""SELECT ix, round(n / (af / a) / (2 * 0.04 * (SELECT count(*) FROM orders) / 57.8) / width, 6) AS content FROM {BINS_SQL}""",
)
def g31(spark, sf):
    n = table(spark, sf, "orders").agg(F.count("*").alias("n")).scalar()
    b = yield_bins(spark, sf)
    yields = b.select("ix", F.col("yield").alias("content"), F.col("yield").alias("sumw2"))
    eff = b.select("ix", F.col("eff").alias("content"), (F.col("eff_err") * F.col("eff_err")).alias("sumw2"))
    h = corrections.simple_cross_section(yields, eff, ["ix"], 0.04, n, 57.8, PT.widths("ix"))
    return h.select("ix", rounded("content").alias("content"))


@query(
    "G32_working_point_ratio",
    f"""WITH t AS (SELECT {IPT_SQL} AS ipt, printf('cut_%d', k) AS trial, CAST(count(*) FILTER ({PROB_SQL} > (k + 0.03) / 10) AS DOUBLE) AS c FROM lineitem, (SELECT unnest(range(2, 9)) AS k) GROUP BY ALL)
        SELECT t.ipt, t.trial, round(CASE WHEN n.c = 0 THEN 0 ELSE t.c / n.c END, 6) AS ratio FROM t JOIN t n ON t.ipt = n.ipt AND n.trial = 'cut_5'""",
)
def g32(spark, sf):
    trials = {f"cut_{k}": prob() > (k + 0.03) / 10 for k in range(2, 9)}
    t = joins.count_trials(with_ipt(items(spark, sf)), ["ipt"], trials)
    return corrections.ratio_to_nominal(t, ["ipt"], "trial", "cut_5").select("ipt", "trial", rounded("ratio").alias("ratio"))


def _ratio_ref_sql(member: str, ref: str, factor: str) -> str:
    return f"""WITH h AS (SELECT {member} AS member, {sql_bin('l_quantity', PT)} AS ix, count(*) * ({factor}) AS c, count(*) * pow({factor}, 2) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY {member}, 2)
      SELECT a.member, a.ix, round(a.c / b.c, 6) AS content, round((a.v * b.c * b.c + b.v * a.c * a.c) / pow(b.c, 4), 9) AS sumw2 FROM h a JOIN h b ON a.ix = b.ix AND b.member = {ref} AND a.member <> {ref}"""


@query("G33_particle_ratio", _ratio_ref_sql("l_returnflag", "'A'", "CASE l_returnflag WHEN 'A' THEN 1.5::DOUBLE WHEN 'N' THEN 0.7::DOUBLE ELSE 2.0::DOUBLE END"))
def g33(spark, sf):
    h = hist.fill(items(spark, sf).withColumnRenamed("l_returnflag", "member"), [("l_quantity", PT)], ["member"])
    f = F.when(F.col("member") == "A", 1.5).when(F.col("member") == "N", 0.7).otherwise(2.0)
    r = corrections.ratio_to_reference(h, ["ix"], "member", "A", f)
    return r.select("member", "ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


@query("G33_period_ratio", _ratio_ref_sql("CAST(year(o_orderdate) AS INTEGER)", "1998", "1.0::DOUBLE"))
def g33_period(spark, sf):
    df = joins.join_events(items(spark, sf), orders(spark, sf), ["l_orderkey"], ["period"]).withColumnRenamed("period", "member")
    r = corrections.ratio_to_reference(hist.fill(df, [("l_quantity", PT)], ["member"]), ["ix"], "member", 1998)
    return r.select("member", "ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


@query(
    "G34_matching_efficiency",
    f"""SELECT {IPT_SQL} AS ipt, round(count(*) FILTER (l_linenumber >= 2) / count(*), 6) AS matched, round(count(*) FILTER (l_linenumber >= 2) / count(*) * (1 - count(*) FILTER (l_linenumber >= 2) / count(*)) / count(*), 9) AS matched_w2,
          round(count(*) FILTER (l_linestatus = 'F') / count(*) FILTER (l_returnflag = 'A'), 6) AS pileup FROM lineitem GROUP BY 1""",
)
def g34(spark, sf):
    df = with_ipt(items(spark, sf))
    h = hist.fill(df, [("l_linenumber", Uniform(7, 0.5, 7.5))], ["ipt"])
    eff = algebra.divide_binomial(hist.project(h, ["ipt"], F.col("ix") >= 2), hist.project(h, ["ipt"]), ["ipt"])
    c = df.groupBy("ipt").agg(F.count_if(F.col("l_linestatus") == "F").alias("p"), F.count_if(F.col("l_returnflag") == "A").alias("s"))
    pileup = c.select("ipt", algebra.ratio(F.col("p"), F.col("s")).alias("pileup"))
    return eff.join(pileup, "ipt").select("ipt", rounded("content").alias("matched"), rounded("sumw2", 9).alias("matched_w2"), rounded("pileup").alias("pileup"))


FINE_MULT = Uniform(100, 0.0, 500000.0)
TRIG = "o_orderpriority IN ('1-URGENT', '2-HIGH')"


@query(
    "G35_trigger_turn_on",
    f"""WITH e AS (SELECT *, {sql_bin('o_totalprice', MULT)} AS ix, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.075) AS cand FROM orders)
        SELECT 'all' AS kind, ix, round(count(*) FILTER ({TRIG}) / count(*), 6) AS content, round((count(*) FILTER ({TRIG}) / count(*)) * (1 - count(*) FILTER ({TRIG}) / count(*)) / count(*), 9) AS sumw2 FROM e GROUP BY 2
        UNION ALL SELECT 'candidate', ix, round(count(*) FILTER ({TRIG}) / count(*), 6), round((count(*) FILTER ({TRIG}) / count(*)) * (1 - count(*) FILTER ({TRIG}) / count(*)) / count(*), 9) FROM e WHERE cand GROUP BY 2""",
)
def g35(spark, sf):
    ev = table(spark, sf, "orders")
    cand = items(spark, sf).where("l_discount > 0.075").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("cand", F.lit(True))
    seen = ev.join(cand, "o_orderkey", "left").withColumn("trig", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    fine = hist.rebin(hist.fill(seen, [("o_totalprice", FINE_MULT)], ["cand", "trig"]), FINE_MULT, MULT)
    # bins, not events, are taken twice
    kinds = fine.withColumn("kind", F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("cand"), F.lit("candidate"))))))
    h = algebra.divide_binomial(algebra.operands(kinds, ["kind", "ix"], F.col("trig"), F.lit(True)), None, ["kind", "ix"])
    return h.select("kind", "ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


def _norm_sql(status: str) -> str:
    return f"""(SELECT period, ix, c / sum(c) OVER (PARTITION BY period) AS c, c / pow(sum(c) OVER (PARTITION BY period), 2) AS v FROM
       (SELECT CAST(year(o_orderdate) AS INTEGER) AS period, {sql_bin('o_totalprice', MULT)} AS ix, count(*) AS c FROM orders WHERE o_orderstatus = '{status}' GROUP BY ALL))"""


WEIGHT_SQL = f"(SELECT d.period, d.ix, d.c / m.c AS content, (d.v * m.c * m.c + m.v * d.c * d.c) / pow(m.c, 4) AS sumw2 FROM {_norm_sql('F')} d JOIN {_norm_sql('O')} m USING (period, ix))"


def period_weights(spark, sf):
    h = hist.fill(orders(spark, sf), [("o_totalprice", MULT)], ["o_orderstatus", "period"])

    def one(s):
        return h.where(F.col("o_orderstatus") == s).drop("o_orderstatus")

    return corrections.data_over_simulation(one("F"), one("O"), ["period"]).where("content > 0")


@query("G36_data_over_simulation", f"SELECT period, ix, round(content, 6) AS content, round(sumw2, 9) AS sumw2 FROM {WEIGHT_SQL}")
def g36(spark, sf):
    return period_weights(spark, sf).select("period", "ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


_MC, _MH = 250000.0, 250000.0


@query(
    "G36_smoothed_weights",
    f"""WITH w AS (SELECT *, (ix - 0.5) * 50000 AS x FROM {WEIGHT_SQL}), f AS {fit_sql('w', 'period', 3, 'true', centre=_MC, half=_MH)}
        SELECT period, ix, round(c0 + c1 * ((x - {_MC}) / {_MH}) + c2 * pow((x - {_MC}) / {_MH}, 2) + c3 * pow((x - {_MC}) / {_MH}, 3), 5) AS content FROM w JOIN f USING (period)""",
)
def g36_smooth(spark, sf):
    w = period_weights(spark, sf).withColumn("x", MULT.centre("ix"))
    fit = peaks.polynomial_fit(w, ["period"], 3, "x", "content", F.try_divide(F.lit(1.0), F.col("sumw2")), _MC, _MH)
    smooth = peaks.curve("x", ["c0", "c1", "c2", "c3"], MULT)
    return w.join(fit, "period").select("period", "ix", rounded(smooth, 5).alias("content"))
