"""Aggregations and histograms on the driver tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..functions import bits
from ..functions.bins import Edges, Uniform, by_width, first_bin
from ..functions.predicates import gt, select_rows
from ..operators import hist, joins, scans
from .matching import BINS2_SQL, MULT, orders
from .registry import (MASS, MULT_HIGH, MULT_LOW, PT, PT_HIGH, PT_LOW, SHAPE, query, rounded, sql_bin, sql_first_bin,
                       table)
from .selections import holey, KEY, KEY_SQL, prob, PROB_SQL, items

IPT_SQL = f"CAST({sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS INTEGER)"
N = "CAST(count(*) AS DOUBLE)"


def with_ipt(df):
    return df.withColumn("ipt", first_bin("l_quantity", PT_LOW, PT_HIGH)).where("ipt is not null")


def count_sql(by: str, source: str, where: str = "true") -> str:
    return f"SELECT {by}, {N} AS content FROM {source} WHERE {where} GROUP BY ALL"


@query("E01_count_with_error", f"SELECT {IPT_SQL} AS ipt, count(*) AS n, round(sqrt(count(*)), 6) AS err FROM lineitem GROUP BY 1")
def e01(spark, sf):
    return with_ipt(items(spark, sf)).groupBy("ipt").agg(F.count("*").alias("n"), rounded(F.sqrt(F.count("*"))).alias("err"))


@query(
    "E02_efficiency_counters",
    f"""SELECT ipt, CAST(ibin2 AS INTEGER) AS ibin2, count(*) FILTER (l_returnflag = 'A') AS gen_pr,
          round(sqrt(count(*) FILTER (l_returnflag = 'A')), 6) AS gen_pr_err,
          count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS presel_pr,
          count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F' AND {PROB_SQL} > 0.404) AS sel_pr,
          count(*) FILTER (l_returnflag = 'R') AS gen_fd,
          count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS presel_fd,
          count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F' AND {PROB_SQL} > 0.404) AS sel_fd
        FROM (SELECT *, {IPT_SQL} AS ipt FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
        JOIN {BINS2_SQL} ON o_totalprice BETWEEN lo AND hi GROUP BY 1, 2""",
)
def e02(spark, sf):
    df = joins.join_events(with_ipt(items(spark, sf)), orders(spark, sf), ["l_orderkey"], ["o_totalprice"])
    counters = {}
    for name, flag in (("pr", "A"), ("fd", "R")):
        gen = F.col("l_returnflag") == flag
        presel = gen & (F.col("l_linestatus") == "F")
        counters |= {f"gen_{name}": gen, f"presel_{name}": presel, f"sel_{name}": presel & (prob() > 0.404)}
    out = hist.counts_by_class(df, ["ipt"], counters, ("o_totalprice", MULT_LOW, MULT_HIGH))
    return out.select("ipt", "ibin2", "gen_pr", rounded("gen_pr_err").alias("gen_pr_err"), "presel_pr", "sel_pr",
                      "gen_fd", "presel_fd", "sel_fd")


TOF_SQL = "CASE WHEN l_linenumber % 3 = 0 THEN -999.0 WHEN l_linenumber % 7 = 0 THEN -998.0 ELSE l_tax END"
REWEIGHTED = [False, True, False, True, True]


def efficiency_counters(kind, flag, presel, sel, detector):
    """Ten counters as column expressions or SQL conditions: with and without the detector's response on prompt only."""
    out = {}
    for name, f in (("pr", "A"), ("fd", "R")):
        gen = kind(flag, f)
        out |= {f"gen_{name}": [gen], f"presel_{name}": [gen, presel], f"sel_{name}": [gen, presel, sel]}
        if name == "pr":
            for stage in ("presel", "sel"):
                out |= {f"{stage}_{name}_wotof": [*out[f"{stage}_{name}"], detector[0]], f"{stage}_{name}_wtof": [*out[f"{stage}_{name}"], detector[1]]}
    return out


COUNTERS_SQL = {n: " AND ".join(c) for n, c in efficiency_counters(
    lambda c, f: f"{c} = '{f}'", "l_returnflag", "l_linestatus = 'F'", f"{PROB_SQL} > 0.404", (f"{TOF_SQL} < -998", f"{TOF_SQL} > -998")).items()}


@query(
    "E02_reweighted_counters",
    f"""WITH w AS (SELECT {sql_bin('o_totalprice', MULT)} AS ix, count(*) FILTER (o_orderstatus = 'F') / 1000.0::DOUBLE AS wt FROM orders WHERE o_totalprice > 50000 GROUP BY 1)
        SELECT ipt, CAST(ibin2 AS INTEGER) AS ibin2, {', '.join(
            f"round(coalesce(sum(f) FILTER ({c}), 0), 4) AS {n}, round(sqrt(coalesce(sum(f * f) FILTER ({c}), 0)), 4) AS {n}_err" for n, c in COUNTERS_SQL.items())}
        FROM (SELECT l.*, ipt, ibin2, CASE WHEN ibin2 IN ({', '.join(str(i) for i, r in enumerate(REWEIGHTED) if r)}) THEN coalesce(wt, 0) ELSE 1.0::DOUBLE END AS f
          FROM (SELECT *, {IPT_SQL} AS ipt FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey
          JOIN {BINS2_SQL} ON o_totalprice BETWEEN lo AND hi LEFT JOIN w ON {sql_bin('o_totalprice', MULT)} = ix) GROUP BY 1, 2""",
)
def e02_reweighted(spark, sf):
    o = orders(spark, sf).withColumn("ix", MULT.index("o_totalprice"))
    weights = o.where("o_totalprice > 50000").groupBy("ix").agg((F.count_if(F.col("o_orderstatus") == "F") / 1000.0).alias("content"))
    events = joins.lookup_content(o, weights, ["ix"], "w", 0.0)
    df = joins.join_events(with_ipt(items(spark, sf)), events, ["l_orderkey"], ["o_totalprice", "w"]).withColumn("tof", F.expr(TOF_SQL))
    parts = efficiency_counters(lambda c, f: F.col(c) == f, "l_returnflag", F.col("l_linestatus") == "F", prob() > 0.404,
                                (F.col("tof") < -998, gt("tof", -998.0)))
    counters = {n: reduce(and_, conditions) for n, conditions in parts.items()}
    out = hist.reweighted_counts_by_class(df, ["ipt"], counters, "w", ("o_totalprice", MULT_LOW, MULT_HIGH), REWEIGHTED)
    return out.select("ipt", "ibin2", *[rounded(x, 4).alias(x) for n in counters for x in (n, f"{n}_err")])


@query(
    "E03_reweighted_count",
    f"""WITH w AS (SELECT {sql_bin('o_totalprice', MULT)} AS ix, count(*) FILTER (o_orderstatus = 'F') / 1000.0::DOUBLE AS wt FROM orders
                   WHERE o_totalprice > 50000 GROUP BY 1)
        SELECT {IPT_SQL} AS ipt, round(sum(coalesce(wt, 0)), 4) AS n, round(sqrt(sum(coalesce(wt, 0) * coalesce(wt, 0))), 4) AS err
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN w ON {sql_bin('o_totalprice', MULT)} = ix GROUP BY 1""",
)
def e03(spark, sf):
    o = orders(spark, sf).withColumn("ix", MULT.index("o_totalprice"))
    weights = o.where("o_totalprice > 50000").groupBy("ix").agg(
        (F.count_if(F.col("o_orderstatus") == "F") / 1000.0).alias("content"))
    # the weight depends on the event, so it is looked up once per event, before the candidates join
    events = joins.lookup_content(o, weights, ["ix"], "w", 0.0)
    df = joins.join_events(with_ipt(items(spark, sf)), events, ["l_orderkey"], ["w"])
    return df.groupBy("ipt").agg(rounded(F.sum("w"), 4).alias("n"), rounded(F.sqrt(F.sum(F.col("w") * F.col("w"))), 4).alias("err"))


@query("E04_uniform_histogram", f"SELECT {sql_bin('l_extendedprice', Uniform(50, 10000.0, 90000.0))} AS ix, {N} AS content, {N} AS sumw2 FROM lineitem GROUP BY 1")
def e04(spark, sf):
    return hist.fill(items(spark, sf), [("l_extendedprice", Uniform(50, 10000.0, 90000.0))])


@query(
    "E05_variable_edges",
    f"""WITH h AS (SELECT l_returnflag, {sql_bin('l_quantity', PT)} AS ix, {sql_bin('l_discount', SHAPE)} AS iy,
                 {sql_bin('l_extendedprice', Edges.of(900, 20000, 50000, 105000))} AS iz,
                 sum(l_tax) AS content, sum(l_tax * l_tax) AS sumw2 FROM lineitem GROUP BY ALL)
        SELECT l_returnflag, ix, iy, iz, round(coalesce(content, 0), 6) AS content, round(coalesce(sumw2, 0), 6) AS sumw2
        FROM (SELECT * FROM (SELECT DISTINCT l_returnflag FROM lineitem) g, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS ix) x,
             (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS iy) y, (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS iz) z)
        LEFT JOIN h USING (l_returnflag, ix, iy, iz)""",
)
def e05(spark, sf):
    price = Edges.of(900, 20000, 50000, 105000)
    li = items(spark, sf)
    axes = [("l_quantity", PT), ("l_discount", SHAPE), ("l_extendedprice", price)]
    h = hist.fill(li, axes, ["l_returnflag"], weight="l_tax", flow=False)
    out = hist.zero_fill(h, li.select("l_returnflag").distinct(), ["l_returnflag"], [a for _, a in axes])
    return out.select("l_returnflag", "ix", "iy", "iz", rounded("content").alias("content"), rounded("sumw2").alias("sumw2"))


@query(
    "E06_cut_flow",
    """SELECT period, stage, n FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS "all",
         count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS trigger,
         count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P') AS selected,
         count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P' AND o_totalprice BETWEEN 1000 AND 99999) AS mult
         FROM orders GROUP BY 1) UNPIVOT (n FOR stage IN ("all", trigger, selected, mult))""",
)
def e06(spark, sf):
    o = table(spark, sf, "orders").withColumn("period", F.year("o_orderdate"))
    stages = {"all": F.lit(True), "trigger": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
              "selected": F.col("o_orderstatus") != "P", "mult": F.col("o_totalprice").between(1000, 99999)}
    return hist.cut_flow(o, stages, ["period"])


@query(
    "E07_mass_spectra",
    f"""SELECT {IPT_SQL} AS ipt, CAST(ibin2 AS INTEGER) AS ibin2, l_returnflag, {sql_bin('l_extendedprice', MASS)} AS ix, {N} AS content, {N} AS sumw2
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN {BINS2_SQL} ON o_totalprice BETWEEN lo AND hi
        WHERE o_orderstatus <> 'P' AND (l_linenumber & 1) = 1 GROUP BY ALL""",
)
def e07(spark, sf):
    """The flagship: selected events, tagged candidates, overlapping second bins, mass histogram."""
    events = orders(spark, sf).where(F.col("o_orderstatus") != "P")
    cands = with_ipt(bits.keep(items(spark, sf), "l_linenumber", on=[bits.STANDARD])).select(
        "l_orderkey", "ipt", "l_returnflag", "l_extendedprice")
    return hist.spectra_in_bins(
        joins.join_events(cands, events, ["l_orderkey"], ["o_totalprice"]), ("l_extendedprice", MASS),
        ["ipt", "l_returnflag"], "o_totalprice", MULT_LOW, MULT_HIGH)


E08_MASS = Uniform(5000, 900.0, 105000.0)


@query(
    "E08_mass_vs_shape",
    f"""SELECT {IPT_SQL} AS ipt, CAST(ibin2 AS INTEGER) AS ibin2, {sql_bin('l_extendedprice', E08_MASS)} AS ix, {sql_bin('l_discount', SHAPE)} AS iy,
               {N} AS content FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN (VALUES (0, 0, 100000), (1, 100000, 300000), (2, 300000, 500000)) b(ibin2, lo, hi) ON o_totalprice >= lo AND o_totalprice < hi
        GROUP BY ALL""",
)
def e08(spark, sf):
    events = orders(spark, sf).withColumn("ibin2", first_bin("o_totalprice", [0, 100000, 300000], [100000, 300000, 500000])).where("ibin2 is not null")
    df = joins.join_events(with_ipt(items(spark, sf)), events, ["l_orderkey"], ["ibin2"])
    return hist.fill(df, [("l_extendedprice", E08_MASS), ("l_discount", SHAPE)], ["ipt", "ibin2"]).drop("sumw2")


@query(
    "E09_inverse_weights",
    f"""SELECT {IPT_SQL} AS ipt, {sql_bin('l_extendedprice', Uniform(20, 900.0, 105000.0))} AS ix,
        round(sum(1 / CASE WHEN l_linenumber - 1 = 0 THEN 1.0::DOUBLE ELSE l_linenumber - 1 END), 6) AS content,
        round(sum(1 / CASE WHEN l_linenumber - 1 = 0 THEN 1.0::DOUBLE ELSE (l_linenumber - 1) * (l_linenumber - 1) END), 6) AS sumw2
        FROM lineitem GROUP BY ALL""",
)
def e09(spark, sf):
    df = with_ipt(items(spark, sf)).withColumn("w", hist.inverse_weight(F.col("l_linenumber") - 1))
    h = hist.fill(df, [("l_extendedprice", Uniform(20, 900.0, 105000.0))], ["ipt"], weight="w")
    return h.select("ipt", "ix", rounded("content").alias("content"), rounded("sumw2").alias("sumw2"))


E10_EVENT_SQL = """(SELECT CAST(o_orderkey % 8192 AS INTEGER) AS rej, CAST(year(o_orderdate) AS INTEGER) AS period,
                     o_orderstatus <> 'P' AS sel FROM orders)"""
E10_PARTS_SQL = f"""SELECT period, count(*) FILTER (sel) AS n_sel,
      count(*) FILTER ((rej & 3169) = 0 AND NOT (rej & 4230) = 0) AS n_no_vertex,
      count(*) FILTER ((rej & 3169) = 0 AND (rej & 4230) = 0 AND (rej & 8) = 8) AS n_vertex_out FROM {E10_EVENT_SQL} GROUP BY period"""


def norm_parts(spark, sf):
    ev = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 8192).cast("int").alias("rej"), F.year("o_orderdate").alias("period"),
        (F.col("o_orderstatus") != "P").alias("sel"))
    return hist.norm_parts(ev, "rej", F.col("sel"), ["period"])


@query("E10_norm_parts", E10_PARTS_SQL)
def e10(spark, sf):
    return norm_parts(spark, sf)


@query(
    "E11_event_norm",
    f"""SELECT period, CASE WHEN n_sel + n_vertex_out > 0 THEN round(n_sel + n_no_vertex - n_no_vertex * n_vertex_out / (n_sel + n_vertex_out), 6)
               ELSE -1.0 END AS norm FROM ({E10_PARTS_SQL})""",
)
def e11(spark, sf):
    norm = hist.event_norm(F.col("n_sel"), F.col("n_no_vertex"), F.col("n_vertex_out"))
    return norm_parts(spark, sf).select("period", rounded(norm).alias("norm"))


H2_SQL = f"(SELECT {sql_bin('l_quantity', PT)} AS ix, {sql_bin('l_discount', SHAPE)} AS iy, sum(l_tax) AS content, sum(l_tax * l_tax) AS sumw2 FROM lineitem GROUP BY ALL)"


def h2(spark, sf):
    return hist.fill(items(spark, sf), [("l_quantity", PT), ("l_discount", SHAPE)], weight="l_tax")


@query("E12_projection", f"SELECT iy, round(sum(content), 6) AS content, round(sum(sumw2), 6) AS sumw2 FROM {H2_SQL} WHERE ix BETWEEN 2 AND 4 GROUP BY iy")
def e12(spark, sf):
    h = hist.project(h2(spark, sf), ["iy"], F.col("ix").between(2, 4))
    return h.select("iy", rounded("content").alias("content"), rounded("sumw2").alias("sumw2"))


@query(
    "E13_integral",
    f"""SELECT iy, round(sum(content), 6) AS content FROM {H2_SQL} WHERE ix BETWEEN 2 AND 4 GROUP BY iy""",
)
def e13(spark, sf):
    h = hist.integral(h2(spark, sf), ["iy"], PT, 5.5, 20.5)
    return h.select("iy", rounded("content").alias("content"))


@query(
    "E14_profile",
    f"""SELECT l_returnflag, {sql_bin('l_quantity', PT)} AS ix, count(*) AS n, round(avg(l_extendedprice), 4) AS mean,
               round(stddev_pop(l_extendedprice) / sqrt(count(*)), 4) AS error FROM lineitem GROUP BY ALL""",
)
def e14(spark, sf):
    p = hist.profile(items(spark, sf), "l_quantity", PT, "l_extendedprice", ["l_returnflag"])
    return p.select("l_returnflag", "ix", "n", rounded("mean", 4).alias("mean"), rounded("error", 4).alias("error"))


FINE = Uniform(50, 0.5, 50.5)


@query("E15_rebin", f"SELECT l_returnflag, {sql_bin('l_quantity', PT)} AS ix, {N} AS content, {N} AS sumw2 FROM lineitem GROUP BY ALL")
def e15(spark, sf):
    return hist.rebin(hist.fill(items(spark, sf), [("l_quantity", FINE)], ["l_returnflag"]), FINE, PT)


@query(
    "E16_adaptive_rebin",
    f"""WITH f AS (SELECT l_linenumber, least(20, ceil(400 / (count(*) / 100.0))) AS factor FROM lineitem WHERE l_extendedprice < 105000 GROUP BY 1)
        SELECT l_linenumber, CAST(factor AS INTEGER) AS factor, CAST(floor(({sql_bin('l_extendedprice', MASS)} - 1) / factor) + 1 AS INTEGER) AS ix, {N} AS content
        FROM lineitem JOIN f USING (l_linenumber) GROUP BY ALL""",
)
def e16(spark, sf):
    h = hist.fill(items(spark, sf), [("l_extendedprice", MASS)], ["l_linenumber"])
    factors = hist.rebin_factor(h, ["l_linenumber"], MASS.n, 400, hi=20, lo=1, first=0)
    return hist.rebin_by(h.join(factors, "l_linenumber"), "factor").drop("sumw2")


@query(
    "E17_normalise",
    f"""WITH h AS (SELECT l_returnflag, {sql_bin('l_quantity', PT)} AS ix, count(*) AS c FROM lineitem GROUP BY ALL)
        SELECT l_returnflag, ix, round(c / sum(c) OVER w, 6) AS by_integral,
               round(c / (sum(c) FILTER (ix > 1) OVER w), 6) AS without_first,
               round(c / sum(c) OVER w / (list_extract({PT.edges}, ix + 1)::DOUBLE - list_extract({PT.edges}, ix)::DOUBLE), 6) AS by_width
        FROM h WINDOW w AS (PARTITION BY l_returnflag)""",
)
def e17(spark, sf):
    h = hist.fill(items(spark, sf), [("l_quantity", PT)], ["l_returnflag"])
    one = hist.normalise(h, ["l_returnflag"]).withColumnsRenamed({"content": "by_integral", "sumw2": "w2"})
    two = hist.normalise(h, ["l_returnflag"], skip_first=True)
    three = hist.normalise(h, ["l_returnflag"], width=PT.widths("ix"))
    out = joins.align_many({"by_integral": one.withColumnRenamed("by_integral", "content"), "without_first": two, "by_width": three}, ["l_returnflag", "ix"])
    return out.select("l_returnflag", "ix", *[rounded(c).alias(c) for c in ("by_integral", "without_first", "by_width")])


@query(
    "E18_one_per_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS r FROM lineitem) WHERE r = 1""",
)
def e18(spark, sf):
    return scans.first_per_key(items(spark, sf).select(*KEY, "l_quantity", "l_extendedprice"), ["l_orderkey", "l_linenumber"],
                               ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


@query(
    "E19_duplicate_report",
    """WITH d AS (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL)
       SELECT l_returnflag AS file_id, CAST(sum(copies) AS BIGINT) AS n_rows, CAST(coalesce(sum(copies) FILTER (copies > 1), 0) AS BIGINT) AS n_duplicates,
              count(*) FILTER (copies > 1) AS n_keys, round(100.0 * coalesce(sum(copies) FILTER (copies > 1), 0) / sum(copies), 6) AS percent
       FROM d GROUP BY 1""",
)
def e19(spark, sf):
    df = items(spark, sf).select(F.col("l_returnflag").alias("file_id"), *KEY)
    out = scans.duplicate_summary(df, "file_id", ["l_orderkey", "l_linenumber"])
    return out.withColumn("percent", rounded("percent"))


@query(
    "E19_duplicate_rows",
    f"""SELECT {KEY_SQL}, copies FROM (SELECT *, count(*) OVER (PARTITION BY l_returnflag, l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1""",
)
def e19_rows(spark, sf):
    return scans.duplicate_rows(items(spark, sf).select("l_returnflag", *KEY), ["l_returnflag", "l_orderkey", "l_linenumber"]).select(*KEY, "copies")


def auto_sql(variables, where="true", by="", n=100, limits=None):
    """Spread-out form of the auto-range histogram, one SELECT per variable."""
    limits = limits or {}
    parts = []
    for v in variables:
        lo, hi = limits.get(v, (f"(SELECT min({v})::DOUBLE FROM lineitem)", f"(SELECT max({v})::DOUBLE FROM lineitem)"))
        parts.append(
            f"SELECT '{v}' AS variable{by}, CAST(CASE WHEN {v} = {hi} THEN {n} ELSE floor({n} * ({v} - {lo}) / ({hi} - {lo})) + 1 END AS INTEGER) AS ix, "
            f"{N} AS content FROM lineitem WHERE {where} AND {v} BETWEEN {lo} AND {hi} GROUP BY ALL")
    return " UNION ALL ".join(parts)


E20_VARS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("E20_auto_range", auto_sql(E20_VARS, limits={"l_discount": (0.005, 0.095)}))
def e20(spark, sf):
    return hist.auto_hist(items(spark, sf), E20_VARS, limits={"l_discount": (0.005, 0.095)}).select("variable", "ix", "content")


@query(
    "E20_nan_range",
    f"""SELECT 'x' AS variable, CAST(CASE WHEN v = hi THEN 100 ELSE floor(100 * (v - lo) / (hi - lo)) + 1 END AS INTEGER) AS ix, {N} AS content
        FROM (SELECT l_extendedprice AS v FROM lineitem WHERE l_discount <> 0),
             (SELECT min(l_extendedprice)::DOUBLE AS lo, max(l_extendedprice)::DOUBLE AS hi FROM lineitem WHERE l_discount <> 0) GROUP BY ALL""",
)
def e20_nan(spark, sf):
    return hist.auto_hist(holey(items(spark, sf), "l_extendedprice"), ["x"]).select("variable", "ix", "content")


@query(
    "E21_density",
    f"""SELECT l_returnflag, ix, round(content / (sum(content) OVER (PARTITION BY l_returnflag) * ((SELECT max(l_extendedprice) FROM lineitem) -
        (SELECT min(l_extendedprice) FROM lineitem)) / 100), 10) AS density FROM ({auto_sql(['l_extendedprice'], by=', l_returnflag')})""",
)
def e21(spark, sf):
    h = hist.auto_hist(items(spark, sf), ["l_extendedprice"], ["l_returnflag"])
    d = hist.density(h, ["variable", "l_returnflag"], (F.col("hi") - F.col("lo")) / 100)
    return d.select("l_returnflag", "ix", rounded("density", 10).alias("density"))


@query("E22_correlation_pair", "SELECT l_returnflag, round(corr(l_quantity + l_linenumber, l_linenumber * 3 - l_discount), 2) AS corr FROM lineitem GROUP BY 1")
def e22(spark, sf):
    return items(spark, sf).groupBy("l_returnflag").agg(
        F.round(F.corr(F.col("l_quantity") + F.col("l_linenumber"), F.col("l_linenumber") * 3 - F.col("l_discount")), 2).alias("corr"))


E23 = 64  # all columns of the vector
E23_SQL = " UNION ALL ".join(
    f"SELECT label < 5 AS is_signal, 'e{i}' AS a, 'e{j}' AS b, round(corr(embedding[{i + 1}]::DOUBLE, embedding[{j + 1}]::DOUBLE), 6) AS corr FROM embeddings GROUP BY 1"
    for i in range(E23) for j in range(i + 1, E23))


@query("E23_correlation_matrix", E23_SQL)
def e23(spark, sf):
    e = table(spark, sf, "embeddings").select((F.col("label") < 5).alias("is_signal"),
                                              *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(E23)])
    out = scans.correlations(e, [f"e{i}" for i in range(E23)], ["is_signal"])
    return out.withColumn("corr", rounded("corr"))


@query(
    "E23_co_moments",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{a}' AS a, '{b}' AS b, count(*) AS n, round(sum(w), 4) AS w, round(sum(w * {a}) / sum(w), 4) AS mean_a, round(sum(w * {b}) / sum(w), 4) AS mean_b,
            round(sum(w * ({a} - 25) * ({b} - 25)) / sum(w) - (sum(w * {a}) / sum(w) - 25) * (sum(w * {b}) / sum(w) - 25), 4) AS cov
            FROM (SELECT *, l_tax + 0.5 AS w FROM lineitem) GROUP BY 1""" for a, b in (("l_quantity", "l_quantity"), ("l_quantity", "l_linenumber"), ("l_linenumber", "l_linenumber"))),
)
def e23_moments(spark, sf):
    df = items(spark, sf).withColumn("w", F.col("l_tax") + 0.5)
    m = scans.co_moments(df, ["l_quantity", "l_linenumber"], ["l_returnflag"], "w")
    return m.select("l_returnflag", "a", "b", "n", *[rounded(c, 4).alias(c) for c in ("w", "mean_a", "mean_b", "cov")])


@query(
    "E24_trial_spread",
    f"""WITH t AS (SELECT {IPT_SQL} AS ipt, l_linenumber AS trial, avg(l_extendedprice) AS v FROM lineitem GROUP BY ALL)
        SELECT ipt, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS rms,
               round((avg(v) - max(v) FILTER (trial = 1)) / max(v) FILTER (trial = 1), 6) AS rel_diff FROM t GROUP BY ipt""",
)
def e24(spark, sf):
    t = with_ipt(items(spark, sf)).groupBy("ipt", F.col("l_linenumber").alias("trial")).agg(F.avg("l_extendedprice").alias("v"))
    out = scans.trial_spread(t, ["ipt"], "v", F.col("trial") == 1)
    return out.select("ipt", rounded("mean", 4).alias("mean"), rounded("rms", 4).alias("rms"), rounded("rel_diff").alias("rel_diff"))


PT_G = Edges.of(0.5, 10.5, 20.5, 35.5, 50.5)
VALUE_R = Edges.of(900, 20000, 50000, 80000, 105000)
VALUE_G = Edges.of(900, 15000, 30000, 50000)
PAIRS_SQL = f"""(SELECT *, {sql_bin('l_discount', SHAPE)} AS ix_r, {sql_bin('l_extendedprice', VALUE_R)} AS iy_r,
      {sql_bin('l_tax', Edges.of(-0.005, 0.025, 0.055, 0.085))} AS ix_g, {sql_bin('l_quantity * p_retailprice', VALUE_G)} AS iy_g
      FROM lineitem JOIN part ON l_partkey = p_partkey)"""
PAIRS_IN = "ix_r BETWEEN 1 AND 4 AND iy_r BETWEEN 1 AND 4 AND ix_g BETWEEN 1 AND 3 AND iy_g BETWEEN 1 AND 3"
TAX = Edges.of(-0.005, 0.025, 0.055, 0.085)


def pairs(spark, sf):
    """Matched (reco, gen) rows: price against quantity times list price."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return items(spark, sf).join(part, "l_partkey").withColumn("gen_value", F.col("l_quantity") * F.col("p_retailprice"))


RECO = [("l_discount", SHAPE), ("l_extendedprice", VALUE_R)]
GEN = [("l_tax", TAX), ("gen_value", VALUE_G)]


@query("E25_response_matrix", f"SELECT ix_r, iy_r, ix_g, iy_g, {N} AS w FROM {PAIRS_SQL} WHERE {PAIRS_IN} GROUP BY ALL")
def e25(spark, sf):
    return hist.response(pairs(spark, sf), RECO, GEN)


@query(
    "E26_prior_weight",
    f"""WITH g AS (SELECT ix_g, iy_g, {N} AS n FROM {PAIRS_SQL} GROUP BY ALL)
        SELECT ix_r, iy_r, ix_g, iy_g, round(sum(1 / n), 8) AS w FROM {PAIRS_SQL} JOIN g USING (ix_g, iy_g) WHERE {PAIRS_IN} GROUP BY ALL""",
)
def e26(spark, sf):
    df = pairs(spark, sf).withColumns({"ix_g": TAX.index("l_tax"), "iy_g": VALUE_G.index("gen_value")})
    out = hist.response(hist.prior_weights(df, ["ix_g", "iy_g"]).drop("ix_g", "iy_g"), RECO, GEN, weight="weight")
    return out.withColumn("w", rounded("w", 8))


@query(
    "E27_range_counts",
    f"""SELECT l_returnflag, count(*) FILTER (ix_r BETWEEN 1 AND 4 AND iy_r BETWEEN 2 AND 3) AS n_reco,
          count(*) FILTER (ix_g BETWEEN 1 AND 3 AND iy_g BETWEEN 1 AND 2) AS n_gen,
          count(*) FILTER (ix_r BETWEEN 1 AND 4 AND iy_r BETWEEN 2 AND 3 AND ix_g BETWEEN 1 AND 3 AND iy_g BETWEEN 1 AND 2) AS n_both
        FROM {PAIRS_SQL} GROUP BY 1""",
)
def e27(spark, sf):
    reco = F.col("l_discount").between(-0.005, 0.1) & (F.col("l_extendedprice") >= 20000) & (F.col("l_extendedprice") < 80000)
    gen = (F.col("l_tax") < 0.085) & (F.col("gen_value") >= 900) & (F.col("gen_value") < 30000)
    return hist.range_counts(pairs(spark, sf), reco, gen, ["l_returnflag"])


@query(
    "E28_period_totals",
    f"""SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'all') AS period, {sql_bin('o_totalprice', MULT)} AS ix, {N} AS content FROM orders GROUP BY 1, 2
        UNION ALL SELECT 'all', {sql_bin('o_totalprice', MULT)}, {N} FROM orders GROUP BY 2""",
)
def e28(spark, sf):
    df = orders(spark, sf).select(F.col("period").cast("string").alias("period"), MULT.index("o_totalprice").alias("ix"))
    return hist.with_total(df, "period", ["ix"])


@query("E29_variables_by_class", auto_sql(E20_VARS, by=", l_returnflag = 'R' AS is_signal"))
def e29(spark, sf):
    df = items(spark, sf).withColumn("is_signal", F.col("l_returnflag") == "R")
    return hist.auto_hist(df, E20_VARS, ["is_signal"]).select("variable", "is_signal", "ix", "content")


@query(
    "E30_validation_set",
    f"""SELECT 'price' AS hist, {sql_bin('l_extendedprice', MASS)} AS ix, 0 AS iy, {N} AS content FROM lineitem GROUP BY ALL
        UNION ALL SELECT 'price_tagged', {sql_bin('l_extendedprice', MASS)}, 0, {N} FROM lineitem WHERE (l_linenumber & 2) = 2 GROUP BY ALL
        UNION ALL SELECT 'pt_shape', {sql_bin('l_quantity', PT)}, {sql_bin('l_discount', SHAPE)}, {N} FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL""",
)
def e30(spark, sf):
    specs = [
        {"name": "price", "x": ("l_extendedprice", MASS)},
        {"name": "price_tagged", "x": ("l_extendedprice", MASS), "where": bits.has_bits("l_linenumber", [1])},
        {"name": "pt_shape", "x": ("l_quantity", PT), "y": ("l_discount", SHAPE), "where": F.col("l_returnflag") == "A"},
        {"name": "absent", "x": ("no_such_column", PT)},
    ]
    return hist.spec_histograms(items(spark, sf), specs)


@query(
    "E31_distribution_job",
    f"""WITH f AS (SELECT DISTINCT ON (l_orderkey, ipt) * FROM (SELECT o_orderkey AS l_orderkey, CAST(year(o_orderdate) AS INTEGER) AS period, o_totalprice,
                      {IPT_SQL} AS ipt FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND l_discount > 0.015))
        SELECT period, slice, {sql_bin('o_totalprice', MULT)} AS ix, {N} AS content FROM
          (SELECT *, 'low' AS slice FROM f WHERE ipt < 2 UNION ALL SELECT *, 'high' FROM f WHERE ipt >= 2) GROUP BY ALL""",
)
def e31(spark, sf):
    li = items(spark, sf)
    n = li.count()
    # one row per order and pt bin before the join: an order of very many items sends no more than its bins
    li = joins.dealt(with_ipt(select_rows(li, "l_discount > 0.015")).select("l_orderkey", "ipt"), ["l_orderkey"], n).distinct()
    df = joins.merge_all(li, [(joins.dealt(orders(spark, sf), ["l_orderkey"], n), ["l_orderkey"])])
    return hist.distribution_job(
        df, query="o_orderstatus != 'P'", unique=["l_orderkey", "ipt"],
        columns=["period", "o_totalprice"], axis=("o_totalprice", MULT), by=["period"],
        slices={"low": "ipt < 2", "high": "ipt >= 2"}).drop("sumw2")
