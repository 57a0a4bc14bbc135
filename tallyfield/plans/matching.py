"""Joins on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import Uniform, first_bin
from ..operators import hist, joins
from .registry import MULT_HIGH, MULT_LOW, PT, PT_HIGH, PT_LOW, query, sql_bin, sql_first_bin, sql_values, table
from .selections import KEY, KEY_SQL, items

MULT = Uniform(10, 0.0, 500000.0)
BINS2_SQL = f"(SELECT * FROM ({sql_values([(i, a, b) for i, (a, b) in enumerate(zip(MULT_LOW, MULT_HIGH))])}) b(ibin2, lo, hi))"


def orders(spark, sf):
    """Events: file id (status), key, multiplicity-like value."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").alias("period"))


@query(
    "D01_candidates_with_events",
    f"""SELECT {KEY_SQL}, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""",
)
def d01(spark, sf):
    events = orders(spark, sf).where(F.col("o_orderstatus") != "P")
    return joins.join_events(items(spark, sf), events, ["l_orderkey"], ["o_totalprice"]).select(*KEY, "o_totalprice")


@query(
    "D02_generated_with_events",
    f"SELECT {KEY_SQL}, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'",
)
def d02(spark, sf):
    gen = items(spark, sf).where(F.col("l_linestatus") == "F")
    return joins.join_events(gen, orders(spark, sf), ["l_orderkey"], ["o_totalprice"]).select(*KEY, "o_totalprice")


@query(
    "D03_events_with_candidates",
    """SELECT o.o_orderkey AS event_key, o.o_totalprice AS value_x, l.l_extendedprice AS value_y, l.l_linenumber
       FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE abs(l.l_extendedprice - 50000) < 15000""",
)
def d03(spark, sf):
    ev = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_key"), F.col("o_totalprice").alias("value"))
    ca = items(spark, sf).where(F.abs(F.col("l_extendedprice") - 50000) < 15000).select(
        F.col("l_orderkey").alias("event_key"), F.col("l_extendedprice").alias("value"), "l_linenumber")
    return joins.join_suffixed(ev, ca, ["event_key"])


@query(
    "D04_merge_all",
    f"""SELECT {KEY_SQL}, o_totalprice, p_size, s_acctbal FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def d04(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    supp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    evts = orders(spark, sf).select("l_orderkey", "o_totalprice")
    return joins.merge_all(items(spark, sf).select(*KEY), [(evts, ["l_orderkey"]), (part, ["l_partkey"]), (supp, ["l_suppkey"])])


@query(
    "D05_bin_matching",
    f"""SELECT ipt, list_extract([0, 0, 1, 2, 2], ipt + 1) AS skim_bin, count(*) AS n FROM
        (SELECT CAST({sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS INTEGER) AS ipt FROM lineitem) GROUP BY 1, 2""",
)
def d05(spark, sf):
    df = items(spark, sf).select(first_bin("l_quantity", PT_LOW, PT_HIGH).alias("ipt"))
    return df.withColumn("skim_bin", joins.match_bin(F.col("ipt"), [0, 0, 1, 2, 2])).groupBy("ipt", "skim_bin").agg(F.count("*").alias("n"))


@query(
    "D06_overlapping_bins",
    f"SELECT o_orderkey, CAST(ibin2 AS INTEGER) AS ibin2 FROM orders JOIN {BINS2_SQL} ON o_totalprice >= lo AND o_totalprice <= hi",
)
def d06(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return joins.explode_bins(o, "o_totalprice", MULT_LOW, MULT_HIGH).drop("o_totalprice")


@query(
    "D07_content_lookup",
    f"""WITH w AS (SELECT {sql_bin('o_totalprice', MULT)} AS ix, CAST(count(*) AS DOUBLE) AS content FROM orders
                   WHERE o_orderstatus = 'F' AND o_totalprice > 50000 GROUP BY 1)
        SELECT o_orderkey, coalesce(content, 0) AS weight FROM orders LEFT JOIN w ON {sql_bin('o_totalprice', MULT)} = ix""",
)
def d07(spark, sf):
    o = table(spark, sf, "orders").withColumn("ix", MULT.index("o_totalprice"))
    weights = hist.fill(o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 50000)), [("o_totalprice", MULT)])
    return joins.lookup_content(o, weights, ["ix"], "weight", 0.0).select("o_orderkey", "weight")


def _by_period(status):
    return f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS period, {sql_bin('o_totalprice', MULT)} AS ix, CAST(count(*) AS DOUBLE) AS c
               FROM orders WHERE o_orderstatus = '{status}' GROUP BY 1, 2"""


@query(
    "D08_match_periods",
    f"""SELECT d.period, d.ix, d.c AS data, m.c AS mc FROM ({_by_period('F')}) d JOIN ({_by_period('O')}) m USING (period, ix)""",
)
def d08(spark, sf):
    o = orders(spark, sf)
    groups = o.select("period").distinct()

    def spectrum(status):
        h = hist.fill(o.where(F.col("o_orderstatus") == status), [("o_totalprice", MULT)], ["period"])
        return hist.zero_fill(h, groups, ["period"], [MULT])

    return joins.match_periods(spectrum("F"), spectrum("O"), ["period", "ix"]).where("data > 0 and mc > 0").select("period", "ix", "data", "mc")


@query(
    "D09_bin_wise_join",
    f"""WITH a AS (SELECT {sql_bin('l_quantity', PT)} AS ix, CAST(count(*) AS DOUBLE) AS c FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
             b AS (SELECT {sql_bin('l_quantity', PT)} AS ix, CAST(count(*) AS DOUBLE) AS c FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
        SELECT ix, list_extract({PT.edges}, ix)::DOUBLE AS x_low, list_extract({PT.edges}, ix + 1)::DOUBLE AS x_up, a.c AS a_content, b.c AS b_content,
               a.c AS a_sumw2, b.c AS b_sumw2 FROM a FULL JOIN b USING (ix)""",
)
def d09(spark, sf):
    def spectrum(flag):
        return hist.with_edges(hist.fill(items(spark, sf).where(F.col("l_returnflag") == flag), [("l_quantity", PT)]), PT)

    return joins.same_binning(spectrum("A"), spectrum("R"), ["ix"])


CUTS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


@query(
    "D10_trial_fanout",
    f"""SELECT l_returnflag, printf('cut_%d', trial) AS trial, CAST(count(*) FILTER ((l_quantity + l_linenumber * 10) / 125.0 > (trial + 0.03) / 10) AS DOUBLE) AS content
        FROM lineitem, (SELECT unnest(range(1, 10)) AS trial) GROUP BY 1, 2""",
)
def d10(spark, sf):
    prob = (F.col("l_quantity") + F.col("l_linenumber") * 10) / 125.0
    trials = {f"cut_{i}": prob > (i + 0.03) / 10 for i in range(1, 10)}
    return joins.count_trials(items(spark, sf), ["l_returnflag"], trials)
