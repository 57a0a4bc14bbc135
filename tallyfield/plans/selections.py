"""Filters and predicates on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bits
from ..functions import predicates as P
from ..functions.bins import first_bin
from ..operators import samples
from ..sources import scan
from .registry import PT_HIGH, PT_LOW, query, sql_first_bin, table

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = ", ".join(KEY)
COLS = KEY + ["l_quantity", "l_extendedprice"]
COLS_SQL = ", ".join(COLS)
PROB_SQL = "((l_quantity + l_linenumber * 10) / 125.0)"
def prob():
    """Stand-in for a model score, in [0, 1]."""
    return (F.col("l_quantity") + F.col("l_linenumber") * 10) / 125.0


def items(spark, sf):
    return table(spark, sf, "lineitem")


def rows(where: str, extra: str = "") -> str:
    return f"SELECT {COLS_SQL}{extra} FROM lineitem WHERE {where}"


@query("B01_string_predicate", rows("(l_quantity > 10 AND abs(l_discount - 0.05) < 0.021) OR l_returnflag = 'R' AND NOT l_tax > 0.03"))
def b01(spark, sf):
    q = "(l_quantity > 10 and abs(l_discount - 0.05) < 0.021) or l_returnflag == 'R' and not l_tax > 0.03"
    return P.select_rows(items(spark, sf), q).select(*COLS)


def holey(df, column: str):
    """x: the column, NaN where the discount is 0."""
    return df.withColumn("x", F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col(column)))


@query("B01_nan_condition", rows("(l_discount = 0 OR NOT l_discount > 0.05) AND (l_discount = 0 OR l_discount <> 0.02) OR l_quantity > 45"))
def b01_nan(spark, sf):
    return P.select_rows(holey(items(spark, sf), "l_discount"), "not x > @top and x != 0.02 or l_quantity > 45", {"top": 0.05}).select(*COLS)


@query("B19_nan_cuts", rows(f"CASE CAST({sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS INTEGER) WHEN 0 THEN l_discount > 0.03 WHEN 1 THEN l_discount = 0 OR NOT l_discount > 0.03 WHEN 2 THEN true ELSE false END"))
def b19_nan(spark, sf):
    df = holey(items(spark, sf), "l_discount")
    return df.where(P.per_bin(first_bin("l_quantity", PT_LOW, PT_HIGH), ["x > 0.03", "not x > 0.03", None], df)).select(*COLS)


@query("B02_half_open_range", rows("l_quantity >= 5 AND l_quantity < 20"))
def b02(spark, sf):
    return items(spark, sf).where(P.half_open("l_quantity", 5, 20)).select(*COLS)


@query("B03_closed_range", rows("l_quantity >= 5 AND l_quantity <= 20"))
def b03(spark, sf):
    return items(spark, sf).where(P.closed("l_quantity", 5, 20)).select(*COLS)


@query("B04_open_range", rows("l_quantity > 5 AND l_quantity < 20"))
def b04(spark, sf):
    return items(spark, sf).where(P.open_range("l_quantity", 5, 20)).select(*COLS)


@query("B05_mass_window", rows("abs(l_extendedprice - 50000) <= 1500"))
def b05(spark, sf):
    return items(spark, sf).where(P.near("l_extendedprice", 50000, 1500)).select(*COLS)


@query(
    "B06_run_selection",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
)
def b06(spark, sf):
    runs = table(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("run_number"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return scan.select_runs(orders, runs, "o_custkey")


@query("B07_bit_tag", f"SELECT {COLS_SQL}, CAST((l_linenumber & 1) = 1 AND (l_linenumber & 2) = 0 AS INTEGER) AS tag FROM lineitem")
def b07(spark, sf):
    return bits.tag(items(spark, sf), "l_linenumber", {"tag": ([0], [1])}).select(*COLS, "tag")


@query("B08_bit_filter", rows("(l_linenumber & 5) = 5 AND (l_linenumber & 2) = 0"))
def b08(spark, sf):
    return bits.keep(items(spark, sf), "l_linenumber", [0, 2], [1]).select(*COLS)


CLASSES = {"isstd": ([0], []), "ismcsignal": ([1], [2]), "ismcprompt": ([0, 1], [2]), "ismcbkg": ([2], [])}


@query(
    "B09_class_tags",
    f"""SELECT {KEY_SQL}, CAST((l_linenumber & 1) = 1 AS INTEGER) AS isstd,
        CAST((l_linenumber & 2) = 2 AND (l_linenumber & 4) = 0 AS INTEGER) AS ismcsignal,
        CAST((l_linenumber & 3) = 3 AND (l_linenumber & 4) = 0 AS INTEGER) AS ismcprompt,
        CAST((l_linenumber & 4) = 4 AS INTEGER) AS ismcbkg FROM lineitem""",
)
def b09(spark, sf):
    return bits.tag(items(spark, sf).select(*KEY), "l_linenumber", CLASSES)


@query("B10_bit_shortcuts", f"SELECT {COLS_SQL}, 1 AS isstd FROM lineitem WHERE (l_linenumber & 1) = 1")
def b10(spark, sf):
    return bits.with_bit(items(spark, sf), "l_linenumber", bits.STANDARD, "isstd").select(*COLS, "isstd")


@query(
    "B11_fiducial",
    rows("""CASE WHEN l_quantity / 5 > 5 THEN abs(l_tax * 11 - 0.01::DOUBLE) < 0.8
            ELSE abs(l_tax * 11 - 0.01::DOUBLE) < (-0.2::DOUBLE / 15) * (l_quantity / 5) * (l_quantity / 5) + (1.9::DOUBLE / 15) * (l_quantity / 5) + 0.5 END"""),
)
def b11(spark, sf):
    return items(spark, sf).where(P.fiducial(F.col("l_quantity") / 5, F.col("l_tax") * 11 - 0.01)).select(*COLS)


@query("B12_pid_three_track", rows("(l_discount < 0.025 OR l_tax < 0.015) AND (l_tax < 0.045 OR l_discount < 0.045) AND l_discount + l_tax < 0.065"))
def b12(spark, sf):
    tracks = [[F.col("l_discount") - 0.025, F.col("l_tax") - 0.015], [F.col("l_tax") - 0.045, F.col("l_discount") - 0.045],
              [F.col("l_discount") + F.col("l_tax") - 0.065]]
    return items(spark, sf).where(P.pid_all_tracks(tracks, 0.0)).select(*COLS)


@query("B13_pid_two_track", rows("(l_discount < 0.035 OR l_tax < 0.035) AND (l_quantity < 30 OR l_linenumber < 3)"))
def b13(spark, sf):
    tracks = [[F.col("l_discount") - 0.035, F.col("l_tax") - 0.035], [F.col("l_quantity") - 30, F.col("l_linenumber") - 3.0]]
    return items(spark, sf).where(P.pid_all_tracks(tracks, 0.0)).select(*COLS)


@query("B14_pid_bachelor", rows("l_discount < 0.025 OR l_tax < 0.025"))
def b14(spark, sf):
    return items(spark, sf).where(P.any_below(["l_discount", "l_tax"], 0.025)).select(*COLS)


@query("B15_linear_cut", rows("abs(l_discount - 0.05) > 0.015 AND abs(l_discount - 0.05) < 0.045 AND l_quantity > 2 AND l_quantity < 30"))
def b15(spark, sf):
    return items(spark, sf).where(P.linear_cut(F.col("l_discount") - 0.05, 0.015, 0.045, absolute=True)).where(
        P.linear_cut("l_quantity", 2, 30)).select(*COLS)


@query("B16_probability_cut", rows(f"{PROB_SQL} > 0.604"))
def b16(spark, sf):
    return items(spark, sf).where(P.gt(prob(), 0.604)).select(*COLS)


WP = {0: (0.3, 0.302), 1: (0.25, 0.402), 2: (0.2, 0.502), 3: (0.15, 0.552), 4: (0.1, 0.602)}
WP_SQL = " ".join(f"WHEN {i} THEN {{}}{i}" for i in WP)


@query(
    "B17_two_class_point",
    f"""SELECT {COLS_SQL} FROM (SELECT *, {sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS ipt FROM lineitem)
        WHERE l_discount * 4 <= CASE ipt {' '.join(f'WHEN {i} THEN {v[0]}' for i, v in WP.items())} END
          AND {PROB_SQL} >= CASE ipt {' '.join(f'WHEN {i} THEN {v[1]}' for i, v in WP.items())} END""",
)
def b17(spark, sf):
    ipt = first_bin("l_quantity", PT_LOW, PT_HIGH)
    cuts = [P.chosen_by_bin(ipt, {i: v[k] for i, v in WP.items()}) for k in (0, 1)]
    return items(spark, sf).where(P.working_point([F.col("l_discount") * 4, prob()], cuts)).select(*COLS)


@query("B18_no_model_fallback", rows("(l_linenumber & 1) = 1"))
def b18(spark, sf):
    return P.select_rows(bits.tag(items(spark, sf), "l_linenumber", {"isstd": ([0], [])}), "isstd == 1").select(*COLS)


CUSTOM = ["l_discount < 0.055", None, "l_tax > 0.015 and l_discount > 0.015", "abs(l_discount - 0.05) < 0.021", "l_extendedprice > 20000"]


@query(
    "B19_custom_cuts_per_bin",
    f"""SELECT {COLS_SQL} FROM (SELECT *, {sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS ipt FROM lineitem)
        WHERE CASE ipt {' '.join(f'WHEN {i} THEN {q or "true"}' for i, q in enumerate(CUSTOM))} ELSE false END""",
)
def b19(spark, sf):
    P.require_per_bin(CUSTOM, len(PT_LOW))
    df = items(spark, sf)
    return df.where(P.per_bin(first_bin("l_quantity", PT_LOW, PT_HIGH), CUSTOM, df)).select(*COLS)


@query(
    "B20_topological_cut",
    rows("""(l_tax <> 0 AND (l_linenumber = 7 OR abs(l_discount / nullif(l_tax, 0)) >= 0.5) OR l_tax = 0 AND l_discount <> 0)
            AND l_quantity / 10 >= 0.5 AND l_discount >= least((l_quantity / 20) * cosh(l_tax * 10) * 0.0066 + 0.01, 0.06)
            AND abs(l_linenumber - 3.5) >= 1""").replace("(l_linenumber = 7 OR ", "(false OR "),
)
def b20(spark, sf):
    return items(spark, sf).where(
        P.displaced(["l_discount", F.col("l_quantity") / 10], ["l_tax", F.lit(1.0)], "l_discount",
                    F.col("l_linenumber") - 3.5, F.col("l_quantity") / 20, F.col("l_tax") * 10)
    ).select(*COLS)


@query(
    "B21_at_least_one",
    f"""SELECT ipt, count(*) AS n FROM (SELECT *, CAST({sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS INTEGER) AS ipt FROM lineitem)
        WHERE ipt NOT IN (1, 3) OR l_discount > 0 GROUP BY ipt""",
)
def b21(spark, sf):
    df = items(spark, sf).withColumn("ipt", first_bin("l_quantity", PT_LOW, PT_HIGH))
    flags = [False, True, False, True, False]
    need = P.per_bin("ipt", ["l_discount > 0" if f else None for f in flags], df)
    return df.where(need).groupBy("ipt").agg(F.count("*").alias("n"))


@query(
    "B22_selection_cascade",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
         AND o_orderstatus <> 'P'""",
)
def b22(spark, sf):
    runs = table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("run_number"))
    return samples.select_events(
        table(spark, sf, "orders"), trigger="o_orderpriority in ('1-URGENT', '2-HIGH')", runs=runs,
        run_col="o_custkey", event="o_orderstatus != 'P'").select("o_orderkey", "o_totalprice")


@query(
    "B23_training_selection",
    f"""SELECT {KEY_SQL}, 'sig' AS part FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10
        UNION ALL SELECT {KEY_SQL}, 'bkg' FROM lineitem WHERE l_returnflag = 'N' AND (l_extendedprice < 20000 OR l_extendedprice > 80000)""",
)
def b23(spark, sf):
    sig, bkg = samples.signal_background(
        items(spark, sf), "l_returnflag == 'R' and l_quantity > 10",
        "l_returnflag == 'N' and (l_extendedprice < 20000 or l_extendedprice > 80000)")
    return sig.select(*KEY, F.lit("sig").alias("part")).unionByName(bkg.select(*KEY, F.lit("bkg").alias("part")))


@query("B24_label_split", "SELECT CAST(label < 5 AS INTEGER) AS label, count(*) AS n, min(vec_id) AS first FROM embeddings GROUP BY 1")
def b24(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", (F.col("label") < 5).cast("int").alias("label"))
    sig, bkg = samples.split_by_label(df, "label")
    return sig.unionByName(bkg).groupBy("label").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))


@query(
    "B25_prompt_or_feeddown",
    """SELECT l_linestatus, count(*) FILTER (l_returnflag = 'A') AS n_prompt, count(*) FILTER (l_returnflag = 'R') AS n_fd,
              count(*) FILTER (l_linenumber = 4) AS n_parton4, count(*) FILTER (l_linenumber = 5) AS n_parton5
       FROM lineitem GROUP BY 1""",
)
def b25(spark, sf):
    flag, parton = F.col("l_returnflag"), F.col("l_linenumber")
    return items(spark, sf).groupBy("l_linestatus").agg(
        F.count_if(flag == "A").alias("n_prompt"), F.count_if(flag == "R").alias("n_fd"),
        F.count_if(parton == 4).alias("n_parton4"), F.count_if(parton == 5).alias("n_parton5"))


@query("B26_tag_complement", rows("NOT ((l_linenumber & 1) = 1 AND (l_linenumber & 4) = 0)"))
def b26(spark, sf):
    return items(spark, sf).where(~bits.has_bits("l_linenumber", [0], [2])).select(*COLS)


@query(
    "B27_tof_split",
    """SELECT l_returnflag, count(*) FILTER (l_quantity - 1023 < -998) AS n_without, count(*) FILTER (l_quantity - 1023 > -998) AS n_with
       FROM lineitem GROUP BY 1""",
)
def b27(spark, sf):
    return samples.tof_split(items(spark, sf).withColumn("nsigTOF", F.col("l_quantity") - 1023), ["l_returnflag"], "nsigTOF")


@query("B28_projection", f"SELECT {COLS_SQL} FROM lineitem")
def b28(spark, sf):
    return items(spark, sf).select(*COLS)
