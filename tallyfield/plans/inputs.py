"""Scans, sinks and layouts on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import Uniform
from ..operators import hist
from ..session import fresh_path
from ..sources import layout, scan, errors_table
from ..streaming import incremental
from .registry import PT, PT_HIGH, PT_LOW, SHAPE, query, rounded, sql_bin, sql_first_bin, table
from .selections import PROB_SQL, prob



@query("A01_column_scan", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def a01(spark, sf):
    return scan.scan(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@query(
    "A03_file_discovery",
    """SELECT 'orders.parquet' AS file_name, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus""",
)
def a03(spark, sf):
    df = scan.scan_tree(spark, sf, "o*.parquet", select=["orders", "lineitem"], max_files=1)
    return df.groupBy(
        F.element_at(F.split("file_id", "/"), -1).alias("file_name"), "o_orderstatus"
    ).agg(F.count("*").alias("n"))


@query("A04_compressed_copy", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def a04(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return layout.write_table(df, fresh_path(spark, "copy"))


@query(
    "A05_skim_layout",
    f"""SELECT CAST({sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS INTEGER) AS skim_bin, l_returnflag,
               count(*) AS n, round(avg(l_extendedprice), 4) AS mean_price
        FROM lineitem GROUP BY 1, 2""",
)
def a05(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", "l_returnflag", "l_extendedprice")
    skimmed = layout.write_skimmed(
        layout.with_skim_bin(df, "l_quantity", PT_LOW, PT_HIGH), fresh_path(spark, "skim")
    )
    return skimmed.groupBy("skim_bin", "l_returnflag").agg(
        F.count("*").alias("n"), rounded(F.avg("l_extendedprice"), 4).alias("mean_price")
    )


@query(
    "A06_concatenate",
    """SELECT kind, count(*) AS n, round(sum(value), 2) AS total FROM (
         SELECT 'orders' AS kind, o_totalprice AS value FROM orders
         UNION ALL SELECT 'lineitem', l_extendedprice FROM lineitem) GROUP BY kind""",
)
def a06(spark, sf):
    o = table(spark, sf, "orders").select(F.lit("orders").alias("kind"), F.col("o_totalprice").alias("value"))
    l = table(spark, sf, "lineitem").select(F.lit("lineitem").alias("kind"), F.col("l_extendedprice").alias("value"))
    return scan.concatenate(o, l).groupBy("kind").agg(
        F.count("*").alias("n"), rounded(F.sum(F.col("value").cast("decimal(18,2)")).cast("double"), 2).alias("total")
    )


@query(
    "A07_file_sample",
    """WITH files AS (SELECT DISTINCT s_suppkey AS file_id FROM supplier),
            ranked AS (SELECT file_id, row_number() OVER (ORDER BY md5('12|' || file_id), file_id) AS r,
                              count(*) OVER () AS n FROM files),
            kept AS (SELECT file_id FROM ranked WHERE r <= floor(n * 0.08 + 1e-9))
       SELECT 'lineitem' AS kind, l_suppkey AS file_id, count(*) AS n FROM lineitem
       WHERE l_suppkey IN (SELECT file_id FROM kept) GROUP BY l_suppkey
       UNION ALL SELECT 'supplier', s_suppkey, count(*) FROM supplier
       WHERE s_suppkey IN (SELECT file_id FROM kept) GROUP BY s_suppkey""",
)
def a07(spark, sf):
    sup = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("file_id"))
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("file_id"))
    kept = scan.sample_files({"lineitem": li, "supplier": sup}, sup, 0.08, 12)
    return scan.concatenate(*[d.withColumn("kind", F.lit(k)) for k, d in kept.items()]).groupBy("kind", "file_id").agg(
        F.count("*").alias("n")
    )


@query(
    "A08_period_union",
    """SELECT CASE o_orderstatus WHEN 'F' THEN '2016' WHEN 'O' THEN '2017' ELSE '2018' END AS period,
              count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1""",
)
def a08(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    parts = {p: o.where(F.col("o_orderstatus") == s) for p, s in (("2016", "F"), ("2017", "O"), ("2018", "P"))}
    return scan.union_periods(parts).groupBy("period").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))


@query(
    "A09_histogram_merge",
    f"""SELECT l_linestatus, {sql_bin('l_quantity', PT)} AS ix, CAST(count(*) AS DOUBLE) AS content,
               CAST(count(*) AS DOUBLE) AS sumw2 FROM lineitem GROUP BY 1, 2""",
)
def a09(spark, sf):
    li = table(spark, sf, "lineitem")
    # the histograms of the three classes stand for the outputs of separate files
    parts = [hist.fill(li.where(F.col("l_returnflag") == f), [("l_quantity", PT)], ["l_linestatus"]) for f in "ANR"]
    return hist.merge(*parts)


@query(
    "A10_theory_curve",
    """SELECT CAST(p_size AS DOUBLE) AS pt, round(avg(p_retailprice), 4) AS central,
              min(p_retailprice) AS min, max(p_retailprice) AS max FROM part GROUP BY p_size""",
)
def a10(spark, sf):
    curve = table(spark, sf, "part").groupBy(F.col("p_size").cast("double").alias("pt")).agg(
        rounded(F.avg("p_retailprice"), 4).alias("central"), F.min("p_retailprice").alias("min"),
        F.max("p_retailprice").alias("max"),
    )
    return scan.read_curve(spark, layout.write_csv(curve, fresh_path(spark, "curve")))


@query(
    "A11_scored_export",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({PROB_SQL}, 6) AS y_test_prob,
               CAST({PROB_SQL} > 0.5 AS INTEGER) AS y_test_prediction FROM lineitem""",
)
def a11(spark, sf):
    li = table(spark, sf, "lineitem")
    scored = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rounded(prob()).alias("y_test_prob"),
        (prob() > 0.5).cast("int").alias("y_test_prediction"),
    )
    return layout.write_table(scored, fresh_path(spark, "scored"))


@query(
    "A12_histogram_meta",
    f"""SELECT ipt, ibin2, CAST(count(*) AS DOUBLE) AS content, 'l_quantity' AS first_name,
               list_extract({PT_LOW}, ipt + 1)::DOUBLE AS first_low, list_extract({PT_HIGH}, ipt + 1)::DOUBLE AS first_up,
               'l_discount' AS second_name, list_extract({SHAPE.edges[:-1]}, ibin2 + 1)::DOUBLE AS second_low,
               list_extract({SHAPE.edges[1:]}, ibin2 + 1)::DOUBLE AS second_up, 0.5::DOUBLE AS working_point
        FROM (SELECT CAST({sql_first_bin('l_quantity', PT_LOW, PT_HIGH)} AS INTEGER) AS ipt,
                     CAST({sql_bin('l_discount', SHAPE)} - 1 AS INTEGER) AS ibin2 FROM lineitem)
        GROUP BY ipt, ibin2""",
)
def a12(spark, sf):
    h = hist.fill(table(spark, sf, "lineitem"), [("l_quantity", PT), ("l_discount", SHAPE)])
    tagged = hist.with_meta(h, ("l_quantity", PT, "ix"), ("l_discount", SHAPE, "iy"), working_point=0.5)
    return tagged.select((F.col("ix") - 1).alias("ipt"), (F.col("iy") - 1).alias("ibin2"), "content", "meta.*")


@query("A13_incremental_input",
       "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events GROUP BY event_type")
def a13(spark, sf):
    """Ingest the event files, run again (nothing new), report what was stored."""
    out, state = fresh_path(spark, "ingest"), fresh_path(spark, "ingest-state")
    source = table(spark, sf, "events")
    for _ in range(2):
        incremental.ingest(spark, sf, source.schema, out, state, pattern="events.parquet")
    return spark.read.schema(source.schema).parquet(out).groupBy("event_type").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids")
    )


RUN_LISTS = {"calorimeter": range(1, 600, 3), "high_rate": range(2, 300, 2), "all": range(1, 1000)}


@query(
    "A14_run_list",
    f"""SELECT list_name, count(DISTINCT run) AS n_runs, count(*) AS n_events FROM orders
        JOIN ({' UNION ALL '.join(f"SELECT '{name}' AS list_name, unnest(range({r.start}, {r.stop}, {r.step})) AS run" for name, r in RUN_LISTS.items())}) ON o_custkey = run GROUP BY list_name""",
)
def a14(spark, sf):
    runs = scan.run_lists(spark, RUN_LISTS)
    events = table(spark, sf, "orders").select(F.col("o_custkey").alias("run_number"))
    # configured lists, a few hundred runs each
    return events.join(F.broadcast(runs), "run_number").groupBy("list_name").agg(
        F.countDistinct("run_number").alias("n_runs"), F.count("*").alias("n_events")
    )


@query(
    "A15_error_table",
    f"""SELECT source, ibin, round(x_low, 6) AS x_low, round(x_up, 6) AS x_up, round(y_low, 6) AS y_low, round(y_up, 6) AS y_up FROM (
        SELECT 'flag_' || l_returnflag AS source, {sql_bin('l_quantity', PT)} AS ibin, 0.5::DOUBLE AS x_low, 0.5::DOUBLE AS x_up,
               min(l_tax) + avg(l_discount) AS y_low, avg(l_tax) AS y_up FROM lineitem GROUP BY 1, 2
        UNION ALL
        SELECT 'status_' || l_linestatus, {sql_bin('l_quantity', PT)}, 0.5, 0.5, avg(l_discount), avg(l_tax) * 2
        FROM lineitem GROUP BY 1, 2)""",
)
def a15(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("ibin", PT.index("l_quantity"))
    flags = li.groupBy(F.concat(F.lit("flag_"), "l_returnflag").alias("source"), "ibin").agg(
        F.lit(0.5).alias("x_low"), F.lit(0.5).alias("x_up"),
        (F.min("l_tax") + F.avg("l_discount")).alias("y_low"), F.avg("l_tax").alias("y_up"))
    status = li.groupBy(F.concat(F.lit("status_"), "l_linestatus").alias("source"), "ibin").agg(
        F.lit(0.5).alias("x_low"), F.lit(0.5).alias("x_up"),
        F.avg("l_discount").alias("y_low"), (F.avg("l_tax") * 2).alias("y_up"))
    merged = errors_table.read(spark, errors_table.write(errors_table.merge(flags, status), fresh_path(spark, "errors")))
    return merged.select("source", "ibin", *[rounded(c).alias(c) for c in ("x_low", "x_up", "y_low", "y_up")])


@query(
    "A16_simulated_yield",
    f"""WITH sel AS (SELECT {sql_bin('l_discount', SHAPE)} AS ix, {sql_bin('l_extendedprice', Uniform(10, 900.0, 105000.0))} AS iy,
                     {sql_bin('l_quantity', PT)} AS iz FROM lineitem WHERE l_returnflag = 'R' AND l_tax < 0.06 AND l_quantity >= 2)
        SELECT ix, iy, iz, round(count(*) * 70.0 / (SELECT count(*) FROM lineitem), 8) AS content,
               round(count(*) * (70.0 / (SELECT count(*) FROM lineitem)) * (70.0 / (SELECT count(*) FROM lineitem)), 10) AS sumw2
        FROM sel GROUP BY ix, iy, iz""",
)
def a16(spark, sf):
    li = table(spark, sf, "lineitem")
    entries = li.agg((F.lit(70.0) / F.count("*")).alias("scale"))
    h = hist.simulated_yield(
        li, [F.col("l_returnflag") == "R", F.col("l_tax") < 0.06, F.col("l_quantity") >= 2],
        [("l_discount", SHAPE), ("l_extendedprice", Uniform(10, 900.0, 105000.0)), ("l_quantity", PT)], entries,
    )
    return h.select("ix", "iy", "iz", rounded("content", 8).alias("content"), rounded("sumw2", 10).alias("sumw2"))


@query(
    "A17_per_file_selection",
    """SELECT s AS file_label, count(*) AS n, round(avg(l_extendedprice), 4) AS mean_price FROM (
         SELECT 'flag_' || l_returnflag || '_status_' || l_linestatus AS s, * FROM lineitem) t
       WHERE CASE WHEN l_returnflag = 'A' THEN l_quantity > 10 WHEN l_returnflag = 'N' THEN l_discount < 0.055
                  ELSE l_tax > 0.015 AND l_quantity < 40 END
       GROUP BY s""",
)
def a17(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "file_label", F.concat(F.lit("flag_"), "l_returnflag", F.lit("_status_"), "l_linestatus"))
    cuts = {"flag_A": "l_quantity > 10", "flag_N": "l_discount < 0.055", "flag_R": "l_tax > 0.015 and l_quantity < 40"}
    return scan.apply_cut_table(li, F.col("file_label"), cuts).groupBy("file_label").agg(
        F.count("*").alias("n"), rounded(F.avg("l_extendedprice"), 4).alias("mean_price"))
