"""Queries against their SQL on small tables made for one case each."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyfield.operators import joins, learners

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import check  # noqa: E402


def agree(spark, folder, key, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    df = contract.queries()[key](spark, str(folder))
    mine = sorted(tuple(check.plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    res = con.execute(contract.oracle_sql()[key])
    names = [d[0] for d in res.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    other = sorted(tuple(check.plain(r[i]) for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(names) and mine == other
    return mine


def priced(spark, n, lines=2):
    """Prices over the whole axis and beyond both ends."""
    return spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % lines + 1).cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"), (F.col("id") * 7919 % 106000).cast("double").alias("l_extendedprice"),
        F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"))


def test_bins_are_kept_as_they_are_where_they_hold_enough(spark, tmp_path):
    rows = priced(spark, 90_000)
    rows = rows.unionByName(rows.where("l_orderkey < 2000").withColumn("l_linenumber", F.lit(3)))  # this one is joined by 20
    out = agree(spark, tmp_path, "E16_adaptive_rebin", lineitem=rows)
    assert {r[1] for r in out} == {"1", "20"}


def test_background_counts_prices_beyond_the_axis(spark, tmp_path):
    out = agree(spark, tmp_path, "K28_background_scan", lineitem=priced(spark, 3000, 7))
    assert sum(float(dict(zip(("bkg", "bkg_err", "step", "threshold"), r))["bkg"]) > 0 for r in out) > 40


def test_significance_with_prices_beyond_the_axis(spark, tmp_path):
    rows = priced(spark, 3000, 7).withColumn("l_returnflag", F.substring(F.lit("ANR"), (F.col("l_orderkey") % 3 + 1).cast("int"), F.lit(1)))
    part = spark.range(50).select(F.col("id").alias("p_partkey"), F.col("id").cast("int").alias("p_size"), (F.col("id") * 1.5e6).cast("double").alias("p_retailprice"))
    agree(spark, tmp_path, "K30_significance_scan", lineitem=rows, part=part)


def scanned(spark, tmp_path, rows):
    """K27 to K31 share the scan over thresholds; all of them against their SQL."""
    part = spark.range(50).select(F.col("id").alias("p_partkey"), F.col("id").cast("int").alias("p_size"), (F.col("id") * 1.5e6).cast("double").alias("p_retailprice"))
    keys = ("K27_signal_efficiency", "K28_background_scan", "K29_expected_signal", "K30_significance_scan", "K31_acceptance")
    return {key: agree(spark, tmp_path / key, key, lineitem=rows, part=part) for key in keys}


def returned(spark, n=3000):
    return priced(spark, n, 7).withColumn("l_returnflag", F.substring(F.lit("ANR"), (F.col("l_orderkey") % 3 + 1).cast("int"), F.lit(1)))


@pytest.mark.parametrize("price, nan", [(6105.0, True), (20_000.0, False)])
def test_thresholds_with_copies_of_one_row(spark, tmp_path, price, nan):
    """Six copies of a row pass the last thresholds: no line goes through their one bin; the SQL says NaN, or rounds to a level one."""
    lone = returned(spark, 1).withColumns({"l_quantity": F.lit(54.0), "l_linenumber": F.lit(7), "l_extendedprice": F.lit(price), "l_returnflag": F.explode(F.split(F.lit("A,R"), ","))})
    rows = returned(spark).unionByName(lone.crossJoin(spark.range(6)).drop("id"))
    out = scanned(spark, tmp_path, rows)
    assert all(any("nan" in r for r in out[key]) == nan for key in ("K28_background_scan", "K30_significance_scan"))


def test_thresholds_when_all_prices_share_a_bin(spark, tmp_path):
    scanned(spark, tmp_path, returned(spark).withColumn("l_extendedprice", F.lit(2000.0)))


def test_thresholds_of_missing_scores(spark, tmp_path):
    """NULL passes no threshold, NaN lies above all of them; both count among all."""
    odd = F.when(F.col("l_orderkey") % 40 == 0, None).when(F.col("l_orderkey") % 41 == 0, float("nan")).otherwise(F.col("l_quantity"))
    scanned(spark, tmp_path, returned(spark).withColumn("l_quantity", odd))


def test_thresholds_without_a_signal_row_or_an_accepted_one(spark, tmp_path):
    for flag in "RA":
        scanned(spark, tmp_path / flag, returned(spark, 300).where(F.col("l_returnflag") != flag))


def test_first_component_is_the_rising_diagonal(spark, tmp_path):
    rows = priced(spark, 3000).withColumn("l_extendedprice", 50_000.0 - 3 * F.col("l_quantity") + F.col("l_extendedprice") / 1000)
    assert rows.corr("l_quantity", "l_extendedprice") < 0
    agree(spark, tmp_path, "K24_two_components", lineitem=rows)


def test_nearly_uncorrelated_columns_keep_their_diagonals(spark):
    """One stray row in 10,000 decides the coefficient; the axes stay at 45 degrees to the last digit."""
    df = spark.range(10_000).select((F.col("id") % 100).cast("double").alias("a"), F.expr("cast(id div 100 as double)").alias("b"))
    for extra in ((), ((50.5, 49.50001),), ((49.5001, 49.5001),)):
        some = df.unionByName(spark.createDataFrame(list(extra), "a double, b double")) if extra else df
        for share, (a, b) in learners.correlation_axes(learners.standardise(some, ["a", "b"]), ["a", "b"]):
            assert abs(abs(a) - 0.5**0.5) < 1e-15 and abs(abs(b) - 0.5**0.5) < 1e-15 and abs(share - 0.5) < 1e-6


def test_axes_of_three_columns(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (2.0 * F.col("id") + 1).alias("b"), (F.col("id") * 37 % 200).cast("double").alias("c"))
    (first, axis), (second, _), (third, _) = learners.correlation_axes(df, ["a", "b", "c"])
    assert abs(first + second + third - 1) < 1e-12 and first >= second >= third and abs(third) < 1e-12
    assert abs(axis[0] - axis[1]) < 1e-9 and abs(sum(v * v for v in axis) - 1) < 1e-12


def test_tables_are_dealt_by_their_rows(spark):
    """Ten times the rows: ten times the tasks, each as large as before; nothing merges them again."""
    df = spark.range(1000).withColumn("k", F.col("id") % 100)
    n = spark.sparkContext.defaultParallelism
    sizes = [joins.dealt(df, ["k"], rows).rdd.getNumPartitions() for rows in (10, 100 * joins.TASK_ROWS, 1000 * joins.TASK_ROWS)]
    assert sizes == [n, 100, 1000]


def test_distribution_job_of_orders_with_many_items(spark, tmp_path):
    rows = priced(spark, 4000).withColumns({"l_orderkey": F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_orderkey") % 900),
                                            "l_discount": F.col("l_orderkey") % 11 / 100})
    orders = spark.range(1000).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.substring(F.lit("FOP"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("o_orderstatus"),
        (F.col("id") * 457.0).alias("o_totalprice"), F.expr("timestamp_ntz'1995-01-01' + make_dt_interval(cast(id % 900 as int))").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    plan = contract.queries()["E31_distribution_job"]
    out = agree(spark, tmp_path, "E31_distribution_job", lineitem=rows, orders=orders)
    text = plan(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert out and text.count("REPARTITION_BY_NUM") == 2 and text.count("Exchange hashpartitioning(l_orderkey") == 2
