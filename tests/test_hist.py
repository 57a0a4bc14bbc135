"""Joins, histograms and scans: edge cases, properties and plans."""

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tallyfield.functions.bins import Edges, Uniform
from tallyfield.operators import hist, joins, samples, scans
from tallyfield.sources import errors_table, layout

NAN = float("nan")


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(2000).select(
        F.col("id").alias("k"), (F.rand(3) * 12 - 1).alias("x"), (F.rand(4) * 3).alias("y"), F.rand(5).alias("w"), (F.col("id") % 3).alias("g")).cache()


AX, AY = Edges.of(0, 1, 2.5, 4, 10), Uniform(3, 0.0, 3.0)


def test_total_with_flow_equals_rows(data):
    h = hist.fill(data, [("x", AX), ("y", AY)], ["g"])
    assert h.agg(F.sum("content")).first()[0] == 2000


def test_merge_of_parts_equals_one_pass(data):
    one = hist.fill(data, [("x", AX)], weight="w")
    parts = hist.merge(*[hist.fill(data.where(F.col("g") == i), [("x", AX)], weight="w") for i in range(3)])
    a, b = rows(one), rows(parts.select(*one.columns))
    assert [r[0] for r in a] == [r[0] for r in b]
    assert [r[1] for r in a] == pytest.approx([r[1] for r in b]) and [r[2] for r in a] == pytest.approx([r[2] for r in b])


def test_projection_and_rebin_agree(data):
    h2 = hist.fill(data, [("x", AX), ("y", AY)])
    assert rows(hist.project(h2, ["ix"])) == rows(hist.fill(data, [("x", AX)]))
    fine, coarse = Uniform(20, 0.0, 10.0), Edges.of(0, 1, 2.5, 4, 10)
    assert rows(hist.rebin(hist.fill(data, [("x", fine)]), fine, coarse)) == rows(hist.fill(data, [("x", coarse)]))
    with pytest.raises(ValueError):
        hist.coarse_bins(fine, Edges.of(0, 1.3, 10))


def test_zero_fill_keeps_empty_bins(spark):
    df = spark.createDataFrame([("a", 0.5)], "g string, x double")
    groups = spark.createDataFrame([("a",), ("b",)], "g string")
    h = hist.zero_fill(hist.fill(df, [("x", AX)], ["g"]), groups, ["g"], [AX])
    assert h.count() == 8 and h.agg(F.sum("content")).first()[0] == 1


def test_nan_goes_to_overflow(spark):
    df = spark.createDataFrame([(NAN,), (None,), (0.5,)], "x double")
    assert rows(hist.fill(df, [("x", AX)]).select("ix", "content")) == [(1, 1.0), (5, 1.0)]


def test_spectra_in_overlapping_bins_equal_the_exploded_form(data):
    lows, highs = [0, 1, 1, 2], [99, 99, 2, 3]
    fast = hist.spectra_in_bins(data, ("x", AX), ["g"], "y", lows, highs)
    slow = hist.fill(joins.explode_bins(data, "y", lows, highs), [("x", AX)], ["g", "ibin2"])
    assert rows(fast.select("g", "ibin2", "ix", "content")) == rows(slow.select("g", "ibin2", "ix", "content"))


def test_weights(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 4.0), (3, 2.0)], "k int, w double")
    assert [r[0] for r in df.select(hist.inverse_weight("w")).collect()] == [1.0, 0.25, 0.5]
    h = spark.createDataFrame([(1, 5.0)], "ix int, content double")
    assert [r.v for r in joins.lookup_content(df.withColumn("ix", F.col("k")), h, ["ix"], "v", 0.0).orderBy("k").collect()] == [5.0, 0.0, 0.0]


def test_event_norm(spark):
    df = spark.createDataFrame([(10, 4, 2), (0, 3, 0)], "s long, n long, o long")
    got = [r[0] for r in df.select(hist.event_norm(F.col("s"), F.col("n"), F.col("o"))).collect()]
    assert got[0] == pytest.approx(14 - 8 / 12) and got[1] == -1.0


def test_norm_parts(spark):
    df = spark.createDataFrame([("p", 0), ("p", 1), ("p", 2), ("p", 8), ("p", 10), ("p", 4096)], "p string, rej int")
    r = hist.norm_parts(df, "rej", F.col("rej") == 0, ["p"]).first()
    assert (r.n_sel, r.n_no_vertex, r.n_vertex_out) == (1, 3, 1)


def test_rebin_factor(spark):
    h = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 1000.0), ("c", 1, 0.0), ("d", 1, 40.0)], "g string, ix int, content double")
    got = {r.g: r.factor for r in hist.rebin_factor(h, ["g"], 10, 9, hi=6).collect()}
    assert got == {"a": 6, "b": None, "c": None, "d": 3}
    assert {r.g: r.factor for r in hist.rebin_factor(h, ["g"], 10, 9, hi=6, lo=2).collect()}["b"] == 2


def test_join_keeps_the_file_apart(spark):
    ev = spark.createDataFrame([("f1", 1, 10.0), ("f2", 1, 20.0), ("f1", 2, 30.0)], "file_id string, ev long, v double")
    ca = spark.createDataFrame([("f1", 1, 0.1), ("f2", 1, 0.2), ("f2", 9, 0.3)], "file_id string, ev long, x double")
    out = joins.join_events(ca, ev, ["file_id", "ev"], ["v"])
    assert rows(out.select("file_id", "x", "v")) == [("f1", 0.1, 10.0), ("f2", 0.2, 20.0)]


def test_bucketed_join_needs_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = layout.write_bucketed(spark.range(100).selectExpr("id ev", "id x"), "buck_a", ["ev"], 4)
        b = layout.write_bucketed(spark.range(100).selectExpr("id ev", "id v"), "buck_b", ["ev"], 4)
        out = joins.join_events(a, b, ["ev"], ["v"])
        assert out.count() == 100
        assert "Exchange" not in out._jdf.queryExecution().sparkPlan().toString() and "Exchange hashpartitioning" not in plan(out)
    finally:
        spark.sql("drop table if exists buck_a")
        spark.sql("drop table if exists buck_b")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_event_is_split(spark):
    """A third of the candidates on one event: the skew join divides it, nothing is lost."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ca = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("ev"), F.rand(1).alias("x"))
        ev = spark.range(60000).select(F.col("id").alias("ev"), F.rand(2).alias("v"))
        out = joins.join_events(ca, ev, ["ev"], ["v"])
        assert len(out.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_suffixes(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    assert joins.join_suffixed(a, a, ["k"]).columns == ["k", "v_x", "v_y"]


def test_one_sided_period_fails(spark):
    a = spark.createDataFrame([("p1", 1, 1.0, 1.0)], "period string, ix int, content double, sumw2 double")
    b = spark.createDataFrame([("p2", 1, 1.0, 1.0)], "period string, ix int, content double, sumw2 double")
    assert joins.match_periods(a, a, ["period", "ix"]).count() == 1
    with pytest.raises(Exception, match="without partner"):
        joins.match_periods(a, b, ["period", "ix"]).count()
    # an empty bin of a known period is 0
    more = a.unionByName(spark.createDataFrame([("p1", 2, 3.0, 3.0)], a.schema))
    got = {r.ix: (r.data, r.mc) for r in joins.match_periods(more, a, ["period", "ix"]).collect()}
    assert got == {1: (1.0, 1.0), 2: (3.0, 0.0)}


def test_different_binning_fails(spark):
    a = spark.createDataFrame([(1, 0.0, 1.0, 1.0, 1.0)], "ix int, x_low double, x_up double, content double, sumw2 double")
    assert joins.same_binning(a, a, ["ix"]).count() == 1
    with pytest.raises(Exception, match="different binning"):
        joins.same_binning(a, a.withColumn("x_up", F.lit(2.0)), ["ix"]).collect()
    more = a.unionByName(spark.createDataFrame([(2, 1.0, 2.0, 5.0, 5.0)], a.schema))
    got = {r.ix: (r.x_low, r.a_content, r.b_content) for r in joins.same_binning(a, more, ["ix"]).collect()}
    assert got == {1: (0.0, 1.0, 1.0), 2: (1.0, 0.0, 5.0)}


def test_automatic_ranges_are_finite(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (NAN,), (float("inf"),)], "x double")
    got = {r.ix: (r.lo, r.hi, r.content) for r in hist.auto_hist(df, ["x"], n=2).collect()}
    assert got == {1: (1.0, 3.0, 1.0), 2: (1.0, 3.0, 2.0)}


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("v"), F.lit("c").alias("c"))
    out = scans.first_per_key(df, ["k"], ["v"])
    assert out.columns == df.columns and out.count() == 601
    assert out.where("k = 0").first().v == -299
    assert "Window" not in plan(out)


def test_duplicates(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", 1), ("f1", 2), ("f2", 1)], "f string, k int")
    assert rows(scans.duplicate_summary(df, "f", ["k"])) == [("f1", 3, 2, 1, pytest.approx(200 / 3)), ("f2", 1, 0, 0, 0.0)]
    assert rows(scans.duplicate_rows(df, ["f", "k"])) == [("f1", 1, 2), ("f1", 1, 2)]


def test_cut_scan_against_brute_force(data):
    got = {(r.variable, r.step): r for r in scans.cut_scan(data, {"x": "lt", "y": "st", "w": "absst"}, {"w": 0.4}).collect()}
    cols = {"x": [r.x for r in data.collect()], "y": [r.y for r in data.collect()], "w": [abs(r.w - 0.4) for r in data.collect()]}
    assert len(got) == 300
    for v, values in cols.items():
        lo, hi = min(values), max(values)
        for k in range(100):
            thr = lo + (hi - lo) / 100 * (k if v == "x" else k + 1)
            n = sum(a > thr for a in values) if v == "x" else sum(a < thr for a in values)
            assert got[v, k].share == pytest.approx(n / 2000), (v, k)


def test_probability_scan_against_brute_force(data):
    cuts = [0.5, 0.1]
    got = {(r.ix, r.threshold): r.content for r in scans.probability_scan(data, ["x"], "w", cuts, n=10).collect()}
    kept = [(r.x, r.w) for r in data.collect() if r.w > 0.1]
    lo, hi = min(x for x, _ in kept), max(x for x, _ in kept)
    for c in cuts:
        counts = [0] * 10
        for x, w in kept:
            if w > c:
                counts[min(int(10 * (x - lo) / (hi - lo)), 9)] += 1
        assert [got[i + 1, c] for i in range(10)] == counts


def test_trials_in_one_scan(data):
    out = joins.count_trials(data, ["g"], {f"t{i}": F.col("w") > i / 10 for i in range(10)})
    text = plan(out)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Expand" in text or "Generate" in text
    assert out.count() == 30 and out.where("trial = 't0'").agg(F.sum("content")).first()[0] == 2000


def test_training_set_caps_at_the_size(spark):
    sig = spark.range(10).selectExpr("id k", "1 as flag")
    bkg = spark.range(100, 103).selectExpr("id k", "1 as flag")
    out = samples.training_set(sig, bkg, ["k"], 4, 50, 1, zero_on_background=["flag"])
    assert {(r.signal, r.flag): r["count"] for r in out.groupBy("signal", "flag").count().collect()} == {(1, 1): 4, (0, 0): 3}


def test_tof_border(spark):
    df = spark.createDataFrame([("a", -998.0), ("a", -999.0), ("a", 0.0), ("a", NAN)], "g string, t double")
    assert rows(samples.tof_split(df, ["g"], "t")) == [("a", 1, 1)]
    assert rows(samples.tof_split(df, ["g"], "absent")) == [("a", None, None)]


def test_error_tables_reject_a_source_given_twice(spark):
    t = spark.createDataFrame([("cut", 1, 0.5, 0.5, 0.1, 0.1)], errors_table.ERROR_TABLE)
    assert errors_table.merge(t, t.withColumn("source", F.lit("pid"))).count() == 2
    with pytest.raises(Exception, match="given twice"):
        errors_table.merge(t, t).collect()


def test_skimmed_table_prunes_partitions(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id as double) pt")
    t = layout.write_skimmed(layout.with_skim_bin(df, "pt", [0, 50], [50, 90]), str(tmp_path / "s"), files_per_bin=2)
    assert t.count() == 90
    one = t.where("skim_bin = 1")
    assert "PartitionFilters: [isnotnull(skim_bin" in plan(one) and one.count() == 40


def test_correlations(data):
    out = scans.correlations(data.withColumn("z", -F.col("x")), ["x", "y", "z"], ["g"])
    assert out.count() == 9
    assert all(r["corr"] == pytest.approx(-1.0) for r in out.where("a = 'x' and b = 'z'").collect())


def test_co_moments(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    g, w, x = rng.integers(0, 3, 300), rng.uniform(0.1, 2, 300), rng.normal(1e6, 1.0, (300, 3))
    df = spark.createDataFrame([(int(a), float(b), *map(float, v)) for a, b, v in zip(g, w, x)] + [(0, 1.0, None, 1.0, 2.0), (1, 1.0, float("nan"), 1.0, 2.0), (2, 0.0, 1.0, 1.0, 2.0)],
                               "g int, w double, x double, y double, z double")
    out = {(r.g, r.a, r.b): r for r in scans.co_moments(df, ["x", "y", "z"], ["g"], "w").collect()}
    assert len(out) == 18
    for k in range(3):
        c = np.cov(x[g == k].T, aweights=w[g == k], ddof=0)
        for i, a in enumerate("xyz"):
            for j, b in enumerate("xyz"):
                if i <= j:
                    assert out[k, a, b].cov == pytest.approx(c[i, j], abs=1e-8) and out[k, a, b].n == (g == k).sum()
    assert scans.correlations(df.where("false"), ["x", "y"], ["g"]).count() == 0
    flat = scans.correlations(df.withColumn("y", F.lit(3.0)), ["x", "y"], ["g"]).collect()
    assert len(flat) == 3 and all(r["corr"] is None for r in flat)
