"""Edge-case rows of the predicates and derived columns."""


import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tallyfield.functions import bits, derive
from tallyfield.functions import predicates as P
from tallyfield.functions.bins import Edges, Uniform, bin_mask, by_width, first_bin, mask_bins, overlapping_bins
from tallyfield.functions.hashing import take_by_hash
from tallyfield.sources import scan, schemas

NAN = float("nan")


@pytest.fixture(scope="module")
def edge(spark):
    data = [(1, 4.999), (2, 5.0), (3, 10.0), (4, 20.0), (5, 20.001), (6, NAN), (7, None)]
    return spark.createDataFrame(data, "k int, x double")


def keys(df):
    return sorted(r.k for r in df.collect())


def test_ranges_drop_nan_and_respect_edges(edge):
    assert keys(edge.where(P.half_open("x", 5, 20))) == [2, 3]
    assert keys(edge.where(P.closed("x", 5, 20))) == [2, 3, 4]
    assert keys(edge.where(P.open_range("x", 5, 20))) == [3]
    assert keys(edge.where(P.gt("x", 5))) == [3, 4, 5]
    assert keys(edge.where(P.ge("x", 5))) == [2, 3, 4, 5]
    assert keys(edge.where(P.eq("x", NAN))) == []


def test_string_predicate_with_nan(spark):
    df = spark.createDataFrame([(1, NAN, 1.0), (2, NAN, 9.0), (3, 7.0, 9.0), (4, 1.0, 9.0)], "k int, a double, b double")
    assert keys(P.select_rows(df, "a > 5 or b < 2")) == [1, 3]
    assert keys(P.select_rows(df, "a > 5")) == [3]
    assert keys(P.select_rows(df, "abs(a) < 5 and b == 9")) == [4]
    assert P.select_rows(df, None) is df
    assert P.select_rows(df, "a > 5").columns == df.columns


def test_string_predicate_reaches_the_reader(spark, tmp_path):
    spark.range(100).selectExpr("id k", "cast(id as double) a", "cast(id as double) b").write.parquet(str(tmp_path / "t"))
    df = P.select_rows(spark.read.parquet(str(tmp_path / "t")), "a > 90").select("k")
    text = plan(df)
    assert "GreaterThan(a,90.0)" in text and "ReadSchema: struct<k:bigint,a:double>" in text
    assert df.count() == 9


def test_bits(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (4096,), (4097,), (35,)], "b int")
    got = [r.b for r in bits.keep(df, "b", on=[0], off=[1]).collect()]
    assert got == [1, 4097]
    assert [r.b for r in bits.keep(df, "b", on=[12]).collect()] == [4096, 4097]
    tags = {r.b: (r.isstd, r.ismcsignal, r.ismcrefl) for r in bits.tag(df, "b", bits.CLASS_TAGS).collect()}
    assert tags[35] == (1, 0, 1) and tags[3] == (1, 1, 0) and tags[0] == (0, 0, 0)


def test_fiducial_boundary(spark):
    limit = -0.2 / 15 * 25 + 1.9 / 15 * 5 + 0.5
    df = spark.createDataFrame([(1, 5.0, 0.79), (2, 5.0, limit + 1e-6), (3, 5.01, 0.79), (4, 5.01, 0.8), (5, 5.0, limit - 1e-6), (6, 6.0, NAN)], "k int, pt double, y double")
    assert keys(df.where(P.fiducial("pt", "y"))) == [1, 3, 5]


def test_pid_ignores_nan(spark):
    df = spark.createDataFrame([(1, NAN, 2.0), (2, NAN, NAN), (3, 4.0, 1.0)], "k int, a double, b double")
    assert keys(df.where(P.any_below(["a", "b"], 3.0))) == [1, 3]


def test_displaced_zero_error(spark):
    base = (0.1, 1.0, 1.0, 2.0, 1.0, 0.0)
    df = spark.createDataFrame([(1, 0.0) + base, (2, 0.1) + base, (3, 0.0, 0.0) + base[1:]], "k int, e0 double, d0 double, d1 double, len double, norm double, pt double, eta double")
    assert keys(df.where(P.displaced(["d0", "d1"], ["e0", F.lit(1.0)], "len", "norm", "pt", "eta"))) == [1, 2]


def test_custom_cuts(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0), (4, None, 1.0)], "k int, b int, x double")
    assert keys(df.where(P.per_bin("b", [None, "x > 2", "x < 2"]))) == [1, 3]
    nan = spark.createDataFrame([(1, 0, NAN), (2, 0, 3.0)], "k int, b int, x double")
    assert keys(nan.where(P.per_bin("b", ["x > 2"], nan))) == [2]
    assert keys(nan.where(P.per_bin("b", ["not x > 2"], nan))) == [1]
    with pytest.raises(ValueError):
        P.require_per_bin([None], 2)


def test_two_class_point_keeps_threshold_edges(spark):
    df = spark.createDataFrame([(1, 0.3, 0.6), (2, 0.31, 0.6), (3, 0.3, 0.59), (4, 0.1, NAN)], "k int, p0 double, p1 double")
    assert keys(df.where(P.working_point(["p0", "p1"], (0.3, 0.6)))) == [1]


def test_clamps_are_idempotent(spark):
    df = spark.createDataFrame([(1, -1.0, 1.0), (2, 2.0, 0.5)], "k int, nsd double, z double")
    once = derive.clamp_high(derive.clamp_low(df, "nsd"), "z")
    twice = derive.clamp_high(derive.clamp_low(once, "nsd"), "z")
    assert rows(once) == rows(twice)
    assert [(r.nsd, r.nsd_orig, r.z, r.z_orig) for r in twice.orderBy("k").collect()] == [(0.0, -1.0, 0.99, 1.0), (2.0, 2.0, 0.5, 0.5)]


def test_momentum_fraction(spark):
    df = spark.createDataFrame([(2.0, 0.3, 0.5), (0.0, 0.0, 0.0)], "pt double, phi double, eta double")
    z = [r.z for r in df.select(derive.momentum_fraction("pt", "phi", "eta", "pt", "phi", "eta").alias("z")).collect()]
    assert z[0] == pytest.approx(1.0) and z[1] is None


def test_axes(spark):
    u, e = Uniform(4, 0.0, 2.0), Edges.of(0, 0.5, 1, 2)
    xs = [-1.0, 0.0, 0.49, 0.5, 1.0, 1.99, 2.0, 3.0, NAN, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "k int, x double")
    got = [(r.u, r.e, r.s) for r in df.select("k", u.index("x").alias("u"), e.index("x").alias("e"), e.index("x", strict=True).alias("s")).orderBy("k").collect()]
    assert [g[0] for g in got] == [0, 1, 1, 2, 3, 4, 5, 5, 5, None]
    assert [g[1] for g in got] == [0, 1, 1, 2, 3, 3, 4, 4, 4, None]
    assert [g[2] for g in got][:8] == [0, 0, 1, 1, 2, 3, 3, 4]
    for x in xs[:8]:
        assert u.find(x) == got[xs.index(x)][0] and e.find(x) == got[xs.index(x)][1]
    assert by_width(1.72, 2.05, 0.001).n == 330


def test_overlapping_bins(spark):
    lows, highs = [0, 1, 1, 10, 30, 60], [9999, 9999, 9, 29, 59, 100]
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 9.0), (3, 9.5), (4, 29.0), (5, 100.0), (6, -1.0), (7, NAN)], "k int, x double")
    got = {r.k: (r.a, r.m) for r in df.select("k", overlapping_bins("x", lows, highs).alias("a"), mask_bins(bin_mask("x", lows, highs), 6).alias("m")).collect()}
    assert got[0][0] == [0] and got[1][0] == [0, 1, 2] and got[2][0] == [0, 1, 2] and got[3][0] == [0, 1] and got[5][0] == [0, 1, 5] and got[6][0] == [] and got[7][0] == []
    assert all(a == m for a, m in got.values())


def test_first_bin(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (0.5,), (3.0,)], "x double")
    assert [r.b for r in df.select(first_bin("x", [1, 2], [2, 3]).alias("b")).collect()] == [0, 1, None, None]


@pytest.mark.parametrize("n", [0, 1, 7, 500, 5000])
def test_take_by_hash_equals_a_global_sort(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    digest = F.md5(F.concat_ws("|", F.lit("3"), F.col("k").cast("string")))
    want = [r.k for r in df.orderBy(digest, "k").limit(n).collect()]
    assert sorted(want) == sorted(r.k for r in take_by_hash(df, ["k"], 3, n=n).collect())


def test_take_by_hash_tail(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    digest = F.md5(F.concat_ws("|", F.lit("3"), F.col("k").cast("string")))
    want = [r.k for r in df.orderBy(digest.desc(), "k").limit(round(1001 * 0.25)).collect()]
    assert sorted(want) == sorted(r.k for r in take_by_hash(df, ["k"], 3, fraction=0.25, tail=True).collect())


def test_scan_checks_and_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id a", "id b", "id c").write.parquet(path)
    assert "ReadSchema: struct<a:bigint>" in plan(scan.scan(spark, path, ["a"]))
    with pytest.raises(ValueError, match="missing columns: z"):
        scan.scan(spark, path, ["a", "z"])
    assert set(schemas.EVENT_KEY) <= set(schemas.EVENTS.fieldNames())


def test_file_tree(spark, tmp_path):
    for d in ("a/001", "a/002", "b/001"):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / d))
    files = scan.find_files(spark, str(tmp_path), "*.parquet")
    assert len(files) == 3 and files == sorted(files)
    assert len(scan.find_files(spark, str(tmp_path), "*.parquet", select=["/a/"])) == 2
    assert len(scan.find_files(spark, str(tmp_path), "*.parquet", max_files=1)) == 1
    assert scan.scan_tree(spark, str(tmp_path), "*.parquet", ["/a/"]).select("file_id").distinct().count() == 2


def test_cut_table_rejects_unknown_files(spark):
    df = spark.createDataFrame([("pt_1_2", 1.0), ("pt_2_4", 5.0)], "f string, x double")
    assert scan.apply_cut_table(df, F.col("f"), {"pt_1": "x > 0", "pt_2": "x > 9"}).count() == 1
    nan = spark.createDataFrame([("pt_1", NAN), ("pt_1", 5.0)], "f string, x double")
    assert scan.apply_cut_table(nan, F.col("f"), {"pt_1": "x > 1.5"}).count() == 1
    with pytest.raises(Exception, match="no selection configured"):
        scan.apply_cut_table(df, F.col("f"), {"pt_1": "x > 0"}).count()


def test_curve_with_blanks(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("pt, central, min, max\n 0.5, 1.5, 1.0, 2.0\n 1.0, 2.5, 2.0, 3.0\n")
    assert rows(scan.read_curve(spark, str(p))) == [(0.5, 1.5, 1.0, 2.0), (1.0, 2.5, 2.0, 3.0)]


@pytest.mark.parametrize("n", [3, 250, 299, 500])
def test_take_by_hash_with_a_hot_copy(spark, n):
    """A third of the rows are copies of one row; the count stays exact and nothing is ranked row by row."""
    from tallyfield.functions import hashing

    df = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("k"))
    digest = F.md5(F.concat_ws("|", F.lit("1"), F.col("k").cast("string")))
    want = sorted(r.k for r in df.orderBy(digest, "k").limit(n).collect())
    old, hashing.COPIES_PER_TASK = hashing.COPIES_PER_TASK, 30
    try:
        assert want == sorted(r.k for r in take_by_hash(df, ["k"], 1, n=n).collect())
        if n == 250:
            got = sorted(r.k for r in take_by_hash(df, ["k"], 1, fraction=n / 300).collect())
            assert got == want
    finally:
        hashing.COPIES_PER_TASK = old


@pytest.mark.parametrize("query, want", [
    ("x > 1.5", [2]), ("not x > 1.5", [1, 3]), ("x != 1", [1, 2]), ("x == 1", [3]), ("not (x > 0 and k > 0)", [1]),
    ("not x between 0 and 2", [1, 2]), ("x > 1.5 or k == 1", [1, 2]), ("not not x > 1.5", [2]), ("x >= @low and name != 'not x'", [2, 3]), ("k in (1, 3) and not x < 5", [1]),
])
def test_nan_in_conditions_as_in_pandas(spark, query, want):
    df = spark.createDataFrame([(1, NAN, "a"), (2, 3.0, "b"), (3, 1.0, "c")], "k int, x double, name string")
    assert keys(P.select_rows(df, query, {"low": 1})) == want
