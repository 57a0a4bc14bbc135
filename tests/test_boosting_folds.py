"""Adaptive boosting, stratified folds and reweighted counters against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallyfield.operators import boosting, evaluate, hist, ranks


def plain_boosting(data, rounds):
    """data: (features, label); the purest cut over all features, then heavier misses."""
    w = [1.0 / len(data)] * len(data)
    out = []
    for _ in range(rounds):
        best = None
        for f in range(len(data[0][0])):
            values = sorted({x[f] for x, _ in data})
            for a, b in zip(values, values[1:]):
                t, gini, miss, votes = (a + b) / 2, 0.0, 0.0, []
                for side in (True, False):
                    p = sum(wi for wi, (x, y) in zip(w, data) if (x[f] < t) == side and y == 1)
                    n = sum(wi for wi, (x, y) in zip(w, data) if (x[f] < t) == side and y != 1)
                    gini += p * n / (p + n)
                    votes.append(1 if round((p - n) / sum(w), 12) > 0 else -1)
                    miss += n if votes[-1] > 0 else p
                key = (round(gini / sum(w), 12), f, t)
                if best is None or key < best[0]:
                    best = (key, f, t, votes, miss / sum(w))
        _, f, t, votes, error = best
        alpha = math.log((1 - error) / error)
        out.append((f, t, *votes, alpha))
        w = [wi * (math.exp(alpha) if votes[0 if x[f] < t else 1] != (1 if y == 1 else -1) else 1.0) for wi, (x, y) in zip(w, data)]
    return out


def test_boosting_equals_plain_python(spark):
    rnd = random.Random(5)
    data = []
    for _ in range(300):
        x = (rnd.randint(0, 9), rnd.randint(0, 5))
        data.append((x, int(rnd.random() < (0.8 if (x[0] > 4) != (x[1] > 3) or x[0] == 9 else 0.2))))
    df = spark.createDataFrame([(*map(float, x), y) for x, y in data], "a double, b double, label int")
    model = boosting.adaptive_boosting(df, ["a", "b"], "label", 6)
    want = plain_boosting(data, 6)
    assert [(("a", "b").index(s.feature), s.threshold, s.left, s.right) for s in model.stumps] == [w[:4] for w in want]
    assert [s.alpha for s in model.stumps] == pytest.approx([w[4] for w in want], abs=1e-9)
    total = sum(w[4] for w in want)
    for r in model.score(df, "B").limit(40).collect():
        d = sum(w[4] / total * (w[2] if (r.a, r.b)[w[0]] < w[1] else w[3]) for w in want)
        assert r.y_test_probB == pytest.approx(1 / (1 + math.exp(-2 * d)), abs=1e-12)
        assert r.y_test_predictionB == float(round(d, 12) > 0)


def test_boosting_beats_one_stump_on_a_staircase(spark):
    df = spark.range(2000).select((F.col("id") % 100 / 100).alias("a"), F.rand(3).alias("noise"))
    df = df.withColumn("label", ((F.col("a") > 0.2) & (F.col("a") < 0.5)).cast("int"))
    one, many = (boosting.adaptive_boosting(df, ["noise", "a"], "label", n).score(df, "") for n in (1, 12))
    area = [evaluate.area_under_curve(s, "label", "y_test_prob").first().auc for s in (one, many)]
    assert area[1] > 0.95 > area[0]


def test_boosting_on_odd_tables(spark):
    shape = "a double, `a b.c` double, label int"
    assert boosting.adaptive_boosting(spark.createDataFrame([], shape), ["a"], "label").stumps == []
    constant = spark.createDataFrame([(1.0, 2.0, 0), (1.0, 2.0, 1)], shape)
    model = boosting.adaptive_boosting(constant, ["a", "a b.c"], "label")
    assert model.stumps == [] and model.score(constant, "").select("y_test_prob").distinct().first()[0] == 0.5
    nan = float("nan")
    odd = spark.createDataFrame([(None, 1.0, 1), (nan, 1.0, 1), (float("inf"), 1.0, 1), (0.0, 1.0, 0), (1.0, 1.0, 0), (2.0, 1.0, 1), (0.0, 3.0, None)] * 3, shape)
    model = boosting.adaptive_boosting(odd, ["a b.c", "a"], "label")
    assert [(s.feature, s.threshold, s.left, s.right, s.alpha) for s in model.stumps] == [("a", 1.5, -1, 1, 1.0)]
    assert model.score(odd.where("label is not null"), "").where("y_test_prediction <> label").count() == 0
    # weights: a row that counts for nothing changes nothing
    heavy = odd.withColumn("w", F.when(F.col("a") == 0, 0.0).otherwise(2.0))
    assert len(boosting.adaptive_boosting(heavy, ["a"], "label", weight="w").stumps) == 1


@pytest.mark.parametrize("range_rows, copies", [(100_000, 100_000), (40, 7)])
def test_places_have_no_gaps(spark, range_rows, copies):
    data = [(k % 200, k, "x") for k in range(600)] + [(7, 7, "hot")] * 300 + [(9, 1000 + k, "hot") for k in range(200)] + [(None, None, None)] * 50
    df = spark.createDataFrame(data, "k int, v int, label string")
    placed = ranks.shuffled_places(df, ["label"], ["k"], 1, range_rows=range_rows, copies=copies)
    got = rows(placed)
    assert sorted(r[:3] for r in got if r[0] is not None) == sorted(d for d in data if d[0] is not None) and len(got) == len(data)
    for label in ("x", "hot", None):
        assert sorted(r[3] for r in got if r[2] == label) == list(range(sum(d[2] == label for d in data)))
    # the order is that of the key hash, whatever the number of ranges
    again = rows(ranks.shuffled_places(df.repartition(7), ["label"], ["k"], 1))
    assert again == got


def test_folds_differ_by_one_row_per_class(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") < 700, "a").when(F.col("id") < 1001, "b").alias("label"))
    n = ranks.stratified_folds(df, "label", ["id"], 4, 3).groupBy("label", "fold").count().collect()
    for label in ("a", "b", None):
        sizes = [r["count"] for r in n if r.label == label]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == {"a": 700, "b": 301, None: 2}[label]
    assert ranks.stratified_folds(df.limit(0), "label", ["id"], 4).columns == ["id", "label", "fold"]
    assert ranks.stratified_folds(df.limit(0), "label", ["id"], 4).count() == 0


def test_reweighted_counters(spark):
    df = spark.createDataFrame([(1, 5.0, 2.0, True), (1, 5.0, None, True), (1, 15.0, 3.0, False), (2, 15.0, 0.5, True)], "g int, m double, w double, ok boolean")
    out = hist.reweighted_counts_by_class(df, ["g"], {"all": F.lit(True), "ok": F.col("ok")}, "w", ("m", [0.0, 0.0, 10.0], [20.0, 9.0, 20.0]), [False, True, True])
    got = {(r.g, r.ibin2): (r["all"], r.all_err, r.ok, r.ok_err) for r in out.collect()}
    assert got == {(1, 0): (3.0, math.sqrt(3), 2.0, math.sqrt(2)), (2, 0): (1.0, 1.0, 1.0, 1.0), (1, 1): (2.0, 2.0, 2.0, 2.0),
                   (1, 2): (3.0, 3.0, 0.0, 0.0), (2, 2): (0.5, 0.5, 0.5, 0.5)}


def test_places_sort_the_rows_once(spark):
    """Ranges are numbered where they are written: what reads them neither shuffles nor sorts their rows."""
    df = spark.range(500).selectExpr("id % 90 k", "id v", "'x' label")
    text = ranks.shuffled_places(df, ["label"], ["k"], 1, range_rows=40)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "Sort" not in text and "Union" not in text
