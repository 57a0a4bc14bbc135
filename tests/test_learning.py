"""Models, curves, scans, streaming input and variations."""

import random

import pytest
from pyspark.sql import functions as F

from tallyfield.functions.bins import Uniform
from tallyfield.operators import attribution, evaluate, learners, variations
from tallyfield.session import fresh_path
from tallyfield.streaming import incremental

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def separable(spark):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("label"))
    return df.withColumn("a", F.col("label") * 2 + F.randn(1)).withColumn("b", F.randn(2)).cache()


ESTIMATORS = {
    "forest": lambda: learners.random_forest(depth=3, trees=8), "boosted": lambda: learners.boosted_trees(depth=2, rounds=4),
    "tree": lambda: learners.decision_tree(depth=3), "network": lambda: learners.neural_network(2, hidden=4, rounds=30),
}


@pytest.mark.parametrize("name", list(ESTIMATORS))
def test_classifiers_beat_chance(separable, name):
    model = learners.train(separable.where("k < 300"), FEATURES, ESTIMATORS[name]())
    s = learners.score(separable.where("k >= 300"), model, name)
    assert evaluate.area_under_curve(s, "label", f"y_test_prob{name}").first().auc > 0.8
    assert s.where(f"y_test_prob{name} < 0 or y_test_prob{name} > 1").count() == 0
    assert s.count() == 100


def test_penalties(spark):
    df = spark.range(200).select(F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("label", 3 * F.col("a") + 1)
    plain = learners.train(df, FEATURES, learners.linear_regression()).stages[-1].coefficients
    lasso = learners.train(df, FEATURES, learners.linear_regression(0.3, "lasso")).stages[-1].coefficients
    ridge = learners.train(df, FEATURES, learners.linear_regression(0.3, "ridge")).stages[-1].coefficients
    assert plain[0] == pytest.approx(3.0, abs=1e-6) and lasso[1] == 0.0 and 0 < ridge[0] < 3


def test_save_and_load_per_bin(spark, separable, tmp_path):
    df = separable.withColumn("skim_bin", (F.col("k") % 4 > 1).cast("int"))
    models = {}
    for b in (0, 1):
        m = learners.train(df.where(F.col("skim_bin") == b), FEATURES, learners.decision_tree(2))
        models[b] = learners.load(learners.save(m, str(tmp_path), "tree", f"_{b}"))
    out = learners.apply_per_bin(df, models, "T", {0: 0.5, 1: 0.9})
    assert out.where("skim_bin = 0 and y_test_probT <= 0.5").count() == 0
    assert out.where("skim_bin = 1 and y_test_probT <= 0.9").count() == 0
    two = learners.apply_per_bin(df, models, "T", {0: (0.5, 0.5), 1: (0.5, 0.5)}, labels=["bkg", "sig"])
    assert two.where("y_test_probTsig < 0.5").count() == 0


def brute_auc(pairs):
    pos, neg = [s for s, l in pairs if l], [s for s, l in pairs if not l]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_score_curve_against_brute_force(spark):
    rnd = random.Random(2)
    pairs = [(round(rnd.random(), 2) if i % 3 else 0.5, rnd.random() < 0.4) for i in range(600)]  # a third at one score
    df = spark.createDataFrame([(s, int(l)) for s, l in pairs], "s double, label int")
    for size in (1, 20, 50_000):
        got = {r.threshold: (r.tp, r.fp) for r in evaluate.score_curve(df, "label", "s", slice_rows=size).collect()}
        want = {t: (sum(l and s >= t for s, l in pairs), sum(not l and s >= t for s, l in pairs)) for t in {s for s, _ in pairs}}
        assert got == want
    assert evaluate.area_under_curve(df, "label", "s").first().auc == pytest.approx(brute_auc(pairs))


def test_thresholds():
    steps = evaluate.scan_thresholds(50)
    assert len(steps) == 50 and steps[0] == 0 and steps[3] == 0.49 and steps[4] == 0.5 and steps[-1] == 1.0


def test_signal_efficiency(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.5,), (1.0,), (float("nan"),)], "p double")
    got = {r.threshold: r.eff for r in evaluate.signal_efficiency(df, "p", [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.8, 0.5: pytest.approx(0.6), 1.0: pytest.approx(0.2)}
    assert [r.eff for r in evaluate.signal_efficiency(df.where("p > 5 and not isnan(p)"), "p", [0.0, 0.5]).collect()] == [0.0, 0.0]


def test_background_needs_more_than_five_entries(spark):
    data = [(0.9, 0.05 + 0.1 * i) for i in range(5)] + [(0.4, 0.95)]
    df = spark.createDataFrame(data, "p double, m double")
    got = {r.threshold: r.bkg for r in evaluate.background_scan(df, "p", "m", [0.1, 0.5, 0.99], Uniform(10, 0.0, 1.0), 0.4, 0.6).collect()}
    assert got[0.1] == pytest.approx(2.0) and got[0.5] == 0.0 and got[0.99] == 0.0


def test_working_point_limits_against_brute_force(spark):
    rnd = random.Random(5)
    data = [(b, rnd.random(), rnd.random() < 0.7) for b in (0, 1) for _ in range(300)]
    df = spark.createDataFrame(data, "b int, p double, den boolean")
    mid, low, high, n, limit = {0: 0.5, 1: 0.3}, {0: 0.0, 1: 0.1}, {0: 1.0, 1: 0.9}, 8, 0.2
    got = {r.b: (r.min_cut, r.max_cut) for r in evaluate.working_point_limits(df, "b", "p", F.col("den"), mid, low, high, n, limit).collect()}
    for b in (0, 1):
        def eff(c):
            return sum(p > c for bb, p, d in data if bb == b and d) / sum(d for bb, _, d in data if bb == b)
        lo = [low[b] + i * (mid[b] - low[b]) / n for i in range(n)]
        hi = [high[b] - i * (high[b] - mid[b]) / n for i in range(n)]
        want = [next((c for c in cuts if abs(eff(c) - eff(mid[b])) / eff(mid[b]) < limit), None) for cuts in (lo, hi)]
        assert got[b] == (pytest.approx(want[0]), pytest.approx(want[1]))


def test_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (0, 0)], "l int, p int")
    got = {(r.label, r.prediction): (r.n, r.share, r.error_share) for r in evaluate.confusion(df, "l", "p").collect()}
    assert got[1, 1] == (2, pytest.approx(2 / 3), 0.0) and got[1, 0][2] == pytest.approx(1 / 3)


def test_nan_scores_lie_below_all_thresholds(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 0), (0.5, 1), (0.2, 0)], "s double, label int")
    got = {r.threshold: (r.tp, r.fp) for r in evaluate.score_curve(df, "label", "s").collect()}
    assert got == {0.5: (1, 0), 0.2: (1, 1), float("-inf"): (2, 2)}


def test_one_feature_at_a_time_is_permuted(separable):
    out = learners.shuffled_one_by_one(separable, ["a", "b"], ["k"], 1, group_rows=50).where("feature = 'a'")
    assert sorted(r.a for r in out.collect()) == sorted(r.a for r in separable.collect())
    both = out.join(separable.select("k", F.col("a").alias("a0"), F.col("b").alias("b0")), "k")
    assert both.where("a != a0").count() > 390 and both.where("b != b0").count() == 0


def test_shuffle_groups_stay_small_for_a_hot_key(spark):
    hot = spark.createDataFrame([(1, float(i)) for i in range(600)], "k int, a double").coalesce(1)
    out = learners.shuffled_one_by_one(hot, ["a"], ["k"], 1, group_rows=20)
    # the whole column is still a permutation, and values come from other rows
    assert sorted(r.a for r in out.collect()) == sorted(r.a for r in hot.collect())


def test_importance_and_search(spark, separable):
    model = learners.train(separable, FEATURES, learners.random_forest(depth=3, trees=8))
    imp = {r.feature: r.importance for r in learners.importances(model, FEATURES, spark).collect()}
    assert imp["a"] > imp["b"]
    drop = {r.feature: r["drop"] for r in learners.permutation_importance(separable, model, FEATURES, ["k"], "label").collect()}
    assert drop["a"] > drop["b"]
    table, best = learners.search(separable, FEATURES, "decision_tree", learners.grid(depth=[1, 3]), 2, "label", ["k"])
    assert table.where("best").count() == 1 and table.count() == 2 and best.stages[-1].depth >= 1
    assert learners.draws(3, 1, depth=(2, 4), rate=(0.1, 0.2)) == learners.draws(3, 1, depth=(2, 4), rate=(0.1, 0.2))


def test_standardise_and_components(separable):
    s = learners.standardise(separable, FEATURES)
    r = s.agg(F.avg("a"), F.stddev_pop("a")).first()
    assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1)
    out, explained = learners.principal_components(s, FEATURES, 2)
    assert sum(explained) == pytest.approx(1) and out.agg(F.corr("pca_1", "pca_2")).first()[0] == pytest.approx(0, abs=1e-6)


def test_decision_surface(spark, separable):
    model = learners.train(separable, FEATURES, learners.decision_tree(2))
    out = learners.decision_surface(separable, model, "a", "b", points=7)
    assert out.count() == 49 and out.select("a").distinct().count() == 7 and out.where("y_test_prob is null").count() == 0


def test_incremental_input(spark, tmp_path):
    src, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "id long, day int"
    spark.range(10).selectExpr("id", "1 as day").coalesce(1).write.parquet(f"{src}")
    for _ in range(2):  # the second run finds nothing new
        incremental.ingest(spark, src, schema_of(spark, schema), out, state, step=lambda d: d.where("id > 2"))
        assert spark.read.parquet(out).count() == 7
    spark.range(10, 15).selectExpr("id", "2 as day").coalesce(1).write.mode("append").parquet(src)
    incremental.ingest(spark, src, schema_of(spark, schema), out, state, step=lambda d: d.where("id > 2"))
    assert spark.read.parquet(out).count() == 12


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_ledger(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(10).coalesce(1).write.parquet(src)
    nothing = spark.createDataFrame([], "file_id string")
    first = incremental.unprocessed(spark.read.parquet(src), nothing)
    assert first.count() == 10
    ledger = spark.createDataFrame(incremental.ledger_entries(first).collect(), "file_id string")
    assert incremental.unprocessed(spark.read.parquet(src), ledger).count() == 0


def test_variations(spark):
    v = spark.createDataFrame([("c", "v", 0, True, "p1", "9"), ("c", "v", 1, True, "p1", "#"), ("c", "v", 2, False, "p1", "7"), ("c", "w", 0, True, "zz", "1")],
                              "category string, variation string, idx int, active boolean, param string, value string")
    out = variations.expand_variations({"p1": "1", "p2": "2"}, v)
    got = {(r.variation, r.idx, r.param): (r.value, r.changed) for r in out.collect()}
    assert got == {("v", 0, "p1"): ("9", True), ("v", 0, "p2"): ("2", False), ("v", 1, "p1"): ("1", False), ("v", 1, "p2"): ("2", False), ("w", 0, "p1"): ("1", False), ("w", 0, "p2"): ("2", False)}


def test_shared_folder_is_required_on_a_cluster(spark):
    from tallyfield import session

    class Context:
        master = "spark://host:1"

    class Unset:
        @staticmethod
        def get(key, default=None):
            return default

    class Other:
        sparkContext = Context()
        conf = Unset()

    with pytest.raises(RuntimeError):
        session.shared_dir(Other())
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


@pytest.mark.parametrize("name", ["forest", "boosted", "tree"])
def test_attribution_adds_up_to_the_score(separable, name):
    df = separable.withColumn("base", F.lit("kept apart"))
    model = learners.train(df, FEATURES, ESTIMATORS[name]())
    s = attribution.attribute(learners.score(df, model, ""), model, FEATURES, base="__base")
    want = -0.5 * F.log(1 / F.col("y_test_prob") - 1) if name == "boosted" else F.col("y_test_prob")
    worst = s.select(F.max(F.abs(F.col("attributed") - want)).alias("d"), F.countDistinct("__base").alias("n")).first()
    assert worst.d < 1e-9 and worst.n == 1 and s.count() == 400
    by = {r.feature: r.mean_abs for r in attribution.influence(s, FEATURES).collect()}
    assert by["a"] > by["b"] and set(by) == set(FEATURES)


def test_attribution_of_missing_values_and_nothing(spark, separable):
    model = learners.train(separable, FEATURES, learners.decision_tree(2))
    odd = spark.createDataFrame([(None, 0.0), (float("nan"), None)], "a double, b double")
    assert all(len(r.contributions) == 2 and 0 <= r.attributed <= 1 for r in attribution.attribute(odd, model, FEATURES).collect())
    assert attribution.attribute(separable.where("false"), model, FEATURES).count() == 0


def test_halving_finds_the_winner_of_the_whole_search(separable):
    settings = [{"depth": 1, "trees": 1, "max_features": "1"}, {"depth": 4, "trees": 12}, {"depth": 1, "trees": 1, "max_features": "1", "seed": 2}, {"depth": 1, "trees": 1, "max_features": "1", "seed": 3}]
    copies = separable.select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("c"), "*").withColumn("k", F.col("k") * 5 + F.col("c"))
    table, model = learners.halving(copies, FEATURES, "random_forest", settings, "label", ["k"])
    found = {r.trial: r for r in table.collect()}
    whole = learners.search(copies, FEATURES, "random_forest", settings, 2, "label", ["k"])[0]
    assert found[1].best and found[1].share == 1.0 and found[1].round == 2 and whole.where("best").first().trial == 1
    assert sum(r.best for r in found.values()) == 1 and sorted(r.round for r in found.values()) == [0, 0, 1, 2]
    assert learners.score(copies, model, "").count() == 2000
    with pytest.raises(ValueError, match="parameter set"):
        learners.halving(copies, FEATURES, "random_forest", [], "label", ["k"])


def test_importance_by_expression_equals_scored_copies(spark, separable):
    """The compiled forest gives the areas of the scored copies, without a vector per copy; a feature without a cut loses nothing."""
    df = separable.withColumn("flat", F.lit(1.0))
    columns = [*FEATURES, "flat"]
    for estimator in (learners.random_forest(depth=3, trees=8), learners.decision_tree(2)):
        model = learners.train(df, columns, estimator)
        formula, cut = learners._forest_score(model, lambda f: columns[f])
        assert columns.index("flat") not in cut
        scored = learners.score(df, model, "").withColumn("p", F.expr(formula))
        assert scored.where("p <> y_test_prob").count() == 0
        copies = learners.score(learners.shuffled_one_by_one(df, columns, ["k"], 1), model, "")
        want = {r.feature: r.auc for r in evaluate.area_under_curve(copies, "label", "y_test_prob", ["feature"]).collect()}
        got = {r.feature: (r.auc, r["drop"]) for r in learners.permutation_importance(df, model, columns, ["k"], "label").collect()}
        assert {f: a for f, (a, _) in got.items()} == pytest.approx(want, abs=1e-12) and got["flat"][1] == 0
        assert learners.permutation_importance(df.limit(0), model, columns, ["k"], "label").count() == 0
    other = learners.train(df, columns, learners.linear_regression())
    assert learners._forest_score(other, str) is None
