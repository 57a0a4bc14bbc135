"""Spark ML models: construction, scoring, per-bin application, search, importance."""

from __future__ import annotations

import itertools
import os
import random
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier, GBTClassifier,
                                       MultilayerPerceptronClassifier, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import fold_number, key_digest, key_number
from ..functions.predicates import gt, working_point
from .evaluate import accuracy, area_under_curve

FEATURES = "__features"


def random_forest(depth: int = 5, trees: int = 50, max_features: str = "sqrt", seed: int = 1, label: str = "label") -> Estimator:
    return RandomForestClassifier(labelCol=label, featuresCol=FEATURES, maxDepth=depth, numTrees=trees, featureSubsetStrategy=max_features, seed=seed)


def boosted_trees(depth: int = 3, rate: float = 0.1, rounds: int = 20, subsample: float = 1.0, columns: str = "all", seed: int = 1, label: str = "label") -> Estimator:
    return GBTClassifier(labelCol=label, featuresCol=FEATURES, maxDepth=depth, stepSize=rate, maxIter=rounds, subsamplingRate=subsample, featureSubsetStrategy=columns, seed=seed)


def decision_tree(depth: int = 5, seed: int = 1, label: str = "label") -> Estimator:
    return DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, maxDepth=depth, seed=seed)


def neural_network(n_features: int, hidden: int = 12, classes: int = 2, rounds: int = 100, seed: int = 1, label: str = "label") -> Estimator:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=FEATURES, layers=[n_features, hidden, classes], maxIter=rounds, seed=seed)


def linear_regression(alpha: float = 0.0, kind: str = "linear", label: str = "label") -> Estimator:
    """``kind``: linear, ridge (L2) or lasso (L1)."""
    mix = {"linear": 0.0, "ridge": 0.0, "lasso": 1.0}[kind]
    return LinearRegression(labelCol=label, featuresCol=FEATURES, regParam=0.0 if kind == "linear" else alpha, elasticNetParam=mix, predictionCol="prediction")


KINDS: dict[str, Callable[..., Estimator]] = {
    "random_forest": random_forest, "boosted_trees": boosted_trees, "decision_tree": decision_tree,
    "neural_network": neural_network, "linear_regression": linear_regression,
}


def train(df: DataFrame, features: Sequence[str], estimator: Estimator) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=FEATURES), estimator]).fit(df)


def score(df: DataFrame, model: Model, name: str, labels: Sequence[str] | None = None) -> DataFrame:
    """Add ``y_test_prediction<name>`` and ``y_test_prob<name>`` (or one probability per label)."""
    kept = df.columns
    out = model.transform(df)
    columns = [F.col("prediction").alias(f"y_test_prediction{name}")]
    if "probability" in out.columns:
        p = vector_to_array(F.col("probability"))
        columns += [p[1].alias(f"y_test_prob{name}")] if labels is None else [p[i].alias(f"y_test_prob{name}{l}") for i, l in enumerate(labels)]
    return out.select(*kept, *columns)


def apply_per_bin(
    df: DataFrame, models: Mapping[int, Model], name: str, cuts: Mapping[int, float | tuple[float, float]],
    bin_col: str = "skim_bin", labels: Sequence[str] | None = None,
) -> DataFrame:
    """Score each skim bin with its model and keep rows above its cut.

    A filter on the bin reads only that directory of a skimmed table, and the union
    of the parts needs no shuffle.  A single cut is ``probability > cut``; a pair is
    the two-class working point on the first two labels.
    """
    out = None
    for b, model in models.items():
        part = score(df.where(F.col(bin_col) == b), model, name, labels)
        cut = cuts[b]
        if isinstance(cut, tuple):
            part = part.where(working_point([f"y_test_prob{name}{l}" for l in labels[:2]], cut))
        else:
            part = part.where(gt(f"y_test_prob{name}", cut))
        out = part if out is None else out.unionByName(part)
    return out


def save(model: PipelineModel, folder: str, name: str, suffix: str = "") -> str:
    path = os.path.join(folder, f"{name}{suffix}")
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def with_folds(df: DataFrame, keys: Sequence[str], folds: int, seed: int, name: str = "fold") -> DataFrame:
    """Fold number from the key hash; independent of the label, so every fold has the same class mixture."""
    return df.withColumn(name, fold_number(keys, folds, seed))


def cross_validated(df: DataFrame, features: Sequence[str], estimator: Estimator, folds: int, name: str = "", fold: str = "fold") -> DataFrame:
    """Every row scored by the model that did not see its fold."""
    out = None
    for k in range(folds):
        model = train(df.where(F.col(fold) != k), features, estimator)
        part = score(df.where(F.col(fold) == k), model, name)
        out = part if out is None else out.unionByName(part)
    return out


def fold_rmse(scored: DataFrame, label: str, prediction: str, fold: str = "fold") -> DataFrame:
    err = F.col(label) - F.col(prediction)
    return scored.groupBy(fold).agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def learning_curve(df: DataFrame, features: Sequence[str], estimator: Estimator, keys: Sequence[str], fractions: Sequence[float], label: str, test: str = "is_test", seed: int = 1) -> DataFrame:
    """Training and validation mean squared error for growing hash-ordered shares of the training part."""
    train_part, test_part = df.where(~F.col(test)), df.where(F.col(test))
    out = None
    for f in fractions:
        share = train_part.where(key_number(keys, seed) < int(f * 2**32))
        model = train(share, features, estimator)
        both = share.withColumn("part", F.lit("train")).unionByName(test_part.withColumn("part", F.lit("test")))
        err = F.col(label) - F.col("y_test_prediction")
        mse = score(both, model, "").groupBy("part").agg(F.count("*").alias("n"), F.avg(err * err).alias("mse")).withColumn("fraction", F.lit(float(f)))
        out = mse if out is None else out.unionByName(mse)
    return out


def importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    v = model.stages[-1].featureImportances
    return spark.createDataFrame([(f, float(v[i])) for i, f in enumerate(features)], "feature string, importance double")


def neighbours(df: DataFrame, features: Sequence[str], keys: Sequence[str], seed: int, group_rows: int = 1000) -> DataFrame:
    """Every row with the features of another one as ``__next``: a permutation of the table.

    Rows form random groups of about ``group_rows``; inside a group every row takes the
    values of the next row in hash order, the last one those of the first.  Key and place in
    the input choose the group, so its size stays bounded however large the table is and
    however often a key occurs.  One window serves all features.
    """
    groups = max(1, df.count() // group_rows)
    tagged = df.withColumn("__h", F.xxhash64(F.lit(seed), *keys, F.monotonically_increasing_id()))
    tagged = tagged.withColumn("__g", F.pmod("__h", F.lit(groups)))
    w = Window.partitionBy("__g").orderBy("__h")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*features)
    return tagged.withColumn("__next", F.coalesce(F.lead(values).over(w), F.first(values).over(whole)))


def shuffled_one_by_one(df: DataFrame, features: Sequence[str], keys: Sequence[str], seed: int, group_rows: int = 1000) -> DataFrame:
    """For each feature a copy of the table in which that feature alone is permuted: column ``feature`` names it."""
    paired = neighbours(df, features, keys, seed, group_rows)
    copies = [F.struct(F.lit(f).alias("feature"), *[(F.col(f"__next.{g}") if g == f else F.col(g)).alias(g) for g in features]) for f in features]
    rest = [c for c in df.columns if c not in features]
    return paired.select(*rest, F.explode(F.array(*copies)).alias("__c")).select(*rest, "__c.*")


def _forest_score(model: PipelineModel, value: Callable[[int], str]) -> tuple[str, set[int]] | None:
    """Probability of class 1 by a fitted two-class tree or forest as an SQL expression, and the features it cuts; ``value`` names a feature by its number.

    None for other models.  The votes are summed in the order of the trees, as the model does.
    """
    fitted = model.stages[-1]
    if not isinstance(fitted, (RandomForestClassificationModel, DecisionTreeClassificationModel)) or fitted.numClasses != 2:
        return None
    cut: set[int] = set()

    def leaf(node, leaves: list) -> str:
        if node.subtreeDepth() == 0:
            zero, one = list(node.impurityStats().stats())
            total = zero + one
            leaves.append((zero / total, one / total) if total else (0.0, 0.0))
            return str(len(leaves) - 1)
        split = node.split()
        if "Continuous" not in split.getClass().getSimpleName():
            raise ValueError("only cuts on numbers")
        f = split.featureIndex()
        cut.add(f)
        left, right = leaf(node.leftChild(), leaves), leaf(node.rightChild(), leaves)
        return f"CASE WHEN {value(f)} <= {float(split.threshold())!r}D THEN {left} ELSE {right} END"

    votes: list[list[str]] = [[], []]
    for tree in fitted.trees if hasattr(fitted, "trees") else [fitted]:
        leaves: list = []
        at = leaf(tree._java_obj.rootNode(), leaves)
        for k in (0, 1):
            votes[k].append(f"array({', '.join(f'{p[k]!r}D' for p in leaves)})[{at}]")
    zero, one = " + ".join(votes[0]), " + ".join(votes[1])
    return f"({one}) / (({zero}) + ({one}))", cut


def permutation_importance(df: DataFrame, model: PipelineModel, features: Sequence[str], keys: Sequence[str], label: str, seed: int = 1) -> DataFrame:
    """Loss of area under the ROC curve when one feature is shuffled: (feature, auc, drop).

    A tree or forest is compiled to an expression: a row travels once with the values of its neighbour, and is repeated only
    as the number of the feature that is exchanged.  A feature that no tree cuts changes no score and has the area of all.  Other
    models score a copy of the table for each feature.
    """
    compiled = _forest_score(model, lambda f: f"CASE WHEN __f = {f} THEN __y[{f}] ELSE __x[{f}] END")
    if compiled is None:
        base = area_under_curve(score(df, model, ""), label, "y_test_prob").select(F.col("auc").alias("base"))
        out = area_under_curve(score(shuffled_one_by_one(df, features, keys, seed), model, ""), label, "y_test_prob", ["feature"])
        return out.select("feature", "auc").withColumn("drop", base.scalar() - F.col("auc"))
    formula, cut = compiled
    pairs = neighbours(df, features, keys, seed).select(
        F.col(label).alias("label"), F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("__x"), F.array(*[F.col("__next")[f].cast("double") for f in features]).alias("__y"))
    tried = pairs.withColumn("__f", F.explode(F.array(*map(F.lit, [-1, *sorted(cut)])))).select("label", "__f", F.expr(formula).alias("__p"))
    area = {r["__f"]: r["auc"] for r in area_under_curve(tried, "label", "__p", ["__f"]).collect()}  # a row per feature
    rows = [(f, area.get(i, area.get(-1)), None if area.get(-1) is None else area[-1] - area.get(i, area[-1])) for i, f in enumerate(features)] if area else []
    return df.sparkSession.createDataFrame(rows, "feature string, auc double, drop double")


def grid(**values: Sequence) -> list[dict]:
    return [dict(zip(values, combo)) for combo in itertools.product(*values.values())]


def draws(n: int, seed: int, **ranges: tuple) -> list[dict]:
    """n parameter sets, uniform in each range; integer limits give integers."""
    rnd = random.Random(seed)
    return [{k: rnd.randint(a, b) if isinstance(a, int) and isinstance(b, int) else rnd.uniform(a, b) for k, (a, b) in ranges.items()} for _ in range(n)]


PARALLEL = 4  # fits that run at a time; they share the executors


def _at_once(spark, work: Callable, items: Sequence, parallel: int) -> list:
    """Results of ``work`` in order; the driver's threads only wait for their jobs."""
    with ThreadPool(max(1, min(parallel, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)


def search(df: DataFrame, features: Sequence[str], kind: str, settings: Sequence[Mapping], folds: int, label: str, keys: Sequence[str], seed: int = 1,
           parallel: int = PARALLEL) -> tuple[DataFrame, PipelineModel]:
    """Cross-validate every parameter set; returns the result table and the best model refitted on all rows.

    Scores are the mean and spread over folds of AUC and accuracy; the best mean
    AUC wins, the earlier set at a tie.  The table has one row per parameter set.  All fits of sets
    and folds run ``parallel`` at a time; the folds of all sets are scored by one job.
    """
    data = with_folds(df, keys, folds, seed).persist()
    spark = df.sparkSession
    tasks = [(i, k) for i in range(len(settings)) for k in range(folds)]
    models = _at_once(spark, lambda t: train(data.where(F.col("fold") != t[1]), features, KINDS[kind](label=label, **settings[t[0]])), tasks, parallel)
    parts = [score(data.where(F.col("fold") == k), m, "").select("fold", label, "y_test_prediction", "y_test_prob").withColumn("trial", F.lit(i)) for (i, k), m in zip(tasks, models)]
    scored = reduce(DataFrame.unionByName, parts)
    by = ["trial", "fold"]
    per_fold = area_under_curve(scored, label, "y_test_prob", by).join(accuracy(scored, label, "y_test_prediction", by), by)
    found = per_fold.groupBy("trial").agg(F.avg("auc"), F.stddev_pop("auc"), F.avg("accuracy"), F.stddev_pop("accuracy")).collect()  # a row per set
    rows = sorted((r[0], str(dict(settings[r[0]])), *[float(x) for x in r[1:]]) for r in found)
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    model = train(data, features, KINDS[kind](label=label, **settings[best]))
    data.unpersist()
    table = spark.createDataFrame(
        [(*r, r[0] == best) for r in rows],
        "trial int, parameters string, auc_mean double, auc_std double, accuracy_mean double, accuracy_std double, best boolean")
    return table, model


def halving(df: DataFrame, features: Sequence[str], kind: str, settings: Sequence[Mapping], label: str, keys: Sequence[str], seed: int = 1,
            keep: int = 2, test: float = 0.25, parallel: int = PARALLEL) -> tuple[DataFrame, PipelineModel]:
    """Successive halving: many parameter sets on few rows, the better ones on more, the last one on all.

    Each round fits the sets that are left on a share of the training rows, ``keep`` times that of the round before, and keeps
    the best one in ``keep``.  Shares are thresholds on the key hash, so a round's rows contain those before
    it; all rounds are compared on the same test rows, by AUC, the earlier set at a tie.  Fits of a round run ``parallel`` at a time and are
    scored by one job.  Returns one row per set: last round (from 0), its share and AUC, and the winner refitted on all rows.
    """
    if keep < 2 or not settings:
        raise ValueError("at least one parameter set, and keep of 2 or more")
    spark = df.sparkSession
    # two independent hashes: which rows are test rows, and the order of the others
    data = df.withColumns({"__test": key_number(keys, seed) < int(test * 2**32), "__order": key_number(keys, seed + 1)}).persist()
    rounds = 0
    while keep ** (rounds + 1) <= len(settings):
        rounds += 1
    left, seen = list(range(len(settings))), {}
    for r in range(rounds + 1):
        share = float(keep) ** (r - rounds)
        part = data.where(~F.col("__test") & (F.col("__order") < int(share * 2**32)))
        models = _at_once(spark, lambda i, part=part: train(part, features, KINDS[kind](label=label, **settings[i])), left, parallel)
        held = data.where("__test")
        scored = reduce(DataFrame.unionByName, [score(held, m, "").select(label, "y_test_prob").withColumn("trial", F.lit(i)) for i, m in zip(left, models)])
        auc = {x["trial"]: x["auc"] for x in area_under_curve(scored, label, "y_test_prob", ["trial"]).collect()}  # a row per set
        seen |= {i: (r, share, auc.get(i)) for i in left}
        left = sorted(left, key=lambda i: (-(auc.get(i) or 0.0), i))[: max(1, len(left) // keep)]
    best = left[0]
    model = train(df, features, KINDS[kind](label=label, **settings[best]))
    data.unpersist()
    table = spark.createDataFrame([(i, str(dict(settings[i])), *seen[i], i == best) for i in sorted(seen)],
                                  "trial int, parameters string, round int, share double, auc double, best boolean")
    return table, model


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit (population) variance; one row of moments is read back."""
    m = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return df.withColumns({c: F.try_divide(F.col(c) - F.lit(m[f"m_{c}"]), F.lit(m[f"s_{c}"])) for c in columns})


def principal_components(df: DataFrame, columns: Sequence[str], n: int) -> tuple[DataFrame, list[float]]:
    """Columns pca_1..pca_n and the explained share of the variance."""
    vec = VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)
    model = PCA(k=n, inputCol=FEATURES, outputCol="__pca").fit(vec)
    arr = vector_to_array(F.col("__pca"))
    out = model.transform(vec).select(*df.columns, *[arr[i].alias(f"pca_{i + 1}") for i in range(n)])
    return out, [float(v) for v in model.explainedVariance]


def correlation_axes(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, list[float]]]:
    """(share of the variance, loadings) of the axes of the correlation matrix, the largest share first.

    Only the matrix (columns x columns) reaches the driver.  Its diagonal is exactly 1, so the axes of two columns are
    the diagonals, whatever the coefficient; of a covariance, noise in the variances would turn them where it is small.
    """
    vec = VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)
    matrix = Correlation.corr(vec, FEATURES).head()[0].toArray()
    if len(columns) == 2:
        r, half = float(matrix[0, 1]), 0.5**0.5
        return sorted([((1 + r) / 2, [half, half]), ((1 - r) / 2, [half, -half])], key=lambda a: -a[0])
    values, axes = np.linalg.eigh(matrix)
    return [(float(values[i] / len(columns)), [float(v) for v in axes[:, i]]) for i in np.argsort(-values, kind="stable")]


def decision_surface(df: DataFrame, model: PipelineModel, x: str, y: str, points: int = 50, margin: float = 0.5) -> DataFrame:
    """Model score on ``points`` x ``points`` places over the range of two variables plus a margin."""
    r = df.agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate((x, y)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if r["lo0"] is None:
        return score(df.sparkSession.createDataFrame([], f"`{x}` double, `{y}` double"), model, "")

    def axis(i: int, k: Column) -> Column:
        lo, hi = r[f"lo{i}"] - margin, r[f"hi{i}"] + margin
        return F.lit(lo) + k * ((hi - lo) / max(1, points - 1))

    grid = df.sparkSession.range(points * points).select(axis(0, F.expr(f"id div {points}")).alias(x), axis(1, F.col("id") % points).alias(y))
    return score(grid, model, "")
