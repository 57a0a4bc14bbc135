"""Per-row attribution of tree scores: fitted trees compiled to expressions.

Every node of a tree has a value, what a row that stopped there would score.  On the way from the root
to its leaf a row changes value at every cut, and the change belongs to the feature that is cut.
The sums per feature, together with the value of the roots, are the score of the row: exactly, for every row,
by built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Changes = dict[int, float]  # of one leaf: change of value by feature number


def _value(node, probability: bool) -> float:
    if not probability:
        return float(node.prediction())
    counts = list(node.impurityStats().stats())
    total = sum(counts)
    return counts[1] / total if total else 0.0


def _compile(node, features: Sequence[str], probability: bool, value: float, changes: Changes, paths: list[Changes]) -> Column:
    """Number of the leaf a row falls into, as nested conditions; leaves are added to ``paths`` in order."""
    if node.subtreeDepth() == 0:
        paths.append(changes)
        return F.lit(len(paths) - 1)
    split = node.split()
    f = split.featureIndex()
    if not hasattr(split, "threshold") or "Continuous" not in split.getClass().getSimpleName():
        raise ValueError("only cuts on numbers can be attributed")
    sides = []
    for child in (node.leftChild(), node.rightChild()):
        v = _value(child, probability)
        sides.append(_compile(child, features, probability, v, changes | {f: changes.get(f, 0.0) + v - value}, paths))
    # NULL and NaN go to the right, as NaN does in the model
    x = F.col(f"`{features[f]}`").cast("double")
    return F.when((x <= float(split.threshold())) & ~F.isnan(x), sides[0]).otherwise(sides[1])


def _tree(root, features: Sequence[str], probability: bool) -> tuple[float, Column, list[Changes]]:
    paths: list[Changes] = []
    base = _value(root, probability)
    return base, _compile(root, features, probability, base, {}, paths), paths


def _total(parts: list[Column]) -> Column:
    while len(parts) > 1:
        parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + ([parts[-1]] if len(parts) % 2 else [])
    return parts[0]


def attribute(df: DataFrame, model: PipelineModel, features: Sequence[str], base: str = "base", out: str = "contributions", score: str = "attributed") -> DataFrame:
    """Add ``base``, ``contributions`` (one number per feature, in order) and their sum ``attributed``.

    Two-class trees and forests: parts of the probability of class 1.  Gradient-boosted trees: parts of the margin,
    of which the probability is 1 / (1 + exp(-2 margin)).  Each tree is walked once per row; a leaf number picks
    the changes from a list, so the size of the expression grows with the leaves, not with leaves times features.
    A missing value follows the right side of a cut; an empty table gives an empty table.
    """
    fitted = model.stages[-1]
    name = type(fitted).__name__
    trees = list(fitted.trees) if hasattr(fitted, "trees") else [fitted]
    boosted = name.startswith("GBT")
    weights = [float(w) for w in fitted.treeWeights] if boosted else [1.0 / len(trees)] * len(trees)
    roots = [_tree(t._java_obj.rootNode(), features, not boosted) for t in trees]
    leaves = df.withColumns({f"__leaf{i}": leaf for i, (_, leaf, _) in enumerate(roots)})
    parts: list[list[Column]] = [[] for _ in features]
    for i, ((_, _, paths), w) in enumerate(zip(roots, weights)):
        for f in sorted({f for p in paths for f in p}):
            changes = "array(" + ", ".join(f"{w * p.get(f, 0.0)!r}D" for p in paths) + ")"
            parts[f].append(F.expr(changes)[F.col(f"__leaf{i}")])
    each = F.array(*[_total(p) if p else F.lit(0.0) for p in parts])
    start = sum(w * b for (b, _, _), w in zip(roots, weights))
    found = leaves.withColumns({base: F.lit(start), out: each}).drop(*[f"__leaf{i}" for i in range(len(trees))])
    return found.withColumn(score, F.col(base) + F.aggregate(out, F.lit(0.0), lambda s, x: s + x))


def influence(attributed: DataFrame, features: Sequence[str], by: Sequence[str] = (), out: str = "contributions") -> DataFrame:
    """Mean and mean absolute contribution per feature (and group): by..., feature, n, mean, mean_abs; one aggregation."""
    c = [F.col(out)[i] for i in range(len(features))]
    wide = attributed.groupBy(*by).agg(F.count("*").alias("n"), F.array(*[F.avg(x) for x in c]).alias("m"), F.array(*[F.avg(F.abs(x)) for x in c]).alias("a"))
    names = F.array(*map(F.lit, features))
    at = wide.select(*by, "n", F.posexplode(F.arrays_zip("m", "a")).alias("i", "v"))
    return at.select(*by, names[F.col("i")].alias("feature"), "n", F.col("v.m").alias("mean"), F.col("v.a").alias("mean_abs"))
