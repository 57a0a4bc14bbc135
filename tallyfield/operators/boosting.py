"""Adaptive boosting of trees with one cut, trained by sums of weights."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

BINS = 64
TIE = 12  # digits to which impurities and votes are compared


@dataclass(frozen=True)
class Stump:
    """Votes -1 or 1: ``left`` for values below the threshold, ``right`` for all others, also NULL and NaN."""

    feature: str
    threshold: float
    left: int
    right: int
    alpha: float

    def vote(self) -> Column:
        below = F.coalesce(F.col(f"`{self.feature}`") < self.threshold, F.lit(False))
        return F.when(below, F.lit(self.left)).otherwise(F.lit(self.right))


@dataclass
class Boosted:
    stumps: list[Stump] = field(default_factory=list)

    def margin(self) -> Column:
        """Weighted mean vote, -1 to 1; 0 without stumps."""
        total = sum(s.alpha for s in self.stumps)
        if not total:
            return F.lit(0.0)
        return _sum([s.vote() * F.lit(s.alpha / total) for s in self.stumps])

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Add ``y_test_prediction<name>`` and ``y_test_prob<name>``, expressions without any Python on rows."""
        d = self.margin()
        return df.withColumns({
            f"y_test_prediction{name}": (F.round(d, TIE) > 0).cast("double"),
            f"y_test_prob{name}": 1 / (1 + F.exp(-2 * d)),
        })


def _sum(parts: Sequence[Column]) -> Column:
    """Balanced sum: a chain of hundreds of additions would nest as deeply."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _sum(parts[:half]) + _sum(parts[half:])


def cut_candidates(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Ascending thresholds per feature, at most about ``bins`` of them.

    A feature with few distinct values is cut halfway between neighbours, any other at its
    quantiles.  One pass for the quantiles of all features, a second one for the few-valued ones.
    """
    def finite(c: str) -> Column:
        v = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)

    shares = [i / bins for i in range(1, bins)]
    look = df.agg(*[F.approx_count_distinct(finite(c)).alias(f"n{i}") for i, c in enumerate(features)],
                  *[F.percentile_approx(finite(c), shares, 100 * bins).alias(f"q{i}") for i, c in enumerate(features)]).first()
    few = [i for i in range(len(features)) if look[f"n{i}"] <= bins]
    sets = df.agg(*[F.collect_set(finite(features[i])).alias(f"s{i}") for i in few]).first() if few else None
    out = {}
    for i, c in enumerate(features):
        if i in few:
            values = sorted(sets[f"s{i}"])
            out[c] = [(a + b) / 2 for a, b in zip(values, values[1:])]
        else:
            out[c] = sorted(set(look[f"q{i}"]))
    return out


def _best_cut(weighted: DataFrame) -> DataFrame:
    """The cut of least weighted impurity from rows (b: bin per feature, y, w).

    Rows are combined to features times bins cells before the shuffle; windows run over the bins of one feature.
    """
    cells = weighted.select(F.posexplode("b").alias("f", "bin"), "y", "w").groupBy("f", "bin").agg(
        F.count("*").alias("c"), F.sum(F.when(F.col("y") > 0, F.col("w")).otherwise(0.0)).alias("p"),
        F.sum(F.when(F.col("y") < 0, F.col("w")).otherwise(0.0)).alias("n"))
    whole, up = Window.partitionBy("f"), Window.partitionBy("f").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = cells.select("f", "bin", *[F.sum(x).over(up).alias(f"l{x}") for x in "cpn"], *[F.sum(x).over(whole).alias(f"t{x}") for x in "cpn"])
    split = sums.where("lc < tc").select("f", "bin", "lp", "ln", (F.col("tp") - F.col("lp")).alias("rp"), (F.col("tn") - F.col("ln")).alias("rn"),
                                         (F.col("tp") + F.col("tn")).alias("t"))

    def impurity(p: str, n: str) -> Column:
        return F.coalesce(F.try_divide(F.col(p) * F.col(n), F.col(p) + F.col(n)), F.lit(0.0))

    def vote(p: str, n: str) -> Column:
        return F.when(F.round((F.col(p) - F.col(n)) / F.col("t"), TIE) > 0, 1).otherwise(-1)

    voted = split.withColumns({"left": vote("lp", "ln"), "right": vote("rp", "rn"),
                               "impurity": F.round((impurity("lp", "ln") + impurity("rp", "rn")) / F.col("t"), TIE)})
    missed = F.when(F.col("left") > 0, F.col("ln")).otherwise(F.col("lp")) + F.when(F.col("right") > 0, F.col("rn")).otherwise(F.col("rp"))
    return voted.withColumn("error", missed / F.col("t")).orderBy("impurity", "f", "bin").limit(1)


def adaptive_boosting(df: DataFrame, features: Sequence[str], label: str, rounds: int = 50, rate: float = 1.0,
                      bins: int = BINS, weight: str | None = None) -> Boosted:
    """Two-class adaptive boosting (SAMME) of trees with one cut, split by weighted Gini impurity.

    Rows are stored once as bin numbers.  The weight of a row is an expression of the cuts found so far, so no
    round rewrites the table and no lineage grows; a round is one aggregation, of which one row reaches the driver.
    Label 1 against every other value; rows without label or with a weight that is not above 0 are left out.  Training ends
    early with a cut without error or without one better than chance.  Equal impurities: the earlier feature, the lower cut.
    """
    cuts = cut_candidates(df, features, bins)
    used = [c for c in features if cuts[c]]
    if not used:
        return Boosted()
    w0 = F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")
    data = df.where(F.col(f"`{label}`").isNotNull()).select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(used)],
        F.when(F.col(f"`{label}`") == 1, 1).otherwise(-1).alias("y"), w0.alias("w0")).where("w0 > 0 and not isnan(w0)")
    data = stored(_binned(data, [cuts[c] for c in used]), "boosting")
    stumps: list[Stump] = []
    votes: list[Column] = []
    for _ in range(rounds):
        w = F.col("w0")
        if votes:
            w = w * F.exp(-0.5 * F.col("y") * _sum(votes))
        best = _best_cut(data.select("b", "y", w.alias("w"))).first()
        if best is None or best["error"] >= 0.5 - 10.0**-TIE:
            break
        perfect = best["error"] <= 10.0**-TIE
        alpha = 1.0 if perfect else rate * math.log((1 - best["error"]) / best["error"])
        name = used[best["f"]]
        stumps.append(Stump(name, cuts[name][best["bin"]], best["left"], best["right"], alpha))
        if perfect:
            break
        side = F.when(F.col("b")[best["f"]] <= best["bin"], F.lit(best["left"])).otherwise(F.lit(best["right"]))
        votes.append(side * F.lit(alpha))
    return Boosted(stumps)


def _binned(df: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Bin numbers ``b`` of the columns x0, x1, ...: cuts at or below the value, all of them for NULL and NaN.

    A binary search per value; comparisons written out for many columns would outgrow one generated method.
    """
    inf = float("inf")
    names = [f"x{i}" for i in range(len(cuts))]
    found = Bucketizer(splitsArray=[[-inf, *c, inf] for c in cuts], inputCols=names, outputCols=[f"b{n}" for n in names], handleInvalid="keep").transform(df)
    return found.select(F.array(*[F.least(F.col(f"b{n}"), F.lit(float(len(c)))).cast("int") for n, c in zip(names, cuts)]).alias("b"), "y", "w0")
