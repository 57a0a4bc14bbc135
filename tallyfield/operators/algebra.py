"""Bin-wise algebra on histogram DataFrames.

``a`` with variance ``va`` and ``b`` with ``vb``; an absent bin is 0.

=============  ====================  =====================================
operation      content               variance
=============  ====================  =====================================
add            a + k b               va + k^2 vb
multiply       a b                   va b^2 + vb a^2
divide         a / b                 (va b^2 + vb a^2) / b^4
binomial       w = a / b             |(1 - 2 w) va + w^2 vb| / b^2
correlated     a / b                 (a/b)^2 |va/a^2 - vb/b^2|
=============  ====================  =====================================

Division by an empty bin gives 0 with variance 0; the correlated form gives null
when either side is 0.

Two histograms filled apart are paired bin by bin.  Where both come from one table, `operands` takes
them out of one aggregation (`hist.fill_classes`, or a histogram with class columns), so the table is
read once; its result stands for both sides, with None as the right one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import Axis
from ..functions.predicates import Operand, col
from ..session import cut_lineage, stored
from .hist import normalise, project, rebin
from .joins import align

VALUES = ("content", "sumw2")


def operands(hist: DataFrame, keys: Sequence[str], a: str | Column, b: str | Column) -> DataFrame:
    """Both sides of an operation from one histogram: keys, ``a_content, a_sumw2, b_content, b_sumw2``.

    Names are classes of `hist.fill_classes`; conditions pick bins of a histogram with class columns, which are summed up.
    Bins that neither side has are left out, a bin of one side is 0 on the other.
    """
    if isinstance(a, str):
        found = hist.select(*keys, *[F.col(f"{c}_{v}").alias(f"{s}_{v}") for s, c in zip("ab", (a, b)) for v in VALUES])
    else:
        found = hist.groupBy(*keys).agg(*[F.sum(F.when(c, F.col(v))).alias(f"{s}_{v}") for s, c in zip("ab", (a, b)) for v in VALUES])
    names = [f"{s}_{v}" for s in "ab" for v in VALUES]
    return found.where("a_content is not null or b_content is not null").fillna(0.0, subset=names)


def _paired(left: DataFrame, right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return left if right is None else align(left, right, keys)


def _sides():
    return F.col("a_content"), F.col("a_sumw2"), F.col("b_content"), F.col("b_sumw2")


def _result(pairs: DataFrame, keys: Sequence[str], content: Column, sumw2: Column) -> DataFrame:
    return pairs.select(*keys, content.alias("content"), sumw2.alias("sumw2"))


def ratio(num: Column, den: Column) -> Column:
    """num/den, 0 for an empty denominator."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def ratio_variance(a: Column, va: Column, b: Column, vb: Column) -> Column:
    return F.coalesce(F.try_divide(va * b * b + vb * a * a, b * b * b * b), F.lit(0.0))


def binomial_variance(a: Column, va: Column, b: Column, vb: Column) -> Column:
    w = ratio(a, b)
    return F.coalesce(F.try_divide(F.abs((1 - 2 * w) * va + w * w * vb), b * b), F.lit(0.0))


def add(left: DataFrame, right: DataFrame | None, keys: Sequence[str], factor: float = 1.0) -> DataFrame:
    a, va, b, vb = _sides()
    return _result(_paired(left, right, keys), keys, a + factor * b, va + factor * factor * vb)


def multiply(left: DataFrame, right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    a, va, b, vb = _sides()
    return _result(_paired(left, right, keys), keys, a * b, va * b * b + vb * a * a)


def divide(left: DataFrame, right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    a, va, b, vb = _sides()
    return _result(_paired(left, right, keys), keys, ratio(a, b), ratio_variance(a, va, b, vb))


def divide_binomial(left: DataFrame, right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    a, va, b, vb = _sides()
    return _result(_paired(left, right, keys), keys, ratio(a, b), binomial_variance(a, va, b, vb))


def divide_correlated(left: DataFrame, right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Ratio of a sample to a larger one that contains it: relative errors subtract in quadrature."""
    a, va, b, vb = _sides()
    r = F.try_divide(a, b)
    var = r * r * F.abs(F.try_divide(va, a * a) - F.try_divide(vb, b * b))
    ok = (a != 0) & (b != 0)
    return _result(_paired(left, right, keys), keys, F.when(ok, r), F.when(ok, var))


def scale_by(hist: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "multiply") -> DataFrame:
    """Multiply or divide by a histogram of fewer axes (an efficiency per pt bin, say); absent bins count as 0."""
    f = table.select(*keys, F.col("content").alias("b_content"), F.col("sumw2").alias("b_sumw2"))
    joined = hist.join(f, list(keys), "left").fillna(0.0, subset=["b_content", "b_sumw2"])
    a, va, b, vb = F.col("content"), F.col("sumw2"), F.col("b_content"), F.col("b_sumw2")
    if how == "multiply":
        c, v = a * b, va * b * b + vb * a * a
    else:
        c, v = ratio(a, b), ratio_variance(a, va, b, vb)
    return joined.withColumns({"content": c, "sumw2": v}).drop("b_content", "b_sumw2")


def scale(hist: DataFrame, factor: Operand | float) -> DataFrame:
    f = F.lit(float(factor)) if isinstance(factor, (int, float)) else col(factor)
    return hist.withColumns({"content": F.col("content") * f, "sumw2": F.col("sumw2") * f * f})


def clip_negative(hist: DataFrame, strict: bool = False) -> DataFrame:
    """Negative bins (with ``strict`` only below 0, else 0 as well) get content and error 0."""
    bad = F.col("content") < 0 if strict else F.col("content") <= 0
    return hist.withColumns({"content": F.when(bad, 0.0).otherwise(F.col("content")),
                             "sumw2": F.when(bad, 0.0).otherwise(F.col("sumw2"))})


def efficiency(num: Operand, den: Operand) -> tuple[Column, Column]:
    """Efficiency and its binomial error from counts; null for an empty denominator."""
    n, d = col(num), col(den)
    eff = F.try_divide(n.cast("double"), d)
    return eff, F.sqrt(F.try_divide(eff * (1 - eff), d))


def divide_lists(left: DataFrame, right: DataFrame | None, keys: Sequence[str], rebinning: tuple[Axis, Axis] | None = None,
                 factors: tuple[float, float] = (1.0, 1.0), classes: tuple[Column, Column] | None = None) -> DataFrame:
    """Pairwise ratio of two lists of histograms (the list position is one of the keys), after rebinning and scaling.

    Without ``right``, ``left`` holds both lists and ``classes`` says which rows belong to either.
    """
    if rebinning is not None:
        left, right = rebin(left, *rebinning), None if right is None else rebin(right, *rebinning)
    pairs = operands(left, keys, *classes) if right is None else align(left, right, keys)
    for side, f in zip("ab", factors):
        pairs = pairs.withColumns({f"{side}_content": F.col(f"{side}_content") * f, f"{side}_sumw2": F.col(f"{side}_sumw2") * f * f})
    return divide(pairs, None, keys)


# --- response matrices -----------------------------------------------------------------------------


def column_normalised(response: DataFrame, by: Sequence[str], gen: Sequence[str], weight: str = "w") -> DataFrame:
    """Add ``p`` = P(reco bin | gen bin)."""
    total = F.sum(weight).over(Window.partitionBy(*by, *gen))
    return response.withColumn("p", F.coalesce(F.try_divide(F.col(weight), total), F.lit(0.0)))


def fold(hist: DataFrame, response: DataFrame, by: Sequence[str], gen: Sequence[str], reco: Sequence[str]) -> DataFrame:
    """Generated-level histogram seen through the response: sum over gen bins of v P(r|g), errors with P squared.

    ``by`` are group columns of the histogram that the response shares or lacks.
    """
    shared = [c for c in by if c in response.columns]
    norm = column_normalised(response, shared, gen)
    joined = hist.join(norm.select(*shared, *gen, *reco, "p"), [*shared, *gen])
    return joined.groupBy(*by, *reco).agg(
        F.sum(F.col("content") * F.col("p")).alias("content"),
        F.sum(F.col("sumw2") * F.col("p") * F.col("p")).alias("sumw2"),
    )


def unfold(
    data: DataFrame,
    response: DataFrame,
    by: Sequence[str],
    gen: Sequence[str],
    reco: Sequence[str],
    iterations: int,
    cut_every: int = 4,
) -> DataFrame:
    """Iterative Bayesian unfolding (D'Agostini 1995).

    The prior starts as the share of each gen bin among the response pairs.  In
    every round P(g|r) = P(r|g) p_g / sum_g' P(r|g') p_g' distributes the
    measured content over gen bins, and the result is the next prior (its
    normalisation cancels).  Response pairs and measured bins are matched once
    and stored in the shared folder, so no round goes back to the inputs; later
    plans are cut every few rounds.  Pass stored inputs when they come from
    event tables.
    """
    shared = [c for c in by if c in response.columns]
    measured = data.select(*by, *reco, F.col("content").alias("__d"), F.col("sumw2").alias("__e2"))
    base = column_normalised(response, shared, gen).join(measured, [*shared, *reco])
    base = stored(base.select(*by, *gen, *reco, "p", "__d", "__e2"), "unfold")
    prior, keys = response.groupBy(*shared, *gen).agg(F.sum("w").alias("__prior")), shared
    for step in range(1, iterations + 1):
        joint = base.join(prior, [*keys, *gen]).withColumn("__j", F.col("p") * F.col("__prior"))
        total = F.sum("__j").over(Window.partitionBy(*by, *reco))
        post = joint.withColumn("__post", F.coalesce(F.try_divide(F.col("__j"), total), F.lit(0.0)))
        out = post.groupBy(*by, *gen).agg(
            F.sum(F.col("__post") * F.col("__d")).alias("content"),
            F.sum(F.col("__post") * F.col("__post") * F.col("__e2")).alias("sumw2"),
        )
        if step < iterations:
            prior = out.select(*by, *gen, F.col("content").alias("__prior"))
            keys = list(by)
            if step % cut_every == 0:
                prior = cut_lineage(prior)
    return out


def unfold_covariance(data: DataFrame, response: DataFrame, by: Sequence[str], gen: Sequence[str], reco: Sequence[str], iterations: int) -> DataFrame:
    """Covariance of the unfolded contents from the measured errors: (by..., gen..., gen..._2, covariance).

    The derivative of every unfolded bin by every measured bin is carried through the rounds as a
    table (gen bin, reco bin, value): a round adds the unfolding matrix, scales the last derivative by the change of the
    bin, and takes off what the prior of all gen bins that share a reco bin changes in the matrix.
    Each round is stored, and costs joins of tables of bins only.
    """
    shared = [c for c in by if c in response.columns]
    measured = data.select(*by, *reco, F.col("content").alias("__d"), F.col("sumw2").alias("__e2"))
    base = column_normalised(response, shared, gen).join(measured, [*shared, *reco])
    base = stored(base.select(*by, *gen, *reco, "p", "__d", "__e2"), "unfold")
    other, wrt = [f"{c}_2" for c in gen], [f"__by_{c}" for c in reco]
    prior, keys, slope = response.groupBy(*shared, *gen).agg(F.sum("w").alias("__u")), shared, None
    for _ in range(iterations):
        joint = base.join(prior, [*keys, *gen]).withColumn("__j", F.col("p") * F.col("__u"))
        total = F.sum("__j").over(Window.partitionBy(*by, *reco))
        m = stored(joint.withColumn("__m", F.coalesce(F.try_divide(F.col("__j"), total), F.lit(0.0))).select(*by, *gen, *reco, "__m", "__d", "__u"), "unfold-matrix")
        after = m.groupBy(*by, *gen).agg(F.sum(F.col("__m") * F.col("__d")).alias("__next"), F.max("__u").alias("__u"))
        direct = m.select(*by, *gen, *[F.col(c).alias(w) for c, w in zip(reco, wrt)], F.col("__m").alias("__v"))
        if slope is not None:
            change = after.withColumn("__f", F.coalesce(F.try_divide(F.col("__next"), F.col("__u")), F.lit(0.0)))
            scaled = slope.join(change.select(*by, *gen, "__f"), [*by, *gen]).select(*by, *gen, *wrt, (F.col("__v") * F.col("__f")).alias("__v"))
            right = m.select(*by, *reco, *[F.col(c).alias(o) for c, o in zip(gen, other)], F.coalesce(F.try_divide(F.col("__m"), F.col("__u")), F.lit(0.0)).alias("__m2"))
            pulls = m.join(right, [*by, *reco]).groupBy(*by, *gen, *other).agg(F.sum(F.col("__m") * F.col("__m2") * F.col("__d")).alias("__k"))
            moved = slope.select(*by, *[F.col(c).alias(o) for c, o in zip(gen, other)], *wrt, "__v")
            taken = pulls.join(moved, [*by, *other]).select(*by, *gen, *wrt, (-F.col("__k") * F.col("__v")).alias("__v"))
            direct = direct.unionByName(scaled).unionByName(taken)
        slope = stored(direct.groupBy(*by, *gen, *wrt).agg(F.sum("__v").alias("__v")), "unfold-slopes")
        prior, keys = stored(after.select(*by, *gen, F.col("__next").alias("__u")), "unfold-prior"), list(by)
    errors = measured.select(*by, *[F.col(c).alias(w) for c, w in zip(reco, wrt)], "__e2")
    left = slope.join(errors, [*by, *wrt])
    right = slope.select(*by, *wrt, *[F.col(c).alias(o) for c, o in zip(gen, other)], F.col("__v").alias("__v2"))
    return left.join(right, [*by, *wrt]).groupBy(*by, *gen, *other).agg(F.sum(F.col("__v") * F.col("__v2") * F.col("__e2")).alias("covariance"))


def refold(unfolded: DataFrame, data: DataFrame, response: DataFrame, by, gen, reco, keep: Sequence[str]) -> DataFrame:
    """data / fold(unfolded), summed onto the kept reco axes."""
    folded = project(fold(unfolded, response, by, gen, reco), [*by, *keep])
    return divide(project(data, [*by, *keep]), folded, [*by, *keep])


def closure(unfolded: DataFrame, truth: DataFrame, by: Sequence[str], gen: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Unfolded over true distribution, both normalised to 1, on the kept gen axes."""
    keys = [*by, *keep]
    return divide(normalise(project(unfolded, keys), by), normalise(project(truth, keys), by), keys)
