"""Systematic uncertainties: envelopes, categories, error budgets and their propagation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("x_low", "x_up", "y_low", "y_up")


def envelope(variations: DataFrame, central: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest upward and downward difference to the central content per bin: (keys..., content, err_up, err_down)."""
    df = variations.join(central.select(*keys, F.col("content").alias("__c")), list(keys))
    d = F.col("content") - F.col("__c")
    return df.groupBy(*keys).agg(
        F.max("__c").alias("content"), F.max(F.greatest(d, F.lit(0.0))).alias("err_up"), F.max(F.greatest(-d, F.lit(0.0))).alias("err_down"))


def combine_categories(variations: DataFrame, central: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Per category maximum or RMS of the differences, then the quadratic sum over categories.

    ``variations``: keys, category, content and the flags rms, rms_both_sides,
    symmetrise.  Differences of 0 count as upward.  Returns the tables
    (keys..., category, up, down) and (keys..., up, down).
    """
    df = variations.join(central.select(*keys, F.col("content").alias("__c")), list(keys))
    d = F.col("content") - F.col("__c")
    up, down = d >= 0, d < 0
    c = df.groupBy(*keys, "category").agg(
        F.first("rms").alias("rms"), F.first("rms_both_sides").alias("both"), F.first("symmetrise").alias("sym"),
        F.max(F.when(up, d).otherwise(0.0)).alias("max_up"), F.max(F.when(down, -d).otherwise(0.0)).alias("max_down"),
        F.avg(F.when(up, d * d)).alias("ms_up"), F.avg(F.when(down, d * d)).alias("ms_down"), F.avg(d * d).alias("ms"))
    rms_up = F.sqrt(F.coalesce(F.when(F.col("both"), F.col("ms")).otherwise(F.col("ms_up")), F.lit(0.0)))
    rms_down = F.when(F.col("both"), rms_up).otherwise(F.sqrt(F.coalesce("ms_down", F.lit(0.0))))
    c = c.withColumn("__u", F.when(F.col("rms"), rms_up).otherwise(F.col("max_up"))).withColumn(
        "__d", F.when(F.col("rms"), rms_down).otherwise(F.col("max_down")))
    top = F.greatest("__u", "__d")
    per_category = c.select(
        *keys, "category", F.when(F.col("sym"), top).otherwise(F.col("__u")).alias("up"), F.when(F.col("sym"), top).otherwise(F.col("__d")).alias("down"))
    total = per_category.groupBy(*keys).agg(
        F.sqrt(F.sum(F.col("up") * F.col("up"))).alias("up"), F.sqrt(F.sum(F.col("down") * F.col("down"))).alias("down"))
    return per_category, total


def relative(per_category: DataFrame, central: DataFrame, keys: Sequence[str]) -> DataFrame:
    df = per_category.join(central.select(*keys, F.col("content").alias("__c")), list(keys))
    return df.withColumns({s: F.try_divide(F.col(s), F.abs("__c")) for s in ("up", "down")}).drop("__c")


# fixed source names
FEEDDOWN_SOURCES = ["feeddown_mult", "feeddown_mult_spectra", "feeddown_NB"]
FEEDDOWN_IN_SPECTRA = ["feeddown_NB", "feeddown_mult_spectra"]
NOT_IN_SPECTRA = ["sigmav0", "feeddown_mult"]
UNCORRELATED = ["yield", "cut", "pid", "branching_ratio", "statunceff"]

# fixed rule per source: how the errors of numerator and denominator enter a ratio
HIGH_OVER_MINIMUM_BIAS = {
    "yield": "largest", "cut": "largest", "pid": "skip", "feeddown_mult": "numerator", "feeddown_mult_spectra": "skip",
    "trigger": "numerator", "multiplicity_interval": "numerator", "multiplicity_weights": "sum", "track": "skip",
    "ptshape": "difference", "feeddown_NB": "skip", "sigmav0": "skip", "branching_ratio": "skip", "statunceff": "sum",
}
PARTICLE_RATIO = {
    "yield": "sum", "cut": "sum", "pid": "difference", "feeddown_mult_spectra": "relative_envelope", "feeddown_mult": "skip",
    "trigger": "skip", "feeddown_NB": "absolute_envelope", "multiplicity_weights": "difference", "track": "difference",
    "ptshape": "sum", "multiplicity_interval": "third", "sigmav0": "skip", "branching_ratio": "sum", "statunceff": "sum",
}
DOUBLE_RATIO = {
    "yield": "sum", "cut": "sum", "pid": "skip", "feeddown_mult_spectra": "skip", "feeddown_mult": "skip", "trigger": "skip",
    "feeddown_NB": "skip", "multiplicity_weights": "skip", "track": "skip", "ptshape": "sum",
    "multiplicity_interval": "third", "sigmav0": "skip", "branching_ratio": "skip", "statunceff": "sum",
}
AVERAGE_UNCORRELATED = ["yield", "cut", "pid", "statunceff"]
AVERAGE_PARTIAL = ["branching_ratio"]
BRANCHING_CORRELATION = 0.5


def total(errors: DataFrame, by: Sequence[str] = ("ibin",), sources: Column | None = None) -> DataFrame:
    """Quadratic sum over sources per bin and side, optionally of chosen sources."""
    df = errors if sources is None else errors.where(sources)
    return df.groupBy(*by).agg(*[F.sqrt(F.sum(F.col(s) * F.col(s))).alias(s) for s in SIDES])


def totals(errors: DataFrame, kinds: Mapping[str, Column | None], by: Sequence[str] = ("ibin",)) -> DataFrame:
    """Several quadratic sums at once, told apart by ``kind``: one aggregation, whose few rows are spread out afterwards."""
    picked = {k: F.lit(True) if w is None else w for k, w in kinds.items()}
    wide = errors.groupBy(*by).agg(*[
        F.struct(F.max(w).alias("found"), *[F.sqrt(F.sum(F.when(w, F.col(s) * F.col(s)))).alias(s) for s in SIDES]).alias(k) for k, w in picked.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"`{k}`").alias("v")) for k in picked])
    return wide.select(*by, F.explode(rows).alias("r")).where("r.v.found").select(*by, "r.kind", *[F.col(f"r.v.{s}").alias(s) for s in SIDES])


def spectra_sources(only_feeddown: bool | None = None) -> Column:
    """Sources drawn in a spectrum; all of them, the feed-down ones, or the others."""
    drawn = ~F.col("source").isin(NOT_IN_SPECTRA)
    if only_feeddown is None:
        return drawn
    fd = F.col("source").isin(FEEDDOWN_IN_SPECTRA)
    return drawn & (fd if only_feeddown else ~fd)


def uncorrelated_sources() -> Column:
    return F.col("source").isin(UNCORRELATED)


def branching_ratio_error(errors: DataFrame) -> DataFrame:
    """One row ``br``: lower error of the last bin that has a branching-ratio entry, upper error if that is 0."""
    v = F.when(F.col("y_low") == 0, F.col("y_up")).otherwise(F.col("y_low"))
    return errors.where(F.col("source") == "branching_ratio").agg(F.coalesce(F.max_by(v, "ibin"), F.lit(0.0)).alias("br"))


def _rule(rules: Mapping[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])
    unknown = F.raise_error(F.concat(F.lit("unknown error source "), "source"))
    return F.coalesce(F.try_element_at(table, F.col("source")), unknown)


def _wanted(only_feeddown: bool | None) -> Column:
    if only_feeddown is None:
        return F.lit(True)
    fd = F.col("source").isin(FEEDDOWN_SOURCES)
    return fd if only_feeddown else ~fd


def pair_errors(tables: Mapping[str, DataFrame], columns: Sequence[str] = SIDES) -> DataFrame:
    """Error tables side by side per (source, ibin); a source missing in one table is an error."""
    out, first = None, None
    for name, t in tables.items():
        t = t.select("source", "ibin", F.struct(*columns).alias(name))
        out = t if out is None else out.join(t, ["source", "ibin"], "full")
    missing = F.lit(False)
    for name in tables:
        missing = missing | F.col(name).isNull()
    check = F.when(missing, F.raise_error(F.lit("error tables with different sources or bins")).cast("boolean")).otherwise(F.lit(True))
    return out.where(check)


def ratio_errors(
    num: DataFrame, den: DataFrame, rules: Mapping[str, str], same_simulation: bool = False, only_feeddown: bool | None = None
) -> DataFrame:
    """Error of num/den per bin and side with a correlation rule per source.

    ``largest``: maximum of both; ``sum``: quadratic sum; ``difference``:
    difference; ``numerator``: numerator only; ``third``: a third of the numerator;
    ``skip``: cancels; the envelope rules take the spread of the ratio when both
    yields move down or up together, with errors relative to the central yield or
    absolute.  The central yields come in the ``central`` column of the
    feeddown_NB rows.  With the same simulation below and above, the efficiency
    statistics of the high-multiplicity rule are subtracted instead of added.
    """
    with_centre = any(r.endswith("envelope") for r in rules.values())
    columns = [*SIDES, "central"] if with_centre else list(SIDES)
    df = pair_errors({"num": num, "den": den}, columns).withColumn("__rule", _rule(rules)).where(_wanted(only_feeddown))
    if with_centre:
        centres = df.where(F.col("source") == "feeddown_NB").select(
            "ibin", F.col("num.central").alias("__yn"), F.col("den.central").alias("__yd"))
        df = df.join(centres, "ibin", "left")
    rule = F.col("__rule")
    terms = {}
    for s in SIDES:
        n, d = F.col(f"num.{s}"), F.col(f"den.{s}")
        summed = n * n + d * d
        if same_simulation:
            summed = F.when(F.col("source") == "statunceff", F.abs(n * n - d * d)).otherwise(summed)
        big = F.greatest(n, d)
        t = (
            F.when(rule == "largest", big * big).when(rule == "sum", summed).when(rule == "difference", (n - d) * (n - d))
            .when(rule == "numerator", n * n).when(rule == "third", n * n / 9)
        )
        if with_centre and s in ("y_low", "y_up"):
            t = t.when(rule == "relative_envelope", _envelope_term(s, True)).when(rule == "absolute_envelope", _envelope_term(s, False))
        terms[s] = t.otherwise(0.0)
    return df.groupBy("ibin").agg(*[F.sqrt(F.sum(t)).alias(s) for s, t in terms.items()])


def _envelope_term(side: str, is_relative: bool) -> Column:
    yn, yd = F.col("__yn"), F.col("__yd")

    def moved(y: Column, e: Column, sign: int) -> Column:
        return y + sign * (y * e if is_relative else e)

    low = F.try_divide(moved(yn, F.col("num.y_low"), -1), moved(yd, F.col("den.y_low"), -1))
    mid = F.try_divide(yn, yd)
    high = F.try_divide(moved(yn, F.col("num.y_up"), 1), moved(yd, F.col("den.y_up"), 1))
    edge = F.least(low, mid, high) if side == "y_low" else F.greatest(low, mid, high)
    return F.coalesce(F.try_divide((mid - edge) * (mid - edge), mid * mid), F.lit(0.0))


def double_ratio_errors(
    num1: DataFrame, num2: DataFrame, den1: DataFrame, den2: DataFrame, rules: Mapping[str, str] = DOUBLE_RATIO,
    same_simulation: bool = False, bin_map: Sequence[tuple[int, int, int]] | Mapping[int, tuple[int, int]] | None = None, only_feeddown: bool | None = None,
) -> DataFrame:
    """Error of (num1/num2) / (den1/den2).

    ``bin_map`` lists (output bin, bin of both numerators, bin of both denominators); an input
    bin may serve several output bins.
    """
    if isinstance(bin_map, Mapping):
        bin_map = [(out, *ins) for out, ins in bin_map.items()]

    def mapped(t: DataFrame, part: int) -> DataFrame:
        if bin_map is None:
            return t
        # configured bins, a few dozen: each row goes to the output bins that use it
        outs = F.array_compact(F.array(*[F.when(F.col("ibin") == entry[1 + part], F.lit(entry[0])) for entry in bin_map]))
        return t.withColumn("__out", F.explode(outs)).drop("ibin").withColumnRenamed("__out", "ibin")

    df = pair_errors({"n1": mapped(num1, 0), "n2": mapped(num2, 0), "d1": mapped(den1, 1), "d2": mapped(den2, 1)})
    df = df.withColumn("__rule", _rule(rules)).where(_wanted(only_feeddown))
    aggs = []
    for s in SIDES:
        n1, n2, d1, d2 = (F.col(f"{t}.{s}") for t in ("n1", "n2", "d1", "d2"))
        four = n1 * n1 + n2 * n2 + d1 * d1 + d2 * d2
        if same_simulation:
            four = F.when(F.col("source") == "statunceff", F.abs(n1 * n1 - d1 * d1) + F.abs(n2 * n2 - d2 * d2)).otherwise(four)
        term = F.when(F.col("__rule") == "sum", four).when(F.col("__rule") == "third", d1 * d1 / 9).otherwise(0.0)
        aggs.append(F.sqrt(F.sum(term)).alias(s))
    return df.groupBy("ibin").agg(*aggs)


def channel_weights(channels: DataFrame) -> DataFrame:
    """Weights of two measurements of the same quantity per bin.

    ``channels``: ibin, and y, e, u, br, f, f_low, f_high for both channels
    (suffix 1 and 2; y null where a channel has no such bin).  The covariance of
    the relative errors has u^2 + (e/y)^2 on the diagonal and half the product of
    the branching-ratio errors off it.  The row sums of its inverse give a
    systematic weight that is combined with the statistical error once more.
    """
    r1, r2 = F.try_divide(F.col("e1"), F.col("y1")), F.try_divide(F.col("e2"), F.col("y2"))
    c11, c22 = F.col("u1") * F.col("u1") + r1 * r1, F.col("u2") * F.col("u2") + r2 * r2
    c12 = BRANCHING_CORRELATION * F.col("br1") * F.col("br2")
    det = c11 * c22 - c12 * c12
    s1, s2 = F.try_divide(c22 - c12, det), F.try_divide(c11 - c12, det)
    w1 = F.try_divide(F.lit(1.0), r1 * r1 + F.try_divide(F.lit(1.0), s1))
    w2 = F.try_divide(F.lit(1.0), r2 * r2 + F.try_divide(F.lit(1.0), s2))
    both = F.col("y1").isNotNull() & F.col("y2").isNotNull()
    return channels.withColumns({"w1": F.when(both, w1), "w2": F.when(both, w2)})


def average_channels(weighted: DataFrame) -> DataFrame:
    """Weighted average per bin; a bin of one channel passes through."""
    w1, w2 = F.col("w1"), F.col("w2")
    ws = w1 + w2

    def mean(a: Column, b: Column) -> Column:
        return F.try_divide(w1 * a + w2 * b, ws)

    def passed(name: str, both: Column) -> Column:
        return F.when(F.col("y1").isNull(), F.col(f"{name}2")).when(F.col("y2").isNull(), F.col(f"{name}1")).otherwise(both)

    e = F.try_divide(F.sqrt((w1 * F.col("e1")) * (w1 * F.col("e1")) + (w2 * F.col("e2")) * (w2 * F.col("e2"))), ws)
    f = mean(F.col("f1"), F.col("f2"))
    lows, highs = (mean(F.try_divide(F.col(f"{n}1"), F.col("f1")), F.try_divide(F.col(f"{n}2"), F.col("f2"))) for n in ("f_low", "f_high"))
    return weighted.select(
        "ibin", passed("y", mean(F.col("y1"), F.col("y2"))).alias("y"), passed("e", e).alias("e"), passed("f", f).alias("f"),
        passed("f_low", lows * f).alias("f_low"), passed("f_high", highs * f).alias("f_high"))


def average_errors(first: DataFrame, second: DataFrame, weighted: DataFrame) -> DataFrame:
    """Error table of the average: uncorrelated sources in quadrature, correlated ones linearly."""
    df = pair_errors({"a": first, "b": second}).join(weighted.select("ibin", "w1", "w2", "y1", "y2"), "ibin")
    w1, w2 = F.col("w1"), F.col("w2")
    out = []
    for s in SIDES:
        a, b = F.col(f"a.{s}") * w1, F.col(f"b.{s}") * w2
        both = (
            F.when(F.col("source").isin(AVERAGE_UNCORRELATED), F.sqrt(a * a + b * b))
            .when(F.col("source").isin(AVERAGE_PARTIAL), F.sqrt(a * a + b * b + 2 * BRANCHING_CORRELATION * a * b))
            .otherwise(a + b)
        )
        value = F.when(F.col("y1").isNull(), F.col(f"b.{s}")).when(F.col("y2").isNull(), F.col(f"a.{s}")).otherwise(F.try_divide(both, w1 + w2))
        out.append(value.alias(s))
    return df.select("source", "ibin", *out)
