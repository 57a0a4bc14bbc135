"""Derived columns: kinematics, clamps, weights curves, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import Operand, col


def own_track_excess(hits: Sequence[Operand], full: int = 3) -> Column:
    """Number of prongs that themselves count as a tracklet (hits equal to ``full``)."""
    out = F.lit(0)
    for h in hits:
        out = out + F.when(col(h) == full, 1).otherwise(0)
    return out


def subtract_own_tracks(df: DataFrame, counters: Sequence[str], hits: Sequence[str]) -> DataFrame:
    """``<counter>_sub`` for every counter column the table has."""
    excess = own_track_excess(hits)
    return df.withColumns({f"{c}_sub": F.col(c) - excess for c in counters if c in df.columns})


def momentum_fraction(pt1, phi1, eta1, pt2, phi2, eta2) -> Column:
    """(p1.p2)/(p1.p1) from transverse momentum, azimuth and pseudorapidity; null for p1 = 0."""
    pt1, phi1, eta1, pt2, phi2, eta2 = map(col, (pt1, phi1, eta1, pt2, phi2, eta2))
    dot = pt1 * pt2 * (F.cos(phi1) * F.cos(phi2) + F.sin(phi1) * F.sin(phi2) + F.sinh(eta1) * F.sinh(eta2))
    return F.try_divide(dot, pt1 * pt1 * (1 + F.sinh(eta1) * F.sinh(eta1)))


def momentum_fraction_gen(pt1, phi1, eta1, pt2, dphi, deta) -> Column:
    """As above with the second direction given relative to the first."""
    return momentum_fraction(pt1, phi1, eta1, pt2, col(phi1) + col(dphi), col(eta1) - col(deta))


def _clamp(df: DataFrame, c: str, expr) -> DataFrame:
    kept = f"{c}_orig"
    if kept not in df.columns:
        df = df.withColumn(kept, F.col(c))
    return df.withColumn(c, expr(F.col(kept)))


def clamp_low(df: DataFrame, c: str, bound=0) -> DataFrame:
    """Values below the bound become the bound; the input stays in ``<c>_orig``; idempotent."""
    return _clamp(df, c, lambda v: F.when(v < bound, F.lit(bound).cast(df.schema[c].dataType)).otherwise(v))


def clamp_high(df: DataFrame, c: str, bound: float = 0.99) -> DataFrame:
    return _clamp(df, c, lambda v: F.when(v > bound, F.lit(bound)).otherwise(v))


def relative_shift(reco: Operand, gen: Operand) -> Column:
    return F.try_divide(col(reco) - col(gen), col(gen))


def difference(df: DataFrame, a: str, b: str) -> DataFrame:
    """Column literally named ``a-b``."""
    return df.withColumn(f"{a}-{b}", F.col(a) - F.col(b))


def distance(c: Operand, centre) -> Column:
    return F.abs(col(c) - centre)


def turn_on(x: Operand, p: Sequence[float]) -> Column:
    """p0 / (1 + exp(-p1 (x - p2)))."""
    return F.lit(p[0]) / (1 + F.exp(-F.lit(p[1]) * (col(x) - F.lit(p[2]))))


def polynomial(x: Operand, coeff: Sequence[Column | float]) -> Column:
    """Horner form, coefficients from the constant upwards."""
    x = col(x)
    out = F.lit(0.0)
    for c in reversed(coeff):
        out = out * x + (c if isinstance(c, Column) else F.lit(float(c)))
    return out


def bin_label(name: str, lo: Operand, hi: Operand, digits: int = 2) -> Column:
    return F.format_string(f"{name}%.{digits}f_%.{digits}f", col(lo).cast("double"), col(hi).cast("double"))


def replace_all(c: Operand, pairs: Mapping[str, str]) -> Column:
    out = col(c)
    for old, new in pairs.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def contains_any(c: Operand, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | col(c).contains(p)
    return out
