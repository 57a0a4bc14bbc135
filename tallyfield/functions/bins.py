"""Axes and bin numbers.

Bin 0 is underflow, 1..n are the bins ``[low, up)``, n+1 is overflow.  NaN goes
to overflow.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import Operand, col


@dataclass(frozen=True)
class Uniform:
    n: int
    lo: float
    hi: float

    def index(self, x: Operand) -> Column:
        x = col(x).cast("double")
        b = F.width_bucket(x, F.lit(float(self.lo)), F.lit(float(self.hi)), F.lit(self.n))
        return F.when(x.isNotNull(), F.coalesce(b, F.lit(self.n + 1))).cast("int")

    def low(self, i: Operand) -> Column:
        return F.lit(float(self.lo)) + (col(i) - 1) * F.lit(self.width)

    def up(self, i: Operand) -> Column:
        return F.lit(float(self.lo)) + col(i) * F.lit(self.width)

    def centre(self, i: Operand) -> Column:
        return F.lit(float(self.lo)) + (col(i) - 0.5) * F.lit(self.width)

    def widths(self, i: Operand) -> Column:
        return F.lit(self.width)

    @property
    def width(self) -> float:
        return (self.hi - self.lo) / self.n

    @property
    def edges(self) -> list[float]:
        return [self.lo + k * self.width for k in range(self.n + 1)]

    def find(self, x: float) -> int:
        if x < self.lo:
            return 0
        if not x < self.hi:
            return self.n + 1
        return int(self.n * (x - self.lo) / (self.hi - self.lo)) + 1


@dataclass(frozen=True)
class Edges:
    values: tuple[float, ...]

    @staticmethod
    def of(*values: float) -> "Edges":
        return Edges(tuple(float(v) for v in values))

    @property
    def n(self) -> int:
        return len(self.values) - 1

    @property
    def edges(self) -> list[float]:
        return list(self.values)

    def index(self, x: Operand, strict: bool = False) -> Column:
        """Number of edges at or below x (with ``strict``: below x), by a balanced comparison tree.

        The tree needs log2(n) comparisons per row and stays inside generated
        code, unlike a lambda over an edge array.
        """
        if isinstance(x, str):
            # as text: one call to the JVM instead of several per comparison
            name, op = f"cast(`{x}` as double)", "<=" if strict else "<"

            def text(lo: int, hi: int) -> str:
                if lo == hi:
                    return str(lo)
                mid = (lo + hi) // 2
                return f"case when {name} {op} {self.values[mid]!r}D then {text(lo, mid)} else {text(mid + 1, hi)} end"

            return F.expr(f"cast(case when `{x}` is not null then {text(0, len(self.values))} end as int)")
        x = col(x).cast("double")

        def tree(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            left = x <= self.values[mid] if strict else x < self.values[mid]
            return F.when(left, tree(lo, mid)).otherwise(tree(mid + 1, hi))

        return F.when(x.isNotNull(), tree(0, len(self.values))).cast("int")

    def _pick(self, i: Operand, numbers: Sequence[float]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in numbers]), col(i).cast("int"))

    def low(self, i: Operand) -> Column:
        return self._pick(i, self.values[:-1])

    def up(self, i: Operand) -> Column:
        return self._pick(i, self.values[1:])

    def centre(self, i: Operand) -> Column:
        return self._pick(i, [(a + b) / 2 for a, b in zip(self.values, self.values[1:])])

    def widths(self, i: Operand) -> Column:
        return self._pick(i, [b - a for a, b in zip(self.values, self.values[1:])])

    def find(self, x: float) -> int:
        return bisect.bisect_right(self.values, x)


Axis = Uniform | Edges


def by_width(lo: float, hi: float, width: float) -> Uniform:
    """Uniform axis with round((hi-lo)/width) bins."""
    return Uniform(round((hi - lo) / width), lo, hi)


def inside(i: Operand, axis: Axis) -> Column:
    return col(i).between(1, axis.n)


def first_bin(c: Operand, lows: Sequence[float], highs: Sequence[float]) -> Column:
    """Number 0..n-1 of the (disjoint) bin ``[low, high)`` that holds the value; null outside."""
    out = F.lit(None).cast("int")
    c = col(c)
    for i, (lo, hi) in enumerate(zip(lows, highs)):
        out = F.when((c >= lo) & (c < hi), F.lit(i)).otherwise(out)
    return out


def overlapping_bins(c: Operand, lows, highs, closed: bool = True) -> Column:
    """Array of all bin numbers holding the value; bins may overlap.

    Bins are configuration (tens of entries), so the row is matched against
    literals; no join and no shuffle is needed.
    """
    c = col(c)
    hits = [
        F.when((c >= lo) & ((c <= hi) if closed else (c < hi)) & ~F.isnan(c.cast("double")), F.lit(i))
        for i, (lo, hi) in enumerate(zip(lows, highs))
    ]
    return F.array_compact(F.array(*hits))


def bin_mask(c: Operand, lows, highs, closed: bool = True) -> Column:
    """The same membership as one number, bit i for bin i; a compact grouping key for up to 63 bins."""
    if len(lows) > 63:
        raise ValueError("more than 63 overlapping bins")
    c, out = col(c), F.lit(0).cast("long")
    for i, (lo, hi) in enumerate(zip(lows, highs)):
        hit = (c >= lo) & ((c <= hi) if closed else (c < hi)) & ~F.isnan(c.cast("double"))
        out = out + F.when(hit, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def mask_bins(mask: Operand, n: int) -> Column:
    """Bin numbers of a mask, to be exploded after aggregation."""
    m = col(mask)
    return F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.getbit(m, i) == 1)
