"""Row predicates as column expressions.

Spark orders NaN above every number and makes ``NaN = NaN`` true, whereas an
event selection must drop a row whose cut variable is NaN.  ``gt``, ``ge`` and
``eq`` carry the guard; ``<`` and ``<=`` drop NaN by themselves.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Operand = Column | str


def col(c: Operand) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gt(c: Operand, bound) -> Column:
    c = col(c)
    return (c > bound) & ~F.isnan(c)


def ge(c: Operand, bound) -> Column:
    c = col(c)
    return (c >= bound) & ~F.isnan(c)


def eq(c: Operand, value) -> Column:
    c = col(c)
    return (c == value) & ~F.isnan(c)


def half_open(c: Operand, lo, hi) -> Column:
    """``lo <= c < hi``; the upper bound already drops NaN."""
    c = col(c)
    return (c >= lo) & (c < hi)


def closed(c: Operand, lo, hi) -> Column:
    return col(c).between(lo, hi)


def open_range(c: Operand, lo, hi) -> Column:
    c = col(c)
    return (c > lo) & (c < hi)


def near(c: Operand, centre, width) -> Column:
    """``|c - centre| <= width``."""
    return F.abs(col(c) - centre) <= width


def linear_cut(c: Operand, lo, hi, absolute: bool = False) -> Column:
    c = col(c)
    return open_range(F.abs(c) if absolute else c, lo, hi)


def all_of(parts: Iterable[Column | None]) -> Column:
    """Conjunction that skips switched-off (None) stages."""
    out = F.lit(True)
    for part in parts:
        if part is not None:
            out = out & part
    return out


#: Strings, quoted and plain names, parameters, comparisons, other characters.
_TOKENS = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]+`|@[A-Za-z_]\w*|[A-Za-z_][\w.]*|[0-9][\w.]*|<=>|==|!=|<>|<=|>=|\s+|.""", re.S)


def float_columns(df: DataFrame) -> set[str]:
    return {n for n, t in df.dtypes if t in ("double", "float")}


def _literal(value) -> str:
    if isinstance(value, (list, tuple)):
        return "(" + ", ".join(map(_literal, value)) + ")"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else repr(value)


def nan_safe(condition: str, floats: Collection[str], params: Mapping[str, object] | None = None) -> str:
    """The condition with the comparison rules of NaN: no comparison holds, except ``!=``, which always does.

    The guard sits inside each comparison: a NaN column counts as NULL, ``!=`` becomes
    IS DISTINCT FROM, and the operand of NOT is false where it is NULL.  ``@name``
    stands for a parameter.  Two NaN compared by ``!=`` count as equal.
    """
    tokens = _TOKENS.findall(condition)
    out = []
    for i, t in enumerate(tokens):
        if t.startswith("@"):
            out.append(_literal((params or {})[t[1:]]))
        elif t in ("!=", "<>"):
            out.append(" is distinct from ")
        elif t.strip("`") in floats and not (i + 1 < len(tokens) and tokens[i + 1] == "("):
            out.append(f"nanvl(`{t.strip('`')}`, null)")
        else:
            out.append(t)
    return _guard_not([t for t in out])


def _guard_not(tokens: list[str]) -> str:
    """Wrap the operand of every prefix NOT, which reaches to the next AND or OR of its level."""
    out, i, before = [], 0, ""
    while i < len(tokens):
        word = tokens[i].lower()
        if word == "not" and before in ("", "(", "and", "or", "not"):
            depth, between, j = 0, False, i + 1
            while j < len(tokens):
                t = tokens[j].lower()
                if t == "(":
                    depth += 1
                elif t == ")":
                    depth -= 1
                    if depth < 0:
                        break
                elif depth == 0 and t == "between":
                    between = True
                elif depth == 0 and t in ("and", "or"):
                    if not (between and t == "and"):
                        break
                    between = False
                j += 1
            out.append(f"not coalesce(({_guard_not(tokens[i + 1 : j])}), false) ")
            i, before = j, ")"
            continue
        out.append(tokens[i])
        if word.strip():
            before = word.strip()
        i += 1
    return "".join(out)


def condition(query: str, floats: Collection[str], params: Mapping[str, object] | None = None) -> Column:
    """A user-written condition as a column that is never NULL; see `nan_safe`."""
    return F.coalesce(F.expr(nan_safe(query, floats, params)), F.lit(False))


def select_rows(df: DataFrame, query: str | None, params: Mapping[str, object] | None = None) -> DataFrame:
    """Filter by a user-written SQL condition; None keeps everything.

    NaN follows `nan_safe`.  A condition without NOT, ``!=`` and calls is also applied as it is
    written: it keeps whatever the safe one keeps, and reaches the Parquet reader.
    """
    if query is None:
        return df
    floats = float_columns(df)
    safe = nan_safe(query, floats, params)
    if safe == query:
        return df.where(query)
    plain = nan_safe(query, (), params)
    words = _TOKENS.findall(query)
    called = any(b == "(" and re.match(r"[A-Za-z_]", a) and a.lower() not in ("and", "or", "in") for a, b in zip(words, words[1:]))
    negated = any(w.lower() in ("not", "!=", "<>", "!", "is", "case", "<=>") for w in words)
    return (df if called or negated else df.where(plain)).where(condition(query, floats, params))


def per_bin(bin_index: Operand, queries: Sequence[str | None], of: DataFrame | None = None) -> Column:
    """One condition per bin number 0..n-1 in a single expression; None keeps the bin.

    Rows outside all bins are dropped.  ``of`` is the table the conditions are about: its
    floating-point columns follow `nan_safe`.
    """
    chosen = F.lit(False)
    b, floats = col(bin_index), float_columns(of) if of is not None else ()
    for i, q in enumerate(queries):
        chosen = F.when(b == i, F.lit(True) if q is None else condition(q, floats)).otherwise(chosen)
    return chosen


def require_per_bin(queries: Sequence, n_bins: int) -> None:
    if len(queries) != n_bins:
        raise ValueError(f"{len(queries)} selections for {n_bins} bins")


def working_point(label_probs: Sequence[Operand], cuts: Sequence[Column | float]) -> Column:
    """Background-like probability at most ``cuts[0]``, signal-like at least ``cuts[1]``."""
    return (col(label_probs[0]) <= cuts[0]) & ge(label_probs[1], cuts[1])


def chosen_by_bin(bin_index: Operand, values: Mapping[int, float]) -> Column:
    """Literal looked up by bin number (cut tables are configuration, tens of entries)."""
    out = F.lit(None).cast("double")
    for i, v in values.items():
        out = F.when(col(bin_index) == i, F.lit(float(v))).otherwise(out)
    return out


def any_below(columns: Sequence[Operand], cut: float) -> Column:
    """At least one of the columns is below the cut; NaN never is."""
    out = F.lit(False)
    for c in columns:
        out = out | (col(c) < cut)
    return out


def pid_all_tracks(tracks: Sequence[Sequence[Operand]], n_sigma: float) -> Column:
    """Every track needs one of its detector responses below ``n_sigma``."""
    return all_of([any_below(t, n_sigma) for t in tracks])


def fiducial(pt: Operand, y: Operand) -> Column:
    """Rapidity acceptance: flat above pt 5, parabolic below.

    Fixed values of the parabola: -0.2/15, 1.9/15, 0.5; flat limit 0.8.
    """
    pt, y = col(pt), F.abs(col(y))
    limit = F.lit(-0.2 / 15) * pt * pt + F.lit(1.9 / 15) * pt + F.lit(0.5)
    return F.when(pt > 5, y < 0.8).otherwise(y < limit)


def displaced(d0, d0_err, decay_len, norm_decay_len, pt, eta) -> Column:
    """Topological requirement on two prongs and the decay length.

    Fixed values: 0.5 for both impact-parameter significances, decay length at
    least min(0.0066 p + 0.01, 0.06) with p = pt cosh(eta), and 1 for the
    normalised decay length.  A zero error gives an infinite significance,
    which passes, unless the parameter is zero as well (0/0 is no number).
    """
    def significant(v, e):
        v, e = F.abs(col(v)), F.abs(col(e))
        return F.when(e == 0, v > 0).otherwise(ge(F.try_divide(v, e), 0.5))

    momentum = col(pt) * F.cosh(col(eta))
    least_len = F.least(momentum * 0.0066 + 0.01, F.lit(0.06))
    return all_of(
        [significant(v, e) for v, e in zip(d0, d0_err)]
        + [ge(decay_len, least_len), ge(F.abs(col(norm_decay_len)), 1.0)]
    )
