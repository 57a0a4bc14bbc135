"""Least-squares fits of a peak on a background, for any number of groups at once.

The model is a Gaussian on a line, a parabola or an exponential.  Every round of the Gauss-Newton
iteration is one aggregation over the bins of all groups, which fills the normal equations, and one
projection, which solves them by a square-root-free Cholesky decomposition in column expressions.  The state
between rounds is one row of parameters per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bins import Uniform
from ..session import stored

#: Terms of the background by name.
BACKGROUNDS = {"none": 0, "constant": 1, "line": 2, "parabola": 3, "exponential": 2}
DAMPING = (1.0, 0.3, 0.1, 0.03, 0.01)  # of the first rounds; later ones are undamped


def decompose(n: int, matrix: str = "n") -> list[tuple[str, str]]:
    """Named expressions d0.. and l1_0.. with matrix = l d l^T, from columns n{i}_{j} with i >= j, each using earlier ones."""
    out = []
    for j in range(n):
        out.append((f"d{j}", f"{matrix}{j}_{j}" + "".join(f" - l{j}_{k} * l{j}_{k} * d{k}" for k in range(j))))
        for i in range(j + 1, n):
            top = f"{matrix}{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k} * d{k}" for k in range(j))
            out.append((f"l{i}_{j}", f"({top}) / nullif(d{j}, 0)"))
    return out


def forward(n: int, right: Sequence[str], name: str) -> list[tuple[str, str]]:
    """l y = right."""
    return [(f"{name}{i}", right[i] + "".join(f" - l{i}_{k} * {name}{k}" for k in range(i))) for i in range(n)]


def backward(n: int, y: str, name: str) -> list[tuple[str, str]]:
    """d l^T x = y."""
    return [(f"{name}{i}", f"{y}{i} / nullif(d{i}, 0)" + "".join(f" - l{k}_{i} * {name}{k}" for k in range(i + 1, n))) for i in reversed(range(n))]


def product(n: int, a: str, b: str) -> str:
    """a^T matrix^-1 b of two vectors after `forward`."""
    return "(" + " + ".join(f"{a}{i} * {b}{i} / nullif(d{i}, 0)" for i in range(n)) + ")"


def with_named(df: DataFrame, named: Sequence[tuple[str, str]]) -> DataFrame:
    """All columns and the named expressions, which may use earlier ones."""
    return df.selectExpr("*", *[f"{e} AS {k}" for k, e in named])


def names_of(background: str) -> list[str]:
    return ["height", "u", "s", *(f"c{k}" for k in range(BACKGROUNDS[background]))]


def model_and_slopes(background: str) -> tuple[str, list[str]]:
    """Value of the model at t, and its derivatives by the parameters, as expressions."""
    z, terms = "((t - u) / s)", BACKGROUNDS[background]
    bell = f"exp(-0.5 * {z} * {z})"
    if background == "exponential":
        below = "exp(c0 + c1 * t)"
        slopes = [below, f"{below} * t"]
    else:
        slopes = ["1D", "t", "t * t"][:terms]
        below = " + ".join(f"c{k} * {p}" for k, p in enumerate(slopes)) or "0D"
    return f"height * {bell} + {below}", [bell, f"height * {bell} * {z} / s", f"height * {bell} * {z} * {z} / s", *slopes]


def normal_equations(points: DataFrame, by: Sequence[str], background: str) -> DataFrame:
    """(by..., n{i}_{j}, g{i}, chi2, n_points) of the current parameters: one aggregation."""
    value, slopes = model_and_slopes(background)
    n = len(slopes)
    rows = points.selectExpr(*by, "w", f"y - ({value}) AS r", *[f"{e} AS q{i}" for i, e in enumerate(slopes)])
    sums = [F.expr(f"sum(w * q{i} * q{j})").alias(f"n{i}_{j}") for i in range(n) for j in range(i + 1)]
    return rows.groupBy(*by).agg(*sums, *[F.expr(f"sum(w * q{i} * r)").alias(f"g{i}") for i in range(n)], F.expr("sum(w * r * r)").alias("chi2"), F.count("*").alias("n_points"))


def peak_fit(
    hist: DataFrame, by: Sequence[str], axis: Uniform, start: DataFrame, background: str = "line", rounds: int = 12,
    keep: Column | None = None, tolerance: float = 1e-3,
) -> DataFrame:
    """Gaussian and background through the bins: one row per group of `start` (by..., mean, sigma).

    Returns by..., height, mean, sigma, c0.. (background in t = (x - centre) / half width), their errors, signal
    (area of the Gaussian in entries) and signal_err, chi2, ndf, edm and converged.  Bins with no variance and bins
    outside `keep` (a condition on x) are left out.  A step changes the width by a factor of 3 and the
    mean by two widths at most.  edm is the expected fall of chi2 by one more step; a fit has converged when that is below
    `tolerance` and the peak is not wider than the axis.  Groups with fewer bins than parameters, or singular ones, have null parameters.
    """
    names, centre, half = names_of(background), (axis.lo + axis.hi) / 2, (axis.hi - axis.lo) / 2
    n = len(names)
    x = axis.centre("ix")
    bins = hist.where(F.col("ix").between(1, axis.n) & (F.col("sumw2") > 0)).select(*by, x.alias("x"), F.col("content").alias("y"), (1 / F.col("sumw2")).alias("w"))
    bins = stored(bins.where(keep if keep is not None else F.lit(True)).select(*by, ((F.col("x") - centre) / half).alias("t"), "y", "w"), "fit-bins")
    tops = bins.groupBy(*by).agg(F.max("y").alias("top"), F.greatest(F.min("y"), F.max("y") * 1e-3).alias("floor"))
    first = start.select(*by, ((F.col("mean") - centre) / half).alias("u"), (F.col("sigma") / half).alias("s")).join(tops, list(by))
    begin = {f"c{k}": F.lit(0.0) for k in range(BACKGROUNDS[background])} | ({"c0": F.ln(F.greatest("floor", F.lit(1e-300)))} if background == "exponential" else {})
    state = stored(first.select(*by, F.col("top").cast("double").alias("height"), "u", "s", *[c.alias(k) for k, c in begin.items()]), "fit-start")
    for turn in range(rounds):
        damping = DAMPING[turn] if turn < len(DAMPING) else 0.0
        sums = normal_equations(bins.join(state, list(by)), by, background)
        damped = sums.selectExpr(*by, "n_points", *[f"n{i}_{j} * {1 + damping if i == j else 1.0!r}D AS n{i}_{j}" for i in range(n) for j in range(i + 1)], *[f"g{i}" for i in range(n)])
        solved = with_named(damped, [*decompose(n), *forward(n, [f"g{i}" for i in range(n)], "y"), *backward(n, "y", "x")])
        step = {k: f"{k} + x{i}" for i, k in enumerate(names)}
        step |= {"u": "u + greatest(-2 * s, least(2 * s, x1))", "s": "greatest(s / 3, least(3 * s, s + x2))"}
        enough = f"CASE WHEN n_points >= {n} AND " + " AND ".join(f"x{i} IS NOT NULL" for i in range(n))
        state = stored(state.join(solved, list(by)).selectExpr(*by, *[f"{enough} THEN {step[k]} END AS {k}" for k in names]), "fit-state")
    last = normal_equations(bins.join(state, list(by)), by, background)
    units = [(f"e{p}_", [("1D" if i == p else "0D") for i in range(n)]) for p in range(n)]
    grow = f"sqrt(2 * pi()) * {half / axis.width!r}D"
    area = [f"{grow} * s" if i == 0 else f"{grow} * height" if i == 2 else "0D" for i in range(n)]
    full = with_named(state.join(last, list(by)), [
        *decompose(n), *forward(n, [f"g{i}" for i in range(n)], "y"), *[x for name, unit in units for x in forward(n, unit, name)], *forward(n, area, "a"),
        ("edm", product(n, "y", "y")),
    ])
    errors = [f"sqrt({product(n, f'e{p}_', f'e{p}_')})" for p in range(n)]
    size = {"u": half, "s": half}
    shown = {"u": "mean", "s": "sigma"}
    values = {"height": "height", "u": f"{centre!r}D + u * {half!r}D", "s": f"s * {half!r}D"}
    return full.selectExpr(
        *by, *[f"{values.get(k, k)} AS {shown.get(k, k)}" for k in names], *[f"{e} * {size.get(k, 1.0)!r}D AS {shown.get(k, k)}_err" for k, e in zip(names, errors)],
        f"height * s * {grow} AS signal", f"sqrt({product(n, 'a', 'a')}) AS signal_err", "chi2", f"CAST(n_points - {n} AS BIGINT) AS ndf", "edm",
        f"coalesce(edm < {tolerance!r}D AND s < 2 AND n_points > {n}, false) AS converged",
    )


def curve_error(n: int, sums: Sequence[str], weights: Sequence[str]) -> list[tuple[str, str]]:
    """Named expressions ending in `variance`: of sum_k weights[k] c_k, for a polynomial fitted with power sums `sums`."""
    cells = [(f"n{i}_{j}", sums[i + j]) for i in range(n) for j in range(i + 1)]
    return [*cells, *decompose(n), *forward(n, list(weights), "y"), ("variance", product(n, "y", "y"))]
