"""Bin algebra, folding and unfolding on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import first_bin, inside
from ..functions.hashing import in_fraction
from ..operators import algebra, hist
from ..session import stored
from .registry import PT, PT_HIGH, PT_LOW, SHAPE, query, rounded, sql_bin
from .selections import KEY, KEY_SQL, items
from .spectra import FINE, GEN, N, PAIRS_IN, PAIRS_SQL, RECO, TAX, VALUE_G, VALUE_R, pairs

# weighted pt spectra per class, the usual operands
SPEC_SQL = f"""(SELECT l_returnflag AS cls, {sql_bin('l_quantity', PT)} AS ix, sum(l_tax + 0.5) AS c, sum((l_tax + 0.5) * (l_tax + 0.5)) AS v
               FROM lineitem GROUP BY ALL)"""
AB_SQL = f"(SELECT a.ix, a.c AS a, a.v AS va, b.c AS b, b.v AS vb FROM {SPEC_SQL} a JOIN {SPEC_SQL} b ON a.ix = b.ix AND a.cls = 'A' AND b.cls = 'R')"


def spec(spark, sf):
    """Both operands by one aggregation."""
    flag = F.col("l_returnflag")
    df = items(spark, sf).withColumn("w", F.col("l_tax") + 0.5)
    h = hist.fill_classes(df, [("l_quantity", PT)], {"a": flag == "A", "r": flag == "R"}, weight="w")
    return algebra.operands(h, ["ix"], "a", "r")


def out(df, keys, digits=6):
    return df.select(*keys, rounded("content", digits).alias("content"), rounded("sumw2", digits).alias("sumw2"))


@query("G01_add", f"SELECT ix, round(a - 0.5 * b, 6) AS content, round(va + 0.25 * vb, 6) AS sumw2 FROM {AB_SQL}")
def g01(spark, sf):
    return out(algebra.add(spec(spark, sf), None, ["ix"], -0.5), ["ix"])


@query("G02_multiply", f"SELECT ix, round(a * b, 2) AS content, round(va * b * b + vb * a * a, 0) AS sumw2 FROM {AB_SQL}")
def g02(spark, sf):
    h = algebra.multiply(spec(spark, sf), None, ["ix"])
    return h.select("ix", rounded("content", 2).alias("content"), rounded("sumw2", 0).alias("sumw2"))


@query("G03_divide", f"SELECT ix, round(a / b, 6) AS content, round((va * b * b + vb * a * a) / (b * b * b * b), 9) AS sumw2 FROM {AB_SQL}")
def g03(spark, sf):
    h = algebra.divide(spec(spark, sf), None, ["ix"])
    return h.select("ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


EFF_SQL = f"""(SELECT l_returnflag, {sql_bin('l_quantity', PT)} AS ix, count(*) FILTER (l_linestatus = 'F') AS num, count(*) AS den FROM lineitem GROUP BY ALL)"""


@query("G04_divide_binomial", f"SELECT l_returnflag, ix, round(num / den, 6) AS content, round(num / den * (1 - num / den) / den, 9) AS sumw2 FROM {EFF_SQL}")
def g04(spark, sf):
    keys = ["l_returnflag", "ix"]
    both = hist.fill_classes(items(spark, sf), [("l_quantity", PT)], {"num": F.col("l_linestatus") == "F", "den": F.lit(True)}, ["l_returnflag"])
    h = algebra.divide_binomial(algebra.operands(both, keys, "num", "den"), None, keys)
    return h.select("l_returnflag", "ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


@query("G05_efficiency", "SELECT l_returnflag, round(n / d, 6) AS eff, round(sqrt(n / d * (1 - n / d) / d), 6) AS err FROM (SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS n, count(*) AS d FROM lineitem GROUP BY 1)")
def g05(spark, sf):
    c = items(spark, sf).groupBy("l_returnflag").agg(F.count_if(F.col("l_linestatus") == "F").alias("n"), F.count("*").alias("d"))
    eff, err = algebra.efficiency("n", "d")
    return c.select("l_returnflag", rounded(eff).alias("eff"), rounded(err).alias("err"))


@query(
    "G06_divide_lists",
    f"""SELECT a.l_linestatus, a.ix, round(0.5 * a.n / (2 * b.n), 6) AS content, round((0.25 * a.n * (4 * b.n * b.n) + 4 * b.n * (0.25 * a.n * a.n)) / (16 * pow(b.n, 4)), 9) AS sumw2
        FROM (SELECT l_linestatus, {sql_bin('l_quantity', PT)} AS ix, {N} AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL) a
        JOIN (SELECT l_linestatus, {sql_bin('l_quantity', PT)} AS ix, {N} AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL) b USING (l_linestatus, ix)""",
)
def g06(spark, sf):
    flag = F.col("l_returnflag")
    fine = hist.fill(items(spark, sf).where(flag.isin("A", "N")), [("l_quantity", FINE)], ["l_returnflag", "l_linestatus"])
    h = algebra.divide_lists(fine, None, ["l_linestatus", "ix"], (FINE, PT), (0.5, 2.0), (flag == "A", flag == "N"))
    return h.select("l_linestatus", "ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


@query(
    "G07_divide_correlated",
    f"SELECT ix, round(num / den, 6) AS content, round(pow(num / den, 2) * abs(num / pow(num, 2) - den / pow(den, 2)), 9) AS sumw2 FROM {EFF_SQL} WHERE l_returnflag = 'A'",
)
def g07(spark, sf):
    li = items(spark, sf).where(F.col("l_returnflag") == "A")
    both = hist.fill_classes(li, [("l_quantity", PT)], {"num": F.col("l_linestatus") == "F", "den": F.lit(True)})
    h = algebra.divide_correlated(algebra.operands(both, ["ix"], "num", "den"), None, ["ix"])
    return h.select("ix", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


IN_R = "ix_r BETWEEN 1 AND 4 AND iy_r BETWEEN 1 AND 4"
IN_G = "ix_g BETWEEN 1 AND 3 AND iy_g BETWEEN 1 AND 3"


def pair_cube(spark, sf, halves=False):
    """Counts per (ipt, class, status, reco bins, gen bins) including flow bins: one scan of the pairs.

    ``halves`` adds the closure-test half, which costs a digest per row.
    """
    p = pairs(spark, sf).withColumns({
        "ipt": first_bin("l_quantity", PT_LOW, PT_HIGH), **{n: a.index(x) for n, (x, a) in zip(R_KEYS + G_KEYS, RECO + GEN)}})
    groups = ["ipt", "l_returnflag", "l_linestatus", *R_KEYS, *G_KEYS]
    if halves:
        p, groups = p.withColumn("is_test", in_fraction(KEY, 0.5, 3)), [*groups, "is_test"]
    return stored(p.groupBy(*groups).agg(F.count("*").cast("double").alias("content")).withColumn("sumw2", F.col("content")), "pairs")


G_KEYS, R_KEYS = ["ix_g", "iy_g"], ["ix_r", "iy_r"]


def seen():
    """Inside both reconstructed ranges."""
    return inside("ix_r", SHAPE) & inside("iy_r", VALUE_R)


def made():
    """Inside both generated ranges."""
    return inside("ix_g", TAX) & inside("iy_g", VALUE_G)


def kinematic(cube, level="gen"):
    """Share of pairs inside both ranges among those inside the range of one level."""
    keys, own, other = (G_KEYS, made(), seen()) if level == "gen" else (R_KEYS, seen(), made())
    c = cube.where(own).groupBy(*keys).agg(F.sum(F.when(other, F.col("content")).otherwise(0.0)).alias("n"), F.sum("content").alias("d"))
    n, d = F.col("n"), F.col("d")
    return c.select(*keys, algebra.ratio(n, d).alias("content"), algebra.binomial_variance(n, n, d, d).alias("sumw2"))


def response(cube, *by):
    return cube.where(seen() & made()).groupBy(*by, *R_KEYS, *G_KEYS).agg(F.sum("content").alias("w"))


def gen_level(cube, by=()):
    return hist.project(cube, [*by, *G_KEYS], made())


def reco_level(cube, by=()):
    return hist.project(cube, [*by, *R_KEYS], seen())


def measured(cube):
    return reco_level(cube.where(F.col("l_returnflag") == "N"))


IN_R = "ix_r BETWEEN 1 AND 4 AND iy_r BETWEEN 1 AND 4"
IN_G = "ix_g BETWEEN 1 AND 3 AND iy_g BETWEEN 1 AND 3"


@query(
    "G08_kinematic_efficiency",
    f"""SELECT ix_g, iy_g, round(count(*) FILTER ({IN_R}) / count(*), 6) AS content,
               round(count(*) FILTER ({IN_R}) / count(*) * (1 - count(*) FILTER ({IN_R}) / count(*)) / count(*), 9) AS sumw2
        FROM {PAIRS_SQL} WHERE {IN_G} GROUP BY ALL""",
)
def g08(spark, sf):
    h = kinematic(pair_cube(spark, sf))
    return h.select("ix_g", "iy_g", rounded("content").alias("content"), rounded("sumw2", 9).alias("sumw2"))


RESP_SQL = f"(SELECT ix_r, iy_r, ix_g, iy_g, {N} AS w FROM {PAIRS_SQL} WHERE {PAIRS_IN} GROUP BY ALL)"
P_SQL = f"(SELECT *, w / sum(w) OVER (PARTITION BY ix_g, iy_g) AS p FROM {RESP_SQL})"
GEN_SQL = f"(SELECT ix_g, iy_g, {N} AS c, {N} AS v FROM {PAIRS_SQL} WHERE {IN_G} AND l_returnflag = 'R' GROUP BY ALL)"
FOLD_SQL = f"(SELECT ix_r, iy_r, sum(c * p) AS c, sum(v * p * p) AS v FROM {GEN_SQL} JOIN {P_SQL} USING (ix_g, iy_g) GROUP BY ALL)"


@query("G09_fold", f"SELECT ix_r, iy_r, round(c, 6) AS content, round(v, 6) AS sumw2 FROM {FOLD_SQL}")
def g09(spark, sf):
    cube = pair_cube(spark, sf)
    gen = gen_level(cube.where(F.col("l_returnflag") == "R"))
    return out(algebra.fold(gen, response(cube), [], G_KEYS, R_KEYS), R_KEYS)


KIN_G_SQL = f"(SELECT ix_g, iy_g, count(*) FILTER ({IN_R}) / count(*) AS e FROM {PAIRS_SQL} WHERE {IN_G} GROUP BY ALL)"
KIN_R_SQL = f"(SELECT ix_r, iy_r, count(*) FILTER ({IN_G}) / count(*) AS e FROM {PAIRS_SQL} WHERE {IN_R} GROUP BY ALL)"


@query(
    "G10_folded_efficiency",
    f"""WITH g AS (SELECT {sql_bin('l_quantity', PT)} AS ipt, ix_g, iy_g, {N} AS c FROM {PAIRS_SQL} WHERE {IN_G} GROUP BY ALL),
             f AS (SELECT ipt, ix_r, iy_r, sum(c * e * p) AS c FROM g JOIN {KIN_G_SQL} USING (ix_g, iy_g) JOIN {P_SQL} USING (ix_g, iy_g) GROUP BY ALL),
             s AS (SELECT ipt, iy_r, sum(c / e) AS c FROM f JOIN {KIN_R_SQL} USING (ix_r, iy_r) GROUP BY ALL),
             r AS (SELECT {sql_bin('l_quantity', PT)} AS ipt, iy_r, {N} AS c FROM {PAIRS_SQL} WHERE {IN_R} AND l_linestatus = 'F' GROUP BY ALL)
        SELECT ipt, iy_r, round(r.c / s.c, 6) AS content FROM r JOIN s USING (ipt, iy_r)""",
)
def g10(spark, sf):
    cube = pair_cube(spark, sf).withColumn("ipt", F.col("ipt") + 1)
    gen = gen_level(cube, ["ipt"])
    reco = hist.project(reco_level(cube.where(F.col("l_linestatus") == "F"), ["ipt"]), ["ipt", "iy_r"])
    kin_g, kin_r = kinematic(cube, "gen"), kinematic(cube, "reco")
    folded = algebra.fold(algebra.scale_by(gen, kin_g, G_KEYS), response(cube), ["ipt"], G_KEYS, R_KEYS)
    seen = hist.project(algebra.scale_by(folded, kin_r, R_KEYS, "divide"), ["ipt", "iy_r"])
    eff = algebra.divide(reco, seen, ["ipt", "iy_r"]).where("content > 0")
    return eff.select("ipt", "iy_r", rounded("content").alias("content"))


def unfold_sql(resp: str, data: str, iterations: int) -> str:
    """Common table expressions of the unfolding; the result is u{iterations}(ix_g, iy_g, c, v)."""
    parts = [
        f"resp AS (SELECT ix_r, iy_r, ix_g, iy_g, w, w / sum(w) OVER (PARTITION BY ix_g, iy_g) AS p FROM {resp})",
        f"dat AS {data}",
        "u0 AS (SELECT ix_g, iy_g, sum(w) AS c FROM resp GROUP BY ALL)",
    ]
    for i in range(1, iterations + 1):
        parts.append(f"""m{i} AS (SELECT ix_r, iy_r, ix_g, iy_g, p * c / sum(p * c) OVER (PARTITION BY ix_r, iy_r) AS q FROM resp JOIN u{i - 1} USING (ix_g, iy_g))""")
        parts.append(f"u{i} AS (SELECT ix_g, iy_g, sum(q * d.c) AS c, sum(q * q * d.v) AS v FROM m{i} JOIN dat d USING (ix_r, iy_r) GROUP BY ALL)")
    return "WITH " + ", ".join(parts)


def measured_sql(where: str) -> str:
    return f"(SELECT ix_r, iy_r, {N} AS c, {N} AS v FROM {PAIRS_SQL} WHERE {IN_R} AND {where} GROUP BY ALL)"


DATA_SQL = measured_sql("l_returnflag = 'N'")


@query("G11_unfold", unfold_sql(RESP_SQL, DATA_SQL, 4) + " SELECT ix_g, iy_g, round(c, 4) AS content, round(v, 4) AS sumw2 FROM u4")
def g11(spark, sf):
    cube = pair_cube(spark, sf)
    return out(algebra.unfold(measured(cube), response(cube), [], G_KEYS, R_KEYS, 4), G_KEYS, 4)


def covariance_sql() -> str:
    """Two rounds: derivatives of the second round's contents through the first round's."""
    ge = "ix_g, iy_g"
    return unfold_sql(RESP_SQL, DATA_SQL, 2) + f""", q1 AS (SELECT m.*, d.c AS d, d.v FROM m1 m JOIN dat d USING (ix_r, iy_r)), q2 AS (SELECT m.*, d.c AS d, d.v, u.c AS u FROM m2 m JOIN dat d USING (ix_r, iy_r) JOIN u1 u USING ({ge})),
      k AS (SELECT a.ix_g, a.iy_g, b.ix_g AS hx, b.iy_g AS hy, sum(a.q * a.d * b.q / b.u) AS k FROM q2 a JOIN q2 b USING (ix_r, iy_r) GROUP BY ALL),
      j AS (SELECT ix_g, iy_g, ix_r, iy_r, sum(s) AS s FROM (
        SELECT {ge}, ix_r, iy_r, q AS s FROM q2
        UNION ALL SELECT {ge}, ix_r, iy_r, q1.q * u2.c / u1.c FROM q1 JOIN u1 USING ({ge}) JOIN u2 USING ({ge})
        UNION ALL SELECT k.ix_g, k.iy_g, q1.ix_r, q1.iy_r, -k.k * q1.q FROM k JOIN q1 ON q1.ix_g = k.hx AND q1.iy_g = k.hy) GROUP BY ALL)
      SELECT a.ix_g, a.iy_g, b.ix_g AS ix_g_2, b.iy_g AS iy_g_2, round(sum(a.s * b.s * d.v), 3) AS covariance FROM j a JOIN j b USING (ix_r, iy_r) JOIN dat d USING (ix_r, iy_r) GROUP BY ALL"""


@query("G11_unfold_covariance", covariance_sql())
def g11_covariance(spark, sf):
    cube = pair_cube(spark, sf)
    found = algebra.unfold_covariance(measured(cube), response(cube), [], G_KEYS, R_KEYS, 2)
    return found.select(*G_KEYS, *[f"{c}_2" for c in G_KEYS], rounded("covariance", 3).alias("covariance"))


@query(
    "G12_refold",
    unfold_sql(RESP_SQL, DATA_SQL, 3) + """, f AS (SELECT iy_r, sum(c * p) AS c FROM u3 JOIN resp USING (ix_g, iy_g) GROUP BY 1),
       d AS (SELECT iy_r, sum(c) AS c FROM dat GROUP BY 1) SELECT iy_r, round(d.c / f.c, 6) AS content FROM d JOIN f USING (iy_r)""",
)
def g12(spark, sf):
    cube = pair_cube(spark, sf)
    data, resp = measured(cube), response(cube)
    unfolded = algebra.unfold(data, resp, [], G_KEYS, R_KEYS, 3)
    h = algebra.refold(unfolded, data, resp, [], G_KEYS, R_KEYS, ["iy_r"])
    return h.select("iy_r", rounded("content").alias("content"))


HALF_SQL = f"CAST('0x' || substr(md5(concat_ws('|', '3', {KEY_SQL})), 1, 8) AS BIGINT) < 2147483648"


@query(
    "G13_closure",
    unfold_sql(f"(SELECT ix_r, iy_r, ix_g, iy_g, {N} AS w FROM {PAIRS_SQL} WHERE {PAIRS_IN} AND NOT ({HALF_SQL}) GROUP BY ALL)",
               f"(SELECT ix_r, iy_r, {N} AS c, {N} AS v FROM {PAIRS_SQL} WHERE {PAIRS_IN} AND {HALF_SQL} GROUP BY ALL)", 3)
    + f""", t AS (SELECT iy_g, {N} AS c FROM {PAIRS_SQL} WHERE {PAIRS_IN} AND {HALF_SQL} GROUP BY 1), u AS (SELECT iy_g, sum(c) AS c FROM u3 GROUP BY 1)
         SELECT iy_g, round((u.c / (SELECT sum(c) FROM u)) / (t.c / (SELECT sum(c) FROM t)), 6) AS content FROM u JOIN t USING (iy_g)""",
)
def g13(spark, sf):
    both = response(pair_cube(spark, sf, halves=True), "is_test")
    train, test = both.where("not is_test").drop("is_test"), both.where("is_test")
    pseudo = test.groupBy(*R_KEYS).agg(F.sum("w").alias("content"), F.sum("w").alias("sumw2"))
    truth = test.groupBy(*G_KEYS).agg(F.sum("w").alias("content"), F.sum("w").alias("sumw2"))
    unfolded = algebra.unfold(pseudo, train, [], G_KEYS, R_KEYS, 3)
    h = algebra.closure(unfolded, truth, [], G_KEYS, ["iy_g"])
    return h.select("iy_g", rounded("content").alias("content"))


@query("G37_clip_negative", f"SELECT ix, round(greatest(a - b, 0), 6) AS content, round(CASE WHEN a - b <= 0 THEN 0 ELSE va + vb END, 6) AS sumw2 FROM {AB_SQL}")
def g37(spark, sf):
    h = algebra.add(spec(spark, sf), None, ["ix"], -1.0)
    return out(algebra.clip_negative(h), ["ix"])
