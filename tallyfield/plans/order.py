"""Cut scans, hash order, set operations on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import take_by_hash
from ..operators import scans
from ..sources.scan import concatenate
from .registry import query, rounded, table
from .selections import KEY, KEY_SQL, prob, PROB_SQL, items

SCAN = {"l_quantity": "lt", "l_extendedprice": "st", "l_discount": "abslt", "l_tax": "absst"}
CENTRES = {"l_discount": 0.047, "l_tax": 0.043}
LIMITS = {"l_quantity": (0.0, 60.0)}


def scan_sql(where: str) -> str:
    parts = []
    for v, d in SCAN.items():
        x = f"abs({v} - {CENTRES[v]}::DOUBLE)" if d.startswith("abs") else v
        lo, hi = LIMITS.get(v, ("min(x)", "max(x)"))
        k = "k" if "lt" in d else "k + 1"
        op = ">" if "lt" in d else "<"
        parts.append(f"""SELECT '{v}' AS variable, CAST(k AS INTEGER) AS step, round(lo + (hi - lo) / 100 * ({k}), 6) AS threshold,
            round(count(*) FILTER (x {op} lo + (hi - lo) / 100 * ({k})) / count(*), 6) AS share
            FROM (SELECT {x} AS x FROM lineitem WHERE {where}), (SELECT {lo}::DOUBLE AS lo, {hi}::DOUBLE AS hi FROM (SELECT {x} AS x FROM lineitem WHERE {where})
                  LIMIT 1), (SELECT unnest(range(100)) AS k) GROUP BY k, lo, hi""")
    return " UNION ALL ".join(parts)


def scan_rows(df):
    return scans.cut_scan(df, SCAN, CENTRES, LIMITS).select(
        "variable", "step", rounded("threshold").alias("threshold"), rounded("share").alias("share"))


@query("F01_cut_scan", scan_sql(f"{PROB_SQL} > 0.304"))
def f01(spark, sf):
    return scan_rows(items(spark, sf).where(prob() > 0.304))


@query("F02_size_scan", scan_sql("true"))
def f02(spark, sf):
    return scan_rows(items(spark, sf))


F03_VARS = ["l_quantity", "l_extendedprice"]
F03_CUTS = [0.5, 0.1, 0.3]


def _f03_sql():
    parts = []
    base = f"lineitem WHERE {PROB_SQL} > 0.103"
    for v in F03_VARS:
        lo, hi = f"(SELECT min({v}) FROM {base})", f"(SELECT max({v}) FROM {base})"
        ix = f"CAST(CASE WHEN {v} = {hi} THEN 100 ELSE floor(100 * ({v} - {lo}) / ({hi} - {lo})) + 1 END AS INTEGER)"
        for c in sorted(F03_CUTS):
            n = f"CAST(count(*) FILTER ({PROB_SQL} > {c} + 0.003) AS DOUBLE)"
            parts.append(f"SELECT '{v}' AS variable, {ix} AS ix, {c + 0.003!r}::DOUBLE AS threshold, {n} AS content, round({n} / count(*), 6) AS ratio FROM {base} GROUP BY 2")
    return " UNION ALL ".join(parts)


@query("F03_probability_scan", _f03_sql())
def f03(spark, sf):
    out = scans.probability_scan(items(spark, sf), F03_VARS, prob(), [c + 0.003 for c in F03_CUTS])
    return out.withColumn("ratio", rounded("ratio"))


HASH_SQL = "md5(concat_ws('|', '7', " + KEY_SQL + "))"


@query("F04_shuffle_first", f"SELECT {KEY_SQL} FROM lineitem ORDER BY {HASH_SQL}, {KEY_SQL} LIMIT 5000")
def f04(spark, sf):
    return take_by_hash(items(spark, sf).select(*KEY), KEY, 7, n=5000)


@query(
    "F05_shuffle_tail",
    f"""SELECT {KEY_SQL} FROM (SELECT *, row_number() OVER (ORDER BY {HASH_SQL} DESC, {KEY_SQL}) AS r, count(*) OVER () AS n FROM lineitem)
        WHERE r <= round_even(n * 0.13, 0)""",
)
def f05(spark, sf):
    return take_by_hash(items(spark, sf).select(*KEY), KEY, 7, fraction=0.13, tail=True)


@query(
    "F06_union_all",
    "SELECT o_orderkey AS key, 'order' AS kind FROM orders UNION ALL SELECT l_orderkey, 'item' FROM lineitem",
)
def f06(spark, sf):
    return concatenate(table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind")),
                       table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.lit("item").alias("kind")))


@query(
    "F07_best_of",
    """WITH s AS (SELECT l_returnflag, l_linenumber, avg(l_extendedprice) AS score FROM lineitem GROUP BY ALL)
       SELECT l_returnflag, arg_max(l_linenumber, score) AS best, round(max(score), 4) AS best_score FROM s GROUP BY 1""",
)
def f07(spark, sf):
    scores = items(spark, sf).groupBy("l_returnflag", "l_linenumber").agg(F.avg("l_extendedprice").alias("score"))
    return scans.best_by(scores, ["l_returnflag"], "l_linenumber", "score").withColumn("best_score", rounded("best_score", 4))
