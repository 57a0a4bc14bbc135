"""User functions, user queries and variation tables on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.predicates import condition, float_columns
from ..operators import hist, variations
from .registry import PT, query, sql_bin
from .selections import items
from .spectra import N


def heavy_items(df, min_price, columns):
    """An example of a user skim function."""
    return df.where(F.col("l_extendedprice") > min_price).dropDuplicates(columns).select(*columns)


@query("U01_user_skim", "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_extendedprice > 60000")
def u01(spark, sf):
    return variations.skim(items(spark, sf), heavy_items, min_price=60000, columns=["l_orderkey", "l_returnflag"])


USER = {"tight": "l_discount < 0.035 and l_quantity > 10", "loose": "l_discount < 0.085 or l_tax == 0"}


@query(
    "U02_user_queries",
    " UNION ALL ".join(f"SELECT '{k}' AS name, {sql_bin('l_quantity', PT)} AS ix, {N} AS content FROM lineitem WHERE {q.replace('==', '=')} GROUP BY 2" for k, q in USER.items()),
)
def u02(spark, sf):
    rows = items(spark, sf)
    named = F.array_compact(F.array(*[F.when(condition(q, float_columns(rows)), F.lit(k)) for k, q in USER.items()]))
    df = rows.withColumn("name", F.explode(named))
    return hist.fill(df, [("l_quantity", PT)], ["name"]).drop("sumw2")


DEFAULTS = {f"p{i}": f"{i}.50" for i in range(1, 6)}


@query(
    "U05_variations",
    f"""WITH v AS (SELECT l_returnflag AS category, l_linestatus AS variation, l_linenumber AS idx, 'p' || ix AS param,
               CASE WHEN ix = 2 THEN '#' ELSE CAST(count(*) AS VARCHAR) END AS value
               FROM (SELECT *, {sql_bin('l_quantity', PT)} AS ix FROM lineitem WHERE l_linenumber <> 7) GROUP BY l_returnflag, l_linestatus, l_linenumber, ix)
        SELECT category, variation, idx, d.param, CASE WHEN value IS NULL OR value = '#' THEN d.def ELSE value END AS value, coalesce(value <> '#', false) AS changed
        FROM (SELECT * FROM (SELECT DISTINCT category, variation, idx FROM v), (SELECT unnest({list(DEFAULTS)}) AS param, unnest({list(DEFAULTS.values())}) AS def)) d LEFT JOIN v USING (category, variation, idx, param)""",
)
def u05(spark, sf):
    ix = PT.index("l_quantity")
    v = items(spark, sf).groupBy(
        F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("variation"), F.col("l_linenumber").alias("idx"),
        F.concat(F.lit("p"), ix.cast("string")).alias("param"), ix.alias("ix"),
    ).agg(F.count("*").cast("string").alias("value"))
    v = v.withColumn("value", F.when(F.col("ix") == 2, F.lit(variations.KEEP)).otherwise(F.col("value"))).withColumn("active", F.col("idx") != 7)
    return variations.expand_variations(DEFAULTS, v)
