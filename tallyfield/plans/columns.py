"""Derived columns on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import derive
from .registry import query, rounded, table
from .selections import KEY, KEY_SQL, items


@query(
    "C01_own_tracks_removed",
    f"""SELECT {KEY_SQL}, l_quantity - (CAST(l_linenumber = 3 AS INTEGER) + CAST(l_linenumber - 1 = 3 AS INTEGER)) AS n_tracklets_sub FROM lineitem""",
)
def c01(spark, sf):
    df = items(spark, sf).select(*KEY, F.col("l_quantity").alias("n_tracklets"), F.col("l_linenumber").alias("hits0"),
                                 (F.col("l_linenumber") - 1).alias("hits1"))
    return derive.subtract_own_tracks(df, ["n_tracklets", "n_tracklets_corr"], ["hits0", "hits1"]).select(*KEY, "n_tracklets_sub")


def _z_sql(pt2, phi2, eta2):
    return (f"round(l_quantity * ({pt2}) * (cos(l_tax * 10) * cos({phi2}) + sin(l_tax * 10) * sin({phi2}) + sinh(l_discount * 5) * sinh({eta2}))"
            " / (l_quantity * l_quantity * (1 + sinh(l_discount * 5) * sinh(l_discount * 5))), 6)")


@query("C02_momentum_fraction", f"SELECT {KEY_SQL}, {_z_sql('l_quantity / 2 + 1', 'l_discount * 9', 'l_tax * 3')} AS z FROM lineitem")
def c02(spark, sf):
    z = derive.momentum_fraction("l_quantity", F.col("l_tax") * 10, F.col("l_discount") * 5, F.col("l_quantity") / 2 + 1,
                                 F.col("l_discount") * 9, F.col("l_tax") * 3)
    return items(spark, sf).select(*KEY, rounded(z).alias("z"))


@query(
    "C03_momentum_fraction_gen",
    f"SELECT {KEY_SQL}, {_z_sql('l_quantity / 2 + 1', 'l_tax * 10 + l_discount', 'l_discount * 5 - l_tax')} AS z_gen FROM lineitem",
)
def c03(spark, sf):
    z = derive.momentum_fraction_gen("l_quantity", F.col("l_tax") * 10, F.col("l_discount") * 5, F.col("l_quantity") / 2 + 1,
                                     "l_discount", "l_tax")
    return items(spark, sf).select(*KEY, rounded(z).alias("z_gen"))


@query(
    "C04_clamp_low",
    f"SELECT {KEY_SQL}, greatest(l_linenumber - 3, 0) AS nsd, l_linenumber - 3 AS nsd_orig FROM lineitem",
)
def c04(spark, sf):
    df = items(spark, sf).select(*KEY, (F.col("l_linenumber") - 3).alias("nsd"))
    return derive.clamp_low(derive.clamp_low(df, "nsd"), "nsd")


@query(
    "C05_clamp_high",
    f"SELECT {KEY_SQL}, least(l_quantity / 50, 0.99::DOUBLE) AS z, l_quantity / 50 AS z_orig FROM lineitem",
)
def c05(spark, sf):
    df = items(spark, sf).select(*KEY, (F.col("l_quantity") / 50).alias("z"))
    return derive.clamp_high(derive.clamp_high(df, "z"), "z")


@query(
    "C06_relative_shift",
    f"""SELECT {KEY_SQL}, round((l_extendedprice - l_quantity * p_retailprice) / (l_quantity * p_retailprice), 6) AS shift
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def c06(spark, sf):
    df = items(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return df.select(*KEY, rounded(derive.relative_shift("l_extendedprice", F.col("l_quantity") * F.col("p_retailprice"))).alias("shift"))


@query("C07_named_difference", f'SELECT {KEY_SQL}, l_extendedprice - l_quantity AS "l_extendedprice-l_quantity" FROM lineitem')
def c07(spark, sf):
    return derive.difference(items(spark, sf), "l_extendedprice", "l_quantity").select(*KEY, F.col("`l_extendedprice-l_quantity`"))


@query("C08_float_cast", f"SELECT {KEY_SQL}, CAST(l_linenumber AS DOUBLE) - 4 AS imp_par_prod FROM lineitem WHERE CAST(l_linenumber AS DOUBLE) - 4 < -0.5")
def c08(spark, sf):
    df = items(spark, sf).select(*KEY, (F.col("l_linenumber").cast("double") - 4).alias("imp_par_prod"))
    return df.where(F.col("imp_par_prod") < -0.5)


@query("C09_distance", f"SELECT {KEY_SQL}, round(abs(l_discount - 0.05), 6) AS dist FROM lineitem")
def c09(spark, sf):
    return items(spark, sf).select(*KEY, rounded(derive.distance("l_discount", 0.05)).alias("dist"))


@query(
    "C10_weight_curve",
    f"""SELECT {KEY_SQL}, round(0.9::DOUBLE / (1 + exp(-0.2::DOUBLE * (l_quantity - 20))), 6) AS turn_on,
        round(((0.00001::DOUBLE * l_quantity - 0.001) * l_quantity + 0.02) * l_quantity + 1, 6) AS cubic FROM lineitem""",
)
def c10(spark, sf):
    return items(spark, sf).select(
        *KEY, rounded(derive.turn_on("l_quantity", (0.9, 0.2, 20.0))).alias("turn_on"),
        rounded(derive.polynomial("l_quantity", (1.0, 0.02, -0.001, 0.00001))).alias("cubic"))


@query(
    "C11_string_functions",
    """SELECT p_partkey, p_type LIKE '%ECO%' OR p_type LIKE '%SMALL%' AS selected, replace(replace(p_brand, 'Brand', 'b'), '#', '_') AS brand,
              printf('pt%.2f_%.2f', CAST(p_size AS DOUBLE), p_retailprice) AS label FROM part""",
)
def c11(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", derive.contains_any("p_type", ["ECO", "SMALL"]).alias("selected"),
        derive.replace_all("p_brand", {"Brand": "b", "#": "_"}).alias("brand"),
        derive.bin_label("pt", "p_size", "p_retailprice").alias("label"))
