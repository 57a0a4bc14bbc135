"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bins import Edges, Uniform
from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODULES = ("inputs", "selections", "columns", "matching", "spectra", "order", "ratios", "peaks", "corrections", "budgets",
           "learning", "custom")


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key``."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return QUERIES, ORACLE


# --- stand-ins: orders are events, line items are candidates -------------------------------------

PT = Edges.of(0.5, 5.5, 10.5, 20.5, 35.5, 50.5)  # l_quantity
PT_LOW, PT_HIGH = [0.5, 5.5, 10.5, 20.5, 35.5], [5.5, 10.5, 20.5, 35.5, 50.5]
SHAPE = Edges.of(-0.005, 0.025, 0.055, 0.085, 0.105)  # l_discount
MASS = Uniform(100, 900.0, 105000.0)  # l_extendedprice
# overlapping, closed second bins on o_totalprice; the last flag marks the "at least one" bins
MULT_LOW = [0.0, 1000.0, 1000.0, 100000.0, 300000.0]
MULT_HIGH = [999999.0, 999999.0, 99999.0, 299999.0, 499999.0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- pieces of SQL ---------------------------------------------------------------------------------


def sql_bin(x: str, axis) -> str:
    """Bin number in SQL."""
    if isinstance(axis, Uniform):
        return (
            f"CAST(CASE WHEN {x} < {axis.lo} THEN 0 WHEN {x} >= {axis.hi} THEN {axis.n + 1} ELSE "
            f"floor({axis.n} * ({x} - {axis.lo}) / ({axis.hi} - {axis.lo})) + 1 END AS INTEGER)"
        )
    return "(" + " + ".join(f"CAST({x} >= {e} AS INTEGER)" for e in axis.edges) + ")"


def sql_first_bin(x: str, lows, highs) -> str:
    parts = " ".join(f"WHEN {x} >= {a} AND {x} < {b} THEN {i}" for i, (a, b) in enumerate(zip(lows, highs)))
    return f"CASE {parts} END"


def sql_values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else repr(v)

    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
