"""Systematic-error tables: (source, ibin, x_low, x_up, y_low, y_up)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .schemas import ERROR_TABLE

COLUMNS = ERROR_TABLE.fieldNames()


def merge(*tables: DataFrame) -> DataFrame:
    """Union of error tables; a (source, bin) given twice is an error."""
    out = tables[0].select(*COLUMNS)
    for t in tables[1:]:
        out = out.unionByName(t.select(*COLUMNS))
    seen = F.count("*").over(Window.partitionBy("source", "ibin"))
    return (
        out.withColumn("__seen", seen)
        .where(F.when(F.col("__seen") == 1, True).otherwise(
            F.raise_error(F.concat(F.lit("error source given twice: "), "source")).cast("boolean")))
        .drop("__seen")
    )


def write(table: DataFrame, path: str) -> str:
    table.select(*COLUMNS).write.mode("overwrite").parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ERROR_TABLE).parquet(path)


def long_form(table: DataFrame) -> DataFrame:
    """(source, ibin, side, value) with side in x_low, x_up, y_low, y_up."""
    return table.unpivot(["source", "ibin"], ["x_low", "x_up", "y_low", "y_up"], "side", "value")
