"""Exact places of rows in a repeatable shuffled order per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import key_digest
from ..session import small_side, stored

RANGE_ROWS = 100_000  # different rows of one range
RANGES = 65_536
COPIES = 1_000  # copies of a row that stay together in a range


def shuffled_places(df: DataFrame, by: Sequence[str], keys: Sequence[str], seed: str | int = "", name: str = "place",
                    range_rows: int = RANGE_ROWS, copies: int = COPIES) -> DataFrame:
    """Number the rows of each class from 0 in the order of the key hash, without gaps.

    Equal rows travel as one with their number (in parts of ``copies``).  Ranges of the order are cut over all columns, so
    neither a large class nor a key that holds a third of all rows stays in one task.  A range is sorted and numbered where it
    is written, so the rows are neither shuffled nor sorted again; a row's place is its number, less the first number of its
    class in the range, plus the rows of its class in the ranges before (one counter for each range and class).
    Rows with equal keys follow their other columns; NULL is a class of its own.
    """
    rest = [c for c in df.columns if c not in by and c not in keys]
    counted = stored(df.groupBy(*df.columns).agg(F.count("*").alias("__c")), "copies")
    size = counted.agg(F.count("*").alias("n"), F.max("__c").alias("most")).first()
    parts = max(1, min(RANGES, size["n"] // range_rows + 1))
    order = ["__digest", *[c for c in keys if c not in by], *rest]
    marked = counted.withColumn("__digest", key_digest(keys, seed))
    if (size["most"] or 1) > copies:
        marked = marked.withColumn("__k", F.explode(F.expr(f"sequence(0, (__c - 1) div {copies})")))
        marked = marked.withColumn("__c", F.least(F.lit(copies), F.col("__c") - F.col("__k") * copies))
        order.append("__k")
    ranged = marked.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
    if (size["most"] or 1) > 1:
        ranged = ranged.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__c").cast("int"))))
    # range and number of a row in one; the bounds of the ranges come from a sample: kept once, the same for both readers
    ranged = stored(ranged.select(*df.columns, F.monotonically_increasing_id().alias("__id")), "ranges")

    sizes = ranged.groupBy(*by, F.expr("shiftright(__id, 33)").alias("__r")).agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)], "__r",
                         (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__start"))
    same = F.expr("shiftright(__id, 33)") == F.col("__r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by{i}"))
    return ranged.join(small_side(sizes), same).select(*df.columns, (F.col("__id") + F.col("__start")).alias(name))


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], folds: int, seed: str | int = "", name: str = "fold") -> DataFrame:
    """Fold numbers such that the rows of each class differ by at most one between folds."""
    placed = shuffled_places(df, [label], keys, seed, "__place")
    return placed.withColumn(name, (F.col("__place") % folds).cast("int")).drop("__place")
