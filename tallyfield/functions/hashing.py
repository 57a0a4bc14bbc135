"""Repeatable pseudo-random order from row keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .predicates import Operand, col


def key_digest(keys: Sequence[Operand], seed: str | int = "") -> Column:
    parts = [F.lit(str(seed))] + [col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def key_number(keys: Sequence[Operand], seed: str | int = "") -> Column:
    """First 32 bits of the digest as a number."""
    return F.conv(F.substring(key_digest(keys, seed), 1, 8), 16, 10).cast("long")


def in_fraction(keys: Sequence[Operand], fraction: float, seed: str | int = "") -> Column:
    """True for about the given share of keys, the same ones in every run."""
    return key_number(keys, seed) < int(fraction * 2**32)


def fold_number(keys: Sequence[Operand], folds: int, seed: str | int = "") -> Column:
    return (key_number(keys, seed) % folds).cast("int")


DIGITS = 4  # hexadecimal digits of the digest looked at in one turn: 65536 counters
TASK_ROWS = 100_000  # rows that are ordered one by one


def take_by_hash(
    df: DataFrame,
    keys: Sequence[str],
    seed: str | int = "",
    n: int | None = None,
    fraction: float | None = None,
    tail: bool = False,
) -> DataFrame:
    """First (or last) rows of the table shuffled by key hash, exactly ``n`` or ``fraction`` of it.

    A global sort would send everything to one final task.  Instead rows are counted
    per digest prefix (65536 counters), and the prefix in which the wanted number is
    reached is cut finer, by further digits, until it holds at most TASK_ROWS rows or is one
    digest.  All smaller digests are kept as they are and only the last prefix is looked at
    row by row.  There, equal rows are counted before they travel and written out again
    afterwards, so a row that exists in very many copies burdens no single task.
    Rows with equal keys are taken in the order of their other columns.
    """
    if (n is None) == (fraction is None):
        raise ValueError("give n or fraction")
    digest = key_digest(keys, seed)
    if tail:  # the last rows of one order are the first of the reverse order
        digest = F.translate(digest, "0123456789abcdef", "fedcba9876543210")
    marked = df.withColumn("__digest", digest)
    prefix, room, rows = _boundary(marked, n, fraction, tail)
    if prefix is None:
        return df if room else df.limit(0)
    order = ["__digest", *keys, *[c for c in df.columns if c not in keys]]
    below, edge = F.col("__digest") < prefix, F.col("__digest").startswith(prefix)
    last = marked.where(edge).withColumn("__prefix", F.lit(prefix)).withColumn("__room", F.lit(room))
    return marked.where(below).select(*df.columns).unionByName(_first_rows(last, order).select(*df.columns))


def _boundary(marked: DataFrame, n: int | None, fraction: float | None, tail: bool) -> tuple[str | None, int, int]:
    """Digest prefix in which the wanted number of rows is reached, rows wanted of it, rows in it; no prefix: none or all are wanted."""
    prefix, room = "", n
    while True:
        place = F.substring("__digest", len(prefix) + 1, DIGITS)
        counts = marked.where(F.col("__digest").startswith(prefix)).groupBy(place.alias("p")).agg(F.count("*").alias("c"))
        found = sorted((r.p, r.c) for r in counts.collect())  # 65536 counters at most
        total = sum(c for _, c in found)
        if room is None:
            room = round(total * fraction) if tail else math.floor(total * fraction + 1e-9)
        if not prefix and room >= total:
            return None, 1, total
        if room <= 0:
            return (prefix, 0, 0) if prefix else (None, 0, 0)
        for p, c in found:
            if room <= c:
                prefix, rows = prefix + p, c
                break
            room -= c
        if rows <= TASK_ROWS or len(prefix) >= 32 or room == rows:
            return prefix, room, rows


COPIES_PER_TASK = 100_000


def _first_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first ``__room`` rows of each ``__prefix``; copies of a row travel as a count."""
    counted = rows.groupBy("__prefix", "__room", *order).agg(F.count("*").alias("__c"))
    before = F.sum("__c").over(Window.partitionBy("__prefix").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    take = F.least(F.col("__c"), F.col("__room") - F.coalesce(before, F.lit(0)))
    kept = counted.withColumn("__take", take).where("__take > 0")
    single = kept.where("__take = 1")
    chunks = kept.where("__take > 1").withColumn("__chunk", F.explode(F.expr(f"sequence(0, (__take - 1) div {COPIES_PER_TASK})")))
    size = F.least(F.lit(COPIES_PER_TASK), F.col("__take") - F.col("__chunk") * COPIES_PER_TASK)
    copies = chunks.repartition("__digest", "__chunk").withColumn("__i", F.explode(F.sequence(F.lit(1), size.cast("int"))))
    return single.select(*order).unionByName(copies.select(*order))
