"""Tests on integer bitmaps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import Operand, col

# fixed bit numbers of the candidate bitmap
STANDARD, SIGNAL, BACKGROUND, PROMPT, FEEDDOWN, REFLECTION, PID, TRACKS = 0, 1, 2, 3, 4, 5, 7, 8

# class tag -> (bits that must be set, bits that must be clear)
CLASS_TAGS: dict[str, tuple[list[int], list[int]]] = {
    "isstd": ([STANDARD], []),
    "ismcsignal": ([SIGNAL], [REFLECTION]),
    "ismcprompt": ([SIGNAL, PROMPT], [REFLECTION]),
    "ismcfd": ([SIGNAL, FEEDDOWN], [REFLECTION]),
    "ismcbkg": ([BACKGROUND], []),
    "ismcrefl": ([REFLECTION], []),
}


def mask(bits: Iterable[int]) -> int:
    return sum(1 << b for b in set(bits))


def has_bits(c: Operand, on: Iterable[int] = (), off: Iterable[int] = ()) -> Column:
    """All ``on`` bits set and all ``off`` bits clear."""
    c, set_, clear = col(c), mask(on), mask(off)
    return (c.bitwiseAND(F.lit(set_)) == set_) & (c.bitwiseAND(F.lit(clear)) == 0)


def tag(df: DataFrame, bitmap: Operand, tags: Mapping[str, tuple[list[int], list[int]]]) -> DataFrame:
    """Add 0/1 integer columns, one per tag."""
    return df.withColumns({name: has_bits(bitmap, *bits).cast("int") for name, bits in tags.items()})


def keep(df: DataFrame, bitmap: Operand, on=(), off=()) -> DataFrame:
    return df.where(has_bits(bitmap, on, off))


def with_bit(df: DataFrame, bitmap: str, bit: int, name: str) -> DataFrame:
    """Tag one bit and keep the rows that have it."""
    return tag(df, bitmap, {name: ([bit], [])}).where(F.col(name) == 1)
