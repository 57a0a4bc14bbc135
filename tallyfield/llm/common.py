"""Helpers shared by the text operators: word hashes over Arrow text, stored tables, labelled samples."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, released, small_side, stored, tune

__all__ = ["table", "stored", "released", "fresh_path", "small_side", "Words", "words_of", "slices", "text_array", "mix", "labelled_rows", "held_out", "ascii_lower", "tidy"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # texts are long: fewer rows in one Arrow batch keep the memory of a Python worker low
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def trim() -> None:
    """Give freed memory back to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trimmer = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trimmer is not None:
        trimmer(0)


def tidy(f: Callable) -> Callable:
    """f, a function of Arrow batches, of a group or of two groups, with `trim` when it has ended."""

    def ended(out):
        if not isinstance(out, Iterator):
            trim()
            return out

        def rest():
            yield from out
            trim()

        return rest()

    if f.__code__.co_argcount == 2:
        return lambda left, right: ended(f(left, right))
    return lambda given: ended(f(given))


def ascii_lower(text):
    """Column with A-Z in lower case and every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads the bits of a polynomial hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words (runs without ASCII white space) of several texts, in order."""

    hash: np.ndarray  # uint64
    doc: np.ndarray  # index of the text
    start: np.ndarray  # first byte in `data`
    stop: np.ndarray
    data: np.ndarray  # bytes of all texts
    offset: np.ndarray  # texts + 1


def text_array(column: pa.Array) -> pa.Array:
    """The text column with 64-bit offsets and null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes and `rows` rows (one row at least), so that memory follows the longest text."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, len(texts))
        yield lo, hi
        lo = hi


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Find the words of a slice of `text_array` and hash each one to 64 bits."""
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offset[0] : offset[-1]] if raw is not None and offset[-1] > offset[0] else np.zeros(0, np.uint8)
    offset = offset - offset[0]
    if lower:
        data = FOLD[data]
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offset[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]  # a text begins a word even where the text before ends with one
    last[edges - 1] = inside[edges - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    length = stop - start
    h = np.zeros(len(start), np.uint64)
    live, step = np.arange(len(start)), 0
    while len(live):  # one byte of every word that is long enough
        h[live] = h[live] * np.uint64(0x9E3779B97F4A7C15) + data[start[live] + step] + np.uint64(1)
        step += 1
        live = live[length[live] > step]
    doc = np.searchsorted(offset, start, "right") - 1
    return Words(mix(h), doc, start, stop, data, offset)


def held_out(doc_id):
    """Rows no operator learns labels from: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def labelled_rows(docs: DataFrame, labels: DataFrame, per_label: int | None = None) -> DataFrame:
    """The texts of labelled rows outside the held-out fold, stored: (text, label).

    An id with both labels counts as the lower one; ids or labels that are null are left out; of rows with one id
    the text with the smallest (hash, text) counts.  With `per_label` at most so many of each label: those with the smallest
    hash of the id, the same ones in every run.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    if per_label is not None:
        known = known.select("doc_id", "label", F.xxhash64("doc_id", F.lit(7)).alias("rank"))
        drawn = [known.where(F.col("label") == c).orderBy("rank", "doc_id").limit(per_label) for c in (0, 1)]
        known = drawn[0].unionByName(drawn[1]).select("doc_id", "label")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(small_side(known), "doc_id")
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "label")).alias("row"))
    return stored(one.select("row.text", "row.label"), "labelled")


def word_starts(data: np.ndarray, offset: np.ndarray) -> np.ndarray:
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offset[(offset > 0) & (offset < len(data))]
    first[edges] = inside[edges]
    return first


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words of every text of a slice."""
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offset[-1] == offset[0]:
        return np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offset[0] : offset[-1]]
    offset = offset - offset[0]
    sums = np.concatenate([[0], np.cumsum(word_starts(data, offset))])
    return sums[offset[1:]] - sums[offset[:-1]]


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one byte of every word."""
    inside = np.concatenate([[False], ~SPACE[np.frombuffer(text.encode(), np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]
