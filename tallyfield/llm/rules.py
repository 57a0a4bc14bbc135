"""Quality rules: base counts and a hashed n-gram log-likelihood ratio with a fixed threshold.

Two multinomials over hashed one- and two-word grams are estimated: the *target* from
all trusted texts (label 1 outside the held-out fold) and the *raw* one from every
document.  The verdict of a document is its mean log ratio per gram, compared with one
threshold for the whole corpus.  The threshold separates all labelled texts of the two classes
best, each half of them rated by the target of the other half, so that no text is rated by itself;
it is the same for every document and for every run.

Defined cases: null and empty texts have no words and fail the base rules; their ratio
is 0; without trusted texts the ratio is 0 for all and only the base rules act; without
texts of label 0 the threshold lies below the trusted texts; a half without trusted texts leaves
the other one to the target of all; repeated rows are judged one by one.  Other columns of the input pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .common import Words, labelled_rows, mix, slices, stored, text_array, words_of

BUCKETS = 1 << 14
SLICE_ROWS = 50_000  # different ratios summed up by one task
SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def grams(w: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and of every pair of neighbouring words."""
    pair = w.doc[1:] == w.doc[:-1]
    two = mix(w.hash[:-1][pair] * np.uint64(3) + w.hash[1:][pair] + np.uint64(0x51ED27))
    buckets = np.concatenate([w.hash, two]) % np.uint64(buckets)
    return buckets.astype(np.int64), np.concatenate([w.doc, w.doc[1:][pair]])


def gram_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """Counts per bucket over all texts; `buckets` rows at most reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = text_array(batch.column(0))
            for lo, hi in slices(texts):
                sums += np.bincount(grams(words_of(texts.slice(lo, hi - lo)), buckets)[0], minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def repeats(w: Words, n: int) -> np.ndarray:
    """Per text, the words that lie in a three-word window found at least twice in it."""
    out = np.zeros(n, np.int64)
    inside = np.flatnonzero(w.doc[2:] == w.doc[:-2]) if len(w.doc) > 2 else np.zeros(0, np.int64)
    if not len(inside):
        return out
    h = w.hash
    window = mix(mix(mix(h[inside] + w.doc[inside].astype(np.uint64)) + h[inside + 1]) * np.uint64(5) + h[inside + 2])
    _, back, count = np.unique(window, return_inverse=True, return_counts=True)
    often = inside[count[back] > 1]
    hit = np.zeros(len(h), bool)
    for k in range(3):
        hit[often + k] = True
    return np.bincount(w.doc[hit], minlength=n)


def duplicate_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            n += line in seen
            seen.add(line)
    return n


def base_counts(texts: pa.Array, w: Words) -> dict[str, np.ndarray]:
    n = len(texts)
    # code points in words: bytes that are not continuation bytes, between start and stop
    heads = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[w.data])])
    return {
        "n_words": np.bincount(w.doc, minlength=n),
        "word_chars": np.bincount(w.doc, heads[w.stop] - heads[w.start], minlength=n).astype(np.int64),
        "n_symbols": symbols[w.offset[1:]] - symbols[w.offset[:-1]],
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts.to_pylist()], np.int64),
        "n_repeat_words": repeats(w, n),
    }


@dataclass
class Rules:
    weight: np.ndarray  # log ratio per bucket
    threshold: float

    def ratio(self, w: Words, n: int) -> np.ndarray:
        bucket, doc = grams(w, len(self.weight))
        size = np.bincount(doc, minlength=n)
        return np.bincount(doc, self.weight[bucket], minlength=n) / np.maximum(size, 1)


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    """Per bucket; the raw multinomial smooths the target: unseen buckets fall back on it, scaled down."""
    prior = (raw + smoothing) / (raw + smoothing).sum()
    return np.log((target + smoothing * len(raw) * prior) / (target.sum() + smoothing * len(raw)) / prior)


def fit(docs: DataFrame, labels: DataFrame, smoothing: float = 1.0, buckets: int = BUCKETS, slice_rows: int = SLICE_ROWS) -> Rules:
    """Raw counts over all documents, target counts and threshold over all labelled texts."""
    known = labelled_rows(docs, labels).withColumn("half", (F.xxhash64("text") % 2 == 0).cast("int"))
    raw = gram_counts(docs, buckets)
    halves = [gram_counts(known.where((F.col("label") == 1) & (F.col("half") == h)), buckets) for h in (0, 1)]
    target = halves[0] + halves[1]
    if not target.sum():
        return Rules(np.zeros(buckets), -np.inf)
    rated = [ratios(known.where(F.col("half") == h), Rules(log_ratio(halves[1 - h] if halves[1 - h].sum() else target, raw, smoothing), -np.inf)) for h in (0, 1)]
    return Rules(log_ratio(target, raw, smoothing), best_threshold(rated[0].unionByName(rated[1]), slice_rows))


def ratios(known: DataFrame, rules: Rules) -> DataFrame:
    """(label, ratio) of the texts that have a word."""
    shared = known.sparkSession.sparkContext.broadcast(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(0))
            for lo, hi in slices(texts):
                w = words_of(texts.slice(lo, hi - lo))
                used = np.bincount(w.doc, minlength=hi - lo) > 0
                label = batch.column(1).slice(lo, hi - lo).filter(pa.array(used))
                yield pa.RecordBatch.from_arrays([label, pa.array(shared.value.ratio(w, hi - lo)[used])], ["label", "ratio"])

    return known.select("text", "label").mapInArrow(run, "label int, ratio double")


def best_threshold(rated: DataFrame, slice_rows: int = SLICE_ROWS) -> float:
    """Cut with the largest share of label 1 above minus share of label 0 above; of ties, in the widest gap, nearer to label 0.

    Exact over all rows: they are counted per different ratio, the ratios are dealt into slices, and every slice
    starts from the sums of those below it.  One row per slice travels to one task, one row to the driver.
    """
    counts = stored(rated.groupBy("ratio").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")), "ratios")
    whole = counts.agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"),
                       F.min(F.when(F.col("good") > 0, F.col("ratio"))).alias("lo"), F.max(F.when(F.col("good") > 0, F.col("ratio"))).alias("hi")).first()
    if not whole["good"]:
        return -np.inf
    if not whole["bad"]:
        return whole["lo"] - 0.1 * (whole["hi"] - whole["lo"]) - 1e-6
    parts = 1 + whole["n"] // slice_rows
    cuts = sorted(set(counts.approxQuantile("ratio", [i / parts for i in range(1, parts)], 0.5 / parts))) if parts > 1 else []
    dealt = Bucketizer(splits=[-np.inf, *cuts, np.inf], inputCol="ratio", outputCol="slice").transform(counts) if cuts else counts.withColumn("slice", F.lit(0.0))
    below = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    starts = dealt.groupBy("slice").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"), F.max("ratio").alias("last"))
    starts = starts.select("slice", F.coalesce(F.sum("g").over(below), F.lit(0)).alias("g0"), F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b0"), F.max("last").over(below).alias("before"))
    inside = Window.partitionBy("slice").orderBy("ratio")
    lower = inside.rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.join(starts, "slice").select(
        "ratio", (F.col("g0") + F.coalesce(F.sum("good").over(lower), F.lit(0))).alias("g"), (F.col("b0") + F.coalesce(F.sum("bad").over(lower), F.lit(0))).alias("b"),
        F.coalesce(F.lag("ratio").over(inside), F.col("before")).alias("prev"))
    # shares as whole numbers: ties are ties
    gain = F.col("b").cast("decimal(19,0)") * whole["good"] - F.col("g").cast("decimal(19,0)") * whole["bad"]
    middle = F.coalesce(0.7 * F.col("prev") + 0.3 * F.col("ratio"), F.col("ratio") - 1e-6)
    best = summed.agg(F.max(F.struct(gain.alias("gain"), F.coalesce(F.col("ratio") - F.col("prev"), F.lit(0.0)).alias("width"), (-middle).alias("cut"))).alias("best")).first()
    return -best["best"]["cut"]


def verdicts(docs: DataFrame, rules: Rules) -> DataFrame:
    """All columns of `docs`, the base counts, `base_failed`, `ratio` and `kept`."""
    names = [*COUNTS, "base_failed", "ratio", "kept"]
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    shared = docs.sparkSession.sparkContext.broadcast(rules)
    at = docs.columns.index("text")
    kinds = [*[LongType()] * len(COUNTS), BooleanType(), DoubleType(), BooleanType()]

    def judge(texts: pa.Array) -> list[np.ndarray]:
        w, rules = words_of(texts), shared.value
        c = base_counts(texts, w)
        failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        ratio = rules.ratio(w, len(texts))
        return [*(c[k] for k in COUNTS), failed, ratio, ~failed & (ratio >= rules.threshold)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(at))
            for lo, hi in slices(texts):
                made = judge(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, *map(pa.array, made)], [*batch.schema.names, *names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *map(StructField, names, kinds)]))
