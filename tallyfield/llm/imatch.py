"""I-Match fingerprints of documents.

The lexicon holds the words whose share of documents lies in a band (``low`` to
``high``), that is, a band of inverse document frequency.  A word with a share of
at least ``low`` is in ``low * N`` documents, so the lexicon has at most
(mean distinct words per document) / ``low`` words: bounded whatever the corpus.
The distinct lexicon words of a document are sorted and hashed, once for each of
SUBSETS randomised sub-lexicons; a word belongs to a sub-lexicon by a digit of its md5.

Only DataFrame functions are used.  The membership test is a hash set of literals
in the expression, so documents are fingerprinted where they lie.

Defined cases: null and empty texts, and texts without a lexicon word, are
fingerprinted by their whole text, so equal texts and only those agree; repeated rows are
fingerprinted one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LOW, HIGH = 0.005, 0.2
SUBSETS = 32  # one hexadecimal digit of the md5 of a word each
MAX_LEXICON = 100_000
BLANKS = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Runs without ASCII white space; an edge may give one empty word, which no lexicon holds."""
    return F.split(text, BLANKS, -1)


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> list[str]:
    """The words of the band, from the document frequencies of all words of all documents."""
    n = texts.count()
    df = texts.select(F.explode_outer(F.array_distinct(words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    band = df.where((F.col("df") >= low * n) & (F.col("df") <= high * n) & (F.col("word") != "")).select("word")
    found = [r[0] for r in band.limit(MAX_LEXICON + 1).collect()]
    if len(found) > MAX_LEXICON:
        raise ValueError("the band holds too many words; raise its lower end")
    return sorted(found)


def terms(text: Column, known: list[str]) -> Column:
    """Sorted distinct lexicon words, as md5 and word."""
    if not known:
        return F.array().cast("array<string>")
    hit = F.array_sort(F.array_distinct(F.filter(words(text), lambda w: w.isin(known))))
    return F.transform(hit, lambda w: F.concat(F.md5(w), w))


def digests(found: Column, text: Column, subsets: int = SUBSETS) -> Column:
    """Eight hexadecimal digits per sub-lexicon; of the whole text where no word is known."""
    def member(digit: int):
        return lambda w: F.substring(w, digit, 1).isin("0", "1")

    parts = [F.substring(F.md5(F.array_join(F.filter(found, member(i + 1)), " ")), 1, 8) for i in range(subsets)]
    whole = F.md5(F.concat(F.lit("text "), text))
    none = F.transform(F.sequence(F.lit(1), F.lit(subsets)), lambda i: F.substring(F.md5(F.concat(i.cast("string"), whole)), 1, 8))
    return F.when(F.size(found) > 0, F.array(*parts)).otherwise(none)


EMPTY = "d41d8cd9"  # fixed value: the first digits of the md5 of nothing


def likeness(a: Column, b: Column) -> Column:
    """Share of sub-lexicons with equal hashes among those where either text has a word; 1 for equal fingerprints."""
    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    used = F.filter(pairs, lambda p: (p["x"] != EMPTY) | (p["y"] != EMPTY))
    same = F.filter(used, lambda p: p["x"] == p["y"])
    return F.when(a == b, 1.0).otherwise(F.size(same) / F.size(used))


def fingerprint(texts: DataFrame, known: list[str], column: str = "text", out: str = "fingerprint") -> DataFrame:
    """All columns and the array of sub-lexicon hashes of `column`."""
    found = texts.withColumn("__terms", terms(F.col(column), known))
    return found.withColumn(out, digests(F.col("__terms"), F.col(column))).drop("__terms")


def range_of(key: str, cuts: list) -> Column:
    """How many of the sorted cuts are at or below the key: two looks at about the root of their number."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = lambda array: F.size(F.filter(array, lambda c: c <= F.col(key)))
    group = below(F.array(*(F.lit(g[0]) for g in groups)))
    inside = below(F.element_at(F.array(*(F.array(*map(F.lit, g)) for g in groups)), F.greatest(group, F.lit(1))))
    return F.when(group > 0, (group - 1) * step + inside).otherwise(0)


def with_next(rows: DataFrame, key: str, column: str, ranges: int, mark: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`mark(rows)` and a struct `next` of `column` and `marks` of the following row by (key, column); the first row follows the last.

    The key is cut into ranges that are ordered one by one; the first row of each
    range, one row per range, is joined to the last one of the range before.
    """
    cuts = rows.select(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10_000)).first()[0] if ranges > 1 else None
    rows = rows.withColumn("__range", range_of(key, sorted(set(cuts or []))))
    least = stored(rows.groupBy("__range").agg(F.min(key).alias("__least"), F.max(F.col(key).isNull()).alias("__null")), "range-heads")
    there = sorted(r[0] for r in least.select("__range").collect())  # a number per range
    before = least.sparkSession.createDataFrame([(r, there[i - 1]) for i, r in enumerate(there)], "__range int, __to int")
    at = F.broadcast(least.select(F.col("__range").alias("__at"), F.when(~F.col("__null"), F.col("__least")).alias("__least")))  # a row per range
    heads = rows.join(at, (F.col("__range") == F.col("__at")) & F.col(key).eqNullSafe(F.col("__least")))
    heads = stored(heads.groupBy("__range").agg(F.min(column).alias(column)).join(F.broadcast(before), "__range"), "range-heads")
    heads = mark(heads).select("__to", F.struct(column, "marks").alias("__head"))
    order = Window.partitionBy("__range").orderBy(key, column)
    led = mark(rows).withColumn("__lead", F.lead(F.struct(column, "marks")).over(order))
    full = led.join(F.broadcast(heads), F.col("__range") == F.col("__to"), "left")  # a row per range
    return full.withColumn("next", F.coalesce("__lead", "__head")).drop("__lead", "__head", "__to", "__range")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of the following text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))
