"""Corpus pipeline: quality, line dedup, near duplicates, mixing, tokens.

Each stage takes and returns a table of documents; the last one returns token ids.  Rows
with null texts have no words: they pass the classifier and the dedup stages unchanged and
the mix, which takes words, takes none of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import bpe, jaccard, linededup, mixing, quality
from tallyfield.llm.common import stored, table

THRESHOLD = 0.3  # a score below rejects a document
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours vote for label 1."""
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), "__score")
    return scored.where(F.col("__score") >= THRESHOLD).drop("__score")


def without_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks and passages found earlier in the corpus; a text that consisted of such lines alone goes."""
    cleaned = linededup.dedup_passages(docs, removed="__removed")
    blank = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", "")) == 0
    return cleaned.where(~((F.col("__removed") > 0) & blank)).drop("__removed")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the target weights of the sources ask for, whole documents and cut ones."""
    return mixing.mixed_texts(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; decoding them gives the text back, byte by byte, which is checked by digest."""
    coded = bpe.encode(docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)), VOCABULARY, public_tokenizers.PATTERN)
    back = bpe.decode(coded, VOCABULARY)
    checked = F.when(F.sha2("bytes", 256) == F.col("text_sha256"), F.col("ids")).otherwise(F.raise_error(F.lit("decoding does not give the text back")))
    return back.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), checked.alias("ids"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_chunks),
    ("n-gram Jaccard join", without_near_duplicates),
    ("mixing to target weights", mixed),
    ("byte-level BPE", tokens),
]
ORACLE_SQL = None  # votes of neighbours and the draws of the mix have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
