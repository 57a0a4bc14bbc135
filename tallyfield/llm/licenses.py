"""License scans by diagonal voting.

All rolling two-word grams of all documents are joined with the positions of the same
grams in short license templates (a constant table, broadcast).  A hit at document
position p and template position q lies on the diagonal p - q.  Hits are counted
per diagonal, as a bit for each template position; neighbouring diagonals, apart
by at most GAP words, are merged, so a passage with inserted or missing words is one region;
regions are verified against the words of the document.

Defined cases: null and empty texts have no words, no labels and score 0; rows repeated
with the same id and text share their hits and each get them; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, small_side, stored

#: Fixed phrases and labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Phrases of well-known licences and their labels.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "all-rights-reserved",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache",
}
GAP = 3  # words between diagonals that are merged
SHARE = 0.75  # of a template's grams, for a label of the method
WORD_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
TEMPLATES = [(p, label, True) for p, label in BASE.items()] + [(p, label, False) for p, label in MORE.items()]


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), WORD_BREAK, -1), lambda w: w != "")


def grams(found: Column) -> Column:
    """Hashes of all pairs of neighbouring words."""
    n = F.size(found)
    return F.zip_with(F.slice(found, 1, F.greatest(n - 1, F.lit(0))), F.slice(found, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))


def templates(spark) -> DataFrame:
    """(gram, template, tpos): a few dozen rows."""
    rows = [(a, b, t, i) for t, (phrase, _, _) in enumerate(TEMPLATES) for i, (a, b) in enumerate(zip(phrase.split(), phrase.split()[1:]))]
    return spark.createDataFrame(rows, "a string, b string, template int, tpos int").select(F.xxhash64("a", "b").alias("gram"), "template", "tpos")


def regions(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, mark, hits): merged diagonals of every document with hits."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), words(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "mark", F.posexplode_outer(grams(F.col("words"))).alias("pos", "gram"))
    hits = rows.join(F.broadcast(templates(docs.sparkSession)), "gram")
    diagonals = hits.groupBy("doc_id", "mark", "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("seen"), F.min("tpos").alias("first"), F.max("tpos").alias("last"))
    by = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal")
    fresh = F.col("diagonal") - F.lag("diagonal").over(by) > GAP
    runs = diagonals.withColumn("region", F.sum(F.when(fresh, 1).otherwise(0)).over(by))
    merged = runs.groupBy("doc_id", "mark", "template", "region").agg(
        F.bit_or("seen").alias("seen"),
        F.min(F.expr("diagonal + first")).alias("start"),
        F.max(F.expr("diagonal + last + 2")).alias("stop"),
        F.collect_list(F.struct("diagonal", "seen")).alias("diagonals"),
    )
    hit = F.struct("template", "start", "stop", F.bit_count("seen").alias("votes"), "diagonals")
    return stored(merged.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(hit)).alias("hits")), "license-hits")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, base places (sorted), labels of base and of all, score and verified regions."""
    found = small_side(regions(docs))
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), words(F.coalesce("text", F.lit(""))).alias("words"))
    seen = found.select(F.col("doc_id").alias("id"), F.col("mark").alias("text_mark"), "hits")
    full = rows.join(seen, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("mark").eqNullSafe(F.col("text_mark")), "left")
    table = F.array(*(F.struct(F.array(*map(F.lit, p.split())).alias("words"), F.lit(label).alias("label"), F.lit(len(p.split()) - 1).alias("grams"), F.lit(base).alias("base")) for p, label, base in TEMPLATES))
    of = lambda h: F.element_at(table, h["template"] + 1)
    # base phrases: whole diagonals whose words are the phrase
    exact = lambda h: F.filter(h["diagonals"], lambda d: (F.bit_count(d["seen"]) == of(h)["grams"]) & (F.slice("words", d["diagonal"] + 1, F.size(of(h)["words"])) == of(h)["words"]))
    base = F.transform(F.filter("hits", lambda h: of(h)["base"]), lambda h: F.struct(of(h)["label"].alias("label"), F.transform(exact(h), lambda d: d["diagonal"]).alias("at")))
    full = full.withColumn("base", base)
    # the method: enough of a template in a region, counted again on the words of the region
    again = lambda h: F.size(F.array_intersect(F.slice("words", h["start"] + 1, h["stop"] - h["start"]), of(h)["words"]))
    good = lambda h: (h["votes"] >= SHARE * of(h)["grams"]) & (again(h) >= SHARE * F.size(F.array_distinct(of(h)["words"])))
    kept = F.filter("hits", good)
    full = full.withColumn("regions", F.transform(kept, lambda h: F.struct(of(h)["label"].alias("label"), h["start"].alias("start"), h["stop"].alias("stop"), (h["votes"] / of(h)["grams"]).alias("share"))))
    places = F.sort_array(F.flatten(F.transform("base", lambda b: b["at"])))
    base_labels = F.array_sort(F.array_distinct(F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])))
    none = F.array().cast("array<string>")
    return full.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(places, F.array().cast("array<int>")).alias("places"),
        F.coalesce(base_labels, none).alias("base_labels"),
        F.coalesce(F.array_sort(F.array_union(base_labels, F.transform("regions", lambda r: r["label"]))), none).alias("labels"),
        F.coalesce(F.array_max(F.transform("regions", lambda r: r["share"])), F.lit(0.0)).alias("score"),
        "regions",
    )
