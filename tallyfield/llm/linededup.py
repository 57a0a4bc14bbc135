"""Line dedup with content-defined chunks.

A rolling hash over the hashes of two neighbouring lines chooses the boundaries of
chunks, so an inserted line moves no boundary but its own.  A line of
``long_words`` words or more always is a chunk of its own.  Chunks of several lines, and
long ones, that occur more than once in the corpus are removed, except for the first
occurrence by (doc_id, text hash, position); equal hashes count only if the bytes
are equal to those of the first occurrence.

Boundaries depend on the line before, so the ends of a repeated passage fall into chunks with its
surroundings, and a short passage may hold no chunk at all.  `dedup_passages` also removes
every run of whole lines with `PASSAGE_WORDS` words or more that occurred before: from each line that
is not blank it takes the shortest run of that many words downwards and the shortest one upwards.
Both depend on the run's own lines alone, and together they cover every line of every such run.
A run that overlaps its first occurrence in the same text stays.  Runs are compared by 128 bits of
their SHA-256.

Everything is an expression or a join.  Counts are combined before the shuffle; the join of
occurrences with first occurrences has one row per chunk on one side, so a chunk in a third
of all documents is split by the skew join.

Defined cases: null texts stay null and empty ones empty; blank chunks are never
removed; rows repeated with the same id and text are one document and are changed alike;
a document may end up empty; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored

MODULUS = 3  # one boundary in three lines on average
LONG_WORDS = 50
PASSAGE_WORDS = 50
GAP, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def line_number(line):
    """32 bits of the line's md5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def cut(docs: DataFrame, modulus: int = MODULUS, long_words: int = LONG_WORDS) -> DataFrame:
    """`docs` with their chunks as the array `__chunks` and a text hash `__mark`."""
    lines = docs.withColumn("__mark", F.xxhash64("text")).withColumn("__lines", F.split("text", "\n", -1))
    hashed = lines.withColumn("__hash", F.transform("__lines", line_number))
    hashed = hashed.withColumn("__long", F.transform("__lines", lambda x: F.size(F.split(x, " ")) >= long_words))

    def starts(i):
        roll = (F.element_at("__hash", (i - 1).cast("int")) * 31 + F.element_at("__hash", i.cast("int"))) % modulus == 0
        # `and` and `or` would evaluate element 0 too: the first line is asked for first
        return F.when(i == 1, True).otherwise(roll | F.element_at("__long", (i - 1).cast("int")) | F.element_at("__long", i.cast("int")))

    at = F.filter(F.sequence(F.lit(1), F.size("__lines")), starts)
    begun = hashed.withColumn("__at", F.when(F.col("__lines").isNotNull(), at))
    ends = F.concat(F.slice(F.col("__at"), 2, F.size("__at")), F.array(F.size("__lines") + 1))
    spans = F.transform(F.arrays_zip(F.col("__at").alias("a"), ends.alias("b")), lambda s: F.struct(F.array_join(F.slice("__lines", s["a"], s["b"] - s["a"]), "\n").alias("chunk"), ((s["b"] - s["a"] > 1) | F.element_at("__long", s["a"])).alias("whole"), s["a"].alias("line"), s["b"].alias("stop")))
    return begun.withColumn("__chunks", spans).drop("__lines", "__hash", "__long", "__at")


def later_chunks(chunked: DataFrame) -> DataFrame:
    """Every occurrence of a repeated chunk but the first: doc_id, __mark, pos, line and stop."""
    # the outer form: else the optimizer filters by the size of the array, and computes it line by line for that
    rows = chunked.select("doc_id", "__mark", F.posexplode_outer("__chunks").alias("pos", "c"))
    rows = rows.where("c.whole").where(F.length(F.trim(F.translate("c.chunk", "\n\t\r", "   "))) > 0)
    rows = rows.select("doc_id", "__mark", "pos", "c.line", "c.stop", F.col("c.chunk").alias("chunk"), F.unhex(F.md5("c.chunk")).alias("key"))
    place = F.struct("doc_id", "__mark", "pos")
    firsts = rows.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    firsts = small_side(firsts.select("key", "first"))
    found = rows.join(firsts, "key")
    kept = small_side(found.where(F.struct("doc_id", "__mark", "pos").eqNullSafe(F.col("first"))).groupBy("key").agg(F.first("chunk").alias("bytes")), max_rows=50_000)
    return found.where(~F.struct("doc_id", "__mark", "pos").eqNullSafe(F.col("first"))).join(kept, "key").where(F.col("chunk") == F.col("bytes"))


def repeated(chunked: DataFrame) -> DataFrame:
    """Stored (__id, __text_mark, __places): the chunks to remove from every document that loses some."""
    gone = later_chunks(chunked)
    return stored(gone.groupBy(F.col("doc_id").alias("__id"), F.col("__mark").alias("__text_mark")).agg(F.collect_set("pos").alias("__places")), "removed-chunks")


def dedup_lines(docs: DataFrame, modulus: int = MODULUS, long_words: int = LONG_WORDS, removed: str = "removed") -> DataFrame:
    """All columns of `docs`, the text without repeated chunks, and the number of removed chunks.

    n_chars, where the column exists, follows the text.
    """
    chunked = cut(docs, modulus, long_words)
    gone = small_side(repeated(chunked))
    full = chunked.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__mark").eqNullSafe(F.col("__text_mark")), "left")
    left = F.filter("__chunks", lambda c, i: ~F.array_contains("__places", i))
    text = F.when(F.col("__places").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda c: c["chunk"]), "\n"))
    out = full.withColumn("__new", text)
    return changed(docs, out, "__places", removed)


def changed(docs: DataFrame, out: DataFrame, gone: str, removed: str) -> DataFrame:
    """The columns of `docs` with the text `__new` and its length where `gone` is not null, and the size of `gone`."""
    change = {"text": F.col("__new"), "n_chars": F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("__new")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*((change[c].alias(c) if c in change else F.col(f"`{c}`")) for c in docs.columns), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed))


def runs(text: Column, words: int = PASSAGE_WORDS) -> Column:
    """For every line the shortest run of whole lines that begins there and has `words` words; empty for a blank line and where the text ends before."""
    blank = r"[\x20\x09\x0B-\x0D]*+"
    return F.regexp_extract_all(text, F.lit(rf"(?<![^\n])(?=({blank}{WORD}++(?:{GAP}++{WORD}++){{{words - 1}}}[^\n]*+)?)"), F.lit(1))


def later_runs(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """Every occurrence of a repeated run but the first: doc_id, __mark, line and stop."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("__mark"), "text")

    def of(text: Column, downwards: bool) -> DataFrame:
        height = F.length("r") - F.length(F.translate("r", "\n", "")) + 1
        rows = texts.select("doc_id", "__mark", F.size(F.split("text", "\n", -1)).alias("lines"), F.posexplode_outer(runs(text, words)).alias("at", "r")).where("r <> ''")
        line = F.col("at") + 1 if downwards else F.col("lines") - F.col("at") - height + 1
        key = F.substring(F.unhex(F.sha2(F.col("r") if downwards else F.reverse("r"), 256)), 1, 16)
        return rows.select("doc_id", "__mark", line.alias("line"), (line + height).alias("stop"), key.alias("key"))

    rows = stored(of(F.col("text"), True).unionByName(of(F.reverse("text"), False)), "runs")
    place = F.struct("doc_id", "__mark", "line")
    firsts = rows.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    found = rows.join(small_side(firsts.select("key", "first")), "key")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("__mark").eqNullSafe(F.col("first.__mark"))
    overlaps = same & (F.col("line") < F.col("first.line") + F.col("stop") - F.col("line"))
    return found.where(~overlaps).select("doc_id", "__mark", "line", "stop")


def dedup_passages(docs: DataFrame, modulus: int = MODULUS, long_words: int = LONG_WORDS, words: int = PASSAGE_WORDS, removed: str = "removed") -> DataFrame:
    """As `dedup_lines`, without repeated runs of lines too; `removed` is the number of removed lines."""
    chunks = later_chunks(cut(docs, modulus, long_words)).select("doc_id", "__mark", "line", "stop")
    gone = chunks.unionByName(later_runs(docs, words)).select(F.col("doc_id").alias("__id"), F.col("__mark").alias("__text_mark"), F.explode(F.sequence("line", F.col("stop") - 1)).alias("line"))
    gone = small_side(gone.groupBy("__id", "__text_mark").agg(F.collect_set("line").alias("__gone")))
    full = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__text_mark")), "left").withColumn("__lines", F.split("text", "\n", -1))
    left = F.array_except(F.sequence(F.lit(1), F.size("__lines")), "__gone")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.element_at("__lines", i)), "\n"))
    return changed(docs, full.withColumn("__new", text), "__gone", removed)
