"""Prefix trie of conversations by a splitter skeleton.

A turn is known by a digest of its role and text, a conversation by the string of its turns' digests, so the
members of a trie node are a run of the sorted paths.  Equal paths are merged and counted first (a
conversation copied many times is one path).  Splitters drawn from the paths cut the sorted paths into
shards; the trie of the splitter paths, the skeleton, is broadcast.  A node that isn't on the path of a splitter
lies in one shard, which finishes it alone, streaming over its sorted paths.  Nodes of the skeleton may
reach over several shards: every shard gives a partial aggregate, these are reduced by node and
summed up along the skeleton.

Conversations of any length: the place of a turn is a distributed rank, and paths are cut into pieces of `PIECE`
turns; the pieces of one depth are a trie of their own, whose roots hand their sums to the pieces before them.
Lists of the conversations that end in a node are sorted by range, put together in chunks, and
digested in a stream.

Bounds: at most `SHARDS` splitters of `SPLITTER_TURNS` turns each, so the skeleton has at most their product of
nodes, half a million, which the driver sums up; everything else stays in tasks.

Defined cases: rows without conversation id take no part; null roles and texts are empty; null turn numbers come
first, equal ones in order of role, then of the first `TIE_CHARS` characters of the text and its digest; repeated rows are
turns of their own; a conversation that keeps no turn is a member of the root; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

UNIT = 32  # characters of a digest
PIECE = 4096  # turns of a piece
SHARDS, SHARD_TURNS = 8192, 1 << 18
SPLITTER_TURNS = 64
SAMPLES = 64  # paths drawn for a splitter
TIE_CHARS = 64
CHUNK = 4096  # conversation ids of a chunk
SHARED_BY, HEADS = 20, 4  # every 20th conversation lends its first turns, fewer than 4
NODES = 20_000  # rows of an output batch
NO_ENDS = hashlib.sha256(b"").hexdigest()


def digest(*columns: Column) -> Column:
    return F.left(F.sha2(F.concat_ws(":", *columns), 256), F.lit(UNIT))


def ranked(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn_digest, words): places from 1, by ranges of rows and the rows of the ranges before."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.left(text, F.lit(TIE_CHARS)).alias("start"),
        digest(F.sha2(role, 256), F.sha2(text, 256)).alias("turn_digest"), words.alias("words"),
    )
    order = ["turn", "role", "start", "turn_digest"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored, as ranges may differ when a task runs again; equal rows may fall on both sides of a border
    ranged = stored(rows.repartitionByRange(parts, "conv_id", *order).withColumn("range", F.spark_partition_id()), "turn-ranges")
    totals = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # a range begins inside one conversation at most: no more offsets than ranges
    offsets = totals.withColumn("offset", F.sum("n").over(before)).where("offset is not null").select("conv_id", "range", "offset")
    within = Window.partitionBy("range", "conv_id").orderBy(*order)
    placed = ranged.withColumn("place", F.row_number().over(within)).join(F.broadcast(offsets), ["conv_id", "range"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("place"), "turn_digest", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn_digest, words): turns lent by another conversation, then the own ones; depth 0 of every conversation."""
    rows = stored(ranked(turns), "turns")
    lent = rows.where((F.pmod("conv_id", F.lit(SHARED_BY)) == 0) & (F.col("place") < HEADS))
    lent = lent.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "turn_digest", "words"))).alias("heads")).withColumnRenamed("conv_id", "lender")
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.select(
        "conv_id",
        (F.col("conv_id") - F.pmod("conv_id", F.lit(SHARED_BY))).alias("lender"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("h"),
    )
    convs = convs.join(lent, "lender", "left").withColumn("heads", F.slice(F.coalesce("heads", F.array().cast("array<struct<place:long,turn_digest:string,words:long>>")), F.lit(1), F.col("h")))
    top = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("turn_digest"), F.lit(0).cast("long").alias("words"))
    first = convs.select("conv_id", F.posexplode("heads").alias("at", "head")).select("conv_id", (F.col("at") + 1).cast("long"), "head.turn_digest", "head.words")
    own = rows.join(convs.select("conv_id", "h", F.size("heads").alias("lent")), "conv_id").where("place > h")
    return top.union(first).union(own.select("conv_id", F.col("place") - F.col("h") + F.col("lent"), "turn_digest", "words"))


def pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, k, path, words, next): depth PIECE * k to PIECE * (k + 1) of a conversation.

    path begins with a digest of all turns before the piece, next is that of the piece after (null at the end).
    """
    k = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / PIECE).cast("int")
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt by piece, or a long conversation would meet in one task
    cut = turns.withColumn("k", k).repartition(parts, "conv_id", "k").groupBy("conv_id", "k").agg(F.sort_array(F.collect_list(F.struct("depth", "turn_digest", "words"))).alias("turns"))
    cut = cut.select("conv_id", "k", F.array_join("turns.turn_digest", "").alias("own"), F.filter(F.transform("turns", lambda t: F.when(t["depth"] > 0, t["words"])), lambda w: w.isNotNull()).alias("words"))
    cut = stored(cut, "pieces")
    if not (cut.agg(F.max("k")).first()[0] or 0):
        return cut.select("conv_id", "k", F.concat(F.lit("0" * UNIT), "own").alias("path"), "words", F.lit(None).cast("string").alias("next"))
    chain = Window.partitionBy("conv_id").orderBy("k")
    marks = [F.sum(F.xxhash64("k", "own", F.lit(s)).cast("decimal(38,0)")).over(chain.rowsBetween(Window.unboundedPreceding, -1)) for s in (1, 2)]
    named = cut.select("*", F.when(F.col("k") == 0, F.lit("0" * UNIT)).otherwise(digest(*(m.cast("string") for m in marks))).alias("prefix"))
    return named.select("conv_id", "k", F.concat("prefix", "own").alias("path"), "words", F.lead("prefix").over(chain).alias("next"))


def ends_of(members: DataFrame) -> DataFrame:
    """(pid, ends): digest of the ids of the members, in ascending order."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(pid, ids):
            return [(pid, ids[i], ",".join(map(str, ids[i : i + CHUNK]))) for i in range(0, len(ids), CHUNK)]

        held, ids = None, []
        for batch in batches:
            out = []
            for pid, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if pid != held or len(ids) == CHUNK:
                    out += rows_of(held, ids)
                    held, ids = pid, []
                ids.append(conv)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out) if out else [[]] * 3, kinds)], names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows_of(held, ids)), kinds)], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha = None, None
        for batch in batches:
            out = []
            for pid, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if pid != held:
                    if held is not None:
                        out.append((held, sha.hexdigest()))
                    held, sha = pid, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*out) if out else [[], []])], ["pid", "ends"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([sha.hexdigest()])], ["pid", "ends"])

    kinds, names = (pa.string(), pa.int64(), pa.string()), ["pid", "first", "ids"]
    cut = members.repartitionByRange(parts, "pid", "conv_id").sortWithinPartitions("pid", "conv_id").mapInArrow(chunks, "pid string, first long, ids string")
    return stored(cut, "end-chunks").repartition(parts, "pid").sortWithinPartitions("pid", "first").mapInArrow(digests, "pid string, ends string")


def paths(cut: DataFrame) -> DataFrame:
    """One stored row per distinct piece: pid, k, path, words, next, n and least of its conversations, ends of those that end here."""
    cut = cut.withColumn("pid", digest(F.col("k").cast("string"), F.col("path")))
    first = {c: F.first(c).alias(c) for c in ("k", "path", "words")}
    one = cut.groupBy("pid").agg(*first.values(), F.max("next").alias("next"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
    return stored(one.join(ends_of(cut.where("next is null").select("pid", "conv_id")), "pid", "left"), "paths")


def splitters(level: DataFrame, shards: int) -> list[str]:
    """At most shards - 1 paths that cut the level into parts of about as many turns."""
    count = level.count()
    every = max(1, count // (SAMPLES * shards))
    drawn = level.where(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0)
    drawn = sorted((r.path, r.turns) for r in drawn.select(F.left("path", F.lit((SPLITTER_TURNS + 1) * UNIT)).alias("path"), (F.size("words") + 1).alias("turns")).collect())
    total, passed, found = sum(t for _, t in drawn), 0, []
    for path, turns in drawn:
        passed += turns
        if passed * shards >= total * (len(found) + 1) and len(found) + 1 < shards:
            found.append(path)
    return sorted(set(found))


def units(path: str) -> list[str]:
    return [path[i : i + UNIT] for i in range(0, len(path), UNIT)]


def skeleton(cuts: list[str]) -> tuple[dict[tuple[int, str], int], list[int], list[int], list[str]]:
    """Nodes on the paths of the splitters: number by (number of the parent, unit); parent, height and unit of each, parents first."""
    number, parent, height, unit = {}, [], [], []
    for path in cuts:
        at = -1
        for u in units(path):
            key = (at, u)
            if key not in number:
                number[key] = len(parent)
                height.append(0 if at < 0 else height[at] + 1)
                parent.append(at)
                unit.append(u)
            at = number[key]
    return number, parent, height, unit


DONE, BELOW_SKELETON, PARTIAL, ROOT = range(4)
ROW = "kind int, skeleton long, prefix string, conv_id long, height long, parent long, n long, children long, leaves long, saved long, words long, ends string"
NAMES = [c.split()[0] for c in ROW.split(", ")]
KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


class Node:
    __slots__ = ("mark", "unit", "words", "n", "least", "children", "leaves", "saved", "ends", "more", "held", "known")

    def __init__(self, mark: int, unit: str, words: int) -> None:
        self.mark, self.unit, self.words = mark, unit, words
        self.n, self.least, self.children, self.leaves, self.saved, self.ends, self.more, self.held, self.known = 0, None, 0, 0, 0, None, False, [], None


def shard_nodes(level: DataFrame, cuts: list[str]) -> DataFrame:
    """Rows `ROW` of the nodes of one level: finished ones, partial ones of the skeleton, and roots."""
    spark = level.sparkSession
    number, _, _, _ = skeleton(cuts)
    shared = spark.sparkContext.broadcast((cuts, number))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect.bisect_right(shared.value[0], p) for p in batch.column("path").to_pylist()]
            yield batch.append_column("shard", pa.array(at, pa.int32()))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out, stack, before = shared.value[1], [], [], []

        def close() -> None:
            x = stack.pop()
            above = stack[-1] if stack else None
            if above is not None:
                above.n += x.n
                above.least = x.least if above.least is None else min(above.least, x.least)
            height, prefix = len(stack), x.unit if above is None else None
            if x.mark >= 0:
                out.append((PARTIAL, x.mark, prefix, x.least, height, x.known, x.n, x.children, x.leaves, x.saved, x.words, x.ends))
                return
            for row in x.held:
                out.append((*row[:5], x.least if x.known is None else x.known, *row[6:]))
            leaves = x.leaves + (x.children == 0)
            saved = x.saved + (x.n - 1) * x.words
            if above is None:
                out.append((ROOT, None, prefix, x.least, height, None, x.n, x.children, leaves, saved, x.words, x.ends))
                return
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            row = (DONE if above.mark < 0 else BELOW_SKELETON, None if above.mark < 0 else above.mark, prefix, x.least, height, None, x.n, x.children, leaves, saved, x.words, x.ends)
            (above.held if above.mark < 0 else out).append(row)

        def batch_of() -> pa.RecordBatch:
            cols = zip(*out) if out else [[]] * len(NAMES)
            made = pa.RecordBatch.from_arrays([pa.array(c, KINDS[t.split()[1]]) for c, t in zip(cols, ROW.split(", "))], NAMES)
            out.clear()
            return made

        for batch in batches:
            for r in batch.to_pylist():
                path, same = units(r["path"]), 0
                while same < len(before) and same < len(path) and before[same] == path[same]:
                    same += 1
                while len(stack) > same:
                    close()
                for i in range(same, len(path)):
                    up = stack[-1].mark if stack else -1
                    mark = known.get((up, path[i]), -1) if up >= 0 or not stack else -1
                    stack.append(Node(mark, path[i], r["words"][i - 1] if i else 0))
                stack[0].known = r["known"]
                last, before = stack[-1], path
                last.n += r["n"]
                last.least = r["least"] if last.least is None else min(last.least, r["least"])
                last.ends = r["ends"]
                last.children += r["more_children"]
                last.leaves += r["more_leaves"]
                last.saved += r["more_saved"]
                if len(out) >= NODES:
                    yield batch_of()
        while stack:
            close()
        yield batch_of()

    parts = max(1, len(cuts) + 1)
    dealt = level.select("path", "words", "n", "least", "ends", "known", "more_children", "more_leaves", "more_saved")
    kinds = ", ".join(f"{n} {t}" for n, t in dealt.dtypes)
    dealt = dealt.mapInArrow(deal, f"{kinds}, shard int").repartition(parts, "shard").sortWithinPartitions("shard", "path")
    return stored(dealt.mapInArrow(finish, ROW), "trie-nodes")


def skeleton_rows(spark: SparkSession, found: DataFrame, cuts: list[str]) -> tuple[DataFrame, DataFrame]:
    """The nodes of the skeleton, finished, and the conversation that names each: partial aggregates reduced by node, then summed along the skeleton."""
    _, parent, height, unit = skeleton(cuts)
    parts = found.where(F.col("kind") == PARTIAL).groupBy("skeleton").agg(
        F.min("conv_id").alias("least"), F.max("parent").alias("known"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")), F.max("words").alias("words"), F.max("ends").alias("ends")
    )
    by = {r.skeleton: r.asDict() for r in parts.collect()}  # at most SHARDS * (SPLITTER_TURNS + 1) rows
    for i in reversed(range(len(parent))):  # children come after their parents
        x = by[i]
        x["leaves"] += x["children"] == 0
        x["saved"] += (x["n"] - 1) * x["words"]
        if parent[i] >= 0:
            up = by[parent[i]]
            up["children"] += 1
            up["leaves"] += x["leaves"]
            up["saved"] += x["saved"]
    name = lambda i: by[i]["least"] if by[i]["known"] is None else by[i]["known"]
    rows = [
        (DONE if p >= 0 else ROOT, i, unit[i] if p < 0 else None, by[i]["least"], height[i], name(p) if p >= 0 else None, by[i]["n"], by[i]["children"], by[i]["leaves"], by[i]["saved"], by[i]["words"], by[i]["ends"])
        for i, p in enumerate(parent)
    ]
    names = [(i, name(i)) for i in range(len(parent))]
    return spark.createDataFrame(rows, ROW), spark.createDataFrame(names, "skeleton long, parent long")


def nodes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    spark = conversations.sparkSession
    every = paths(pieces(rebuilt(conversations.select("conv_id", "turn", "role", "text"))))
    size = every.agg(F.max("k").alias("k"), F.sum(F.size("words") + 1).alias("turns")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(SHARDS, max(parts, (size.turns or 0) // SHARD_TURNS))
    out, roots = None, None
    for k in range(size.k or 0, -1, -1):
        level = every.where(F.col("k") == k)
        nothing = [F.lit(0).cast("long").alias(c) for c in ("more_children", "more_leaves", "more_saved")]
        level = level.join(roots, "next", "left").fillna(0, ["more_children", "more_leaves", "more_saved"]) if roots is not None else level.select("*", *nothing)
        if k:  # the children of a level's root belong to a node of the level before, which may have further members
            before = every.where((F.col("k") == k - 1) & F.col("next").isNotNull()).select(F.col("next").alias("__next"), F.col("least").alias("known"))
            level = level.join(before, F.left("path", F.lit(UNIT)) == F.col("__next"), "left")
        else:
            level = level.withColumn("known", F.lit(None).cast("long"))
        cuts = splitters(level, shards)
        found = shard_nodes(level, cuts)
        made = found.where(F.col("kind") != PARTIAL)
        if cuts:
            rows, names = skeleton_rows(spark, found, cuts)
            below = made.where(F.col("kind") == BELOW_SKELETON).drop("parent").join(F.broadcast(names), "skeleton")
            made = made.where(F.col("kind") != BELOW_SKELETON).unionByName(below.select(*NAMES)).unionByName(rows)
        level_rows = made.where(F.col("kind") != ROOT) if k else made
        level_rows = level_rows.select(
            "conv_id", (F.col("height") + k * PIECE).alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
        out = level_rows if out is None else out.unionByName(level_rows)
        roots = made.where(F.col("kind") == ROOT).select(F.col("prefix").alias("next"), F.col("children").alias("more_children"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    return out
