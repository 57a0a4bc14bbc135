"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source lie in a fixed pseudo-random order and form a stream of words,
cut into blocks of equal length.  A source's quota in words is met exactly: whole passes over the
stream, then the first blocks of a keyed permutation, the last one cut.  The draws of
all sources are divided among output shards by a binary tree: at every node the
number of draws of each source that go left is a multivariate hypergeometric draw.  A
shard follows its path from the root with seeded generators, so shards need neither each other
nor the driver; it gets disjoint intervals of every source's permuted blocks and
shuffles them locally.  Blocks and documents then meet in one join.

Positions in the stream come from sums per (source, hash bucket), so that no task orders
a whole source: the number of buckets is the square root of the number of documents.

Defined cases: null and empty texts have size 0 and are never taken; a null source is
a source of its own, last in the order; sources without words have target 0; repeated rows are taken
one by one; null ids are ids like others; an empty table gives an empty mix.  Only the
sources (at most MAX_SOURCES, checked) pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import mix as scramble, tidy
from .common import slices, stored, text_array, word_counts, word_spans

WEIGHTS = (3.0, 1.0, 2.0)
MAX_SOURCES = 100_000
BLOCK_WORDS = 1024
SHARD_BLOCKS = 256
MAX_DRAWS = 500_000_000  # the generator's bound; longer streams get longer blocks


def sized(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, source, rank, size); rank is the place in the pseudo-random order."""
    rows = docs.select("doc_id", "source", F.xxhash64("doc_id", "text").alias("rank"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(3))
            counts = [word_counts(texts.slice(lo, hi - lo)) for lo, hi in slices(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], ["doc_id", "source", "rank", "size"])

    return stored(rows.mapInArrow(tidy(run), StructType([*rows.schema.fields[:3], StructField("size", LongType())])), "sizes")


def targets(sizes: list[float], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words per source: `share` of all sizes by weight, at most `most` times the source; the excess goes to the others by weight."""
    out, free, left = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0], share * sum(sizes)
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def feistel(x: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. n-1: four Feistel rounds, walked until the value is below n."""
    if n <= 1:
        return x.copy()
    half = max(1, math.ceil(math.log2(n) / 2))
    mask = np.uint64((1 << half) - 1)
    keys = [scramble(np.array([(key * 4 + r) & 0xFFFFFFFFFFFF], np.uint64)) for r in range(4)]

    def once(v):
        hi, lo = v >> np.uint64(half), v & mask
        for k in reversed(keys) if back else keys:
            if back:
                hi, lo = lo ^ (scramble(hi + k) & mask), hi
            else:
                hi, lo = lo, hi ^ (scramble(lo + k) & mask)
        return hi << np.uint64(half) | lo

    out = once(x.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


@dataclass
class Plan:
    """What every shard has to know: one entry per source."""

    names: list
    sizes: list[int]
    target: list[float]
    block: int
    seed: int

    def __post_init__(self):
        s, b = np.array(self.sizes, np.int64), self.block
        quota = np.array([round(t) for t in self.target], np.int64)
        self.blocks = -(-s // b)
        self.passes = np.where(s > 0, quota // np.maximum(s, 1), 0)
        rest = quota - self.passes * s
        self.whole, self.cut = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        for i in range(len(s)):
            if rest[i]:
                n = int(self.blocks[i])
                short = int(s[i] - (n - 1) * b)
                at = int(feistel(np.array([n - 1]), n, self.key(i, int(self.passes[i])), back=True)[0])  # where the short block comes
                over = int(rest[i]) - at * b - short
                p = at + 1 + over // b if over >= 0 else min(int(rest[i] // b), at)
                self.whole[i] = p
                self.cut[i] = rest[i] - (p * b if p <= at else (p - 1) * b + short)
        self.draws = self.passes * self.blocks + self.whole + (self.cut > 0)
        self.total = int(self.draws.sum())
        self.shards = max(1, -(-self.total // SHARD_BLOCKS))

    def key(self, source: int, turn: int) -> int:
        return self.seed * 1_000_003 + source * 131 + turn

    def before(self, shard: int) -> int:
        """Draws of all shards below this one."""
        return shard * (self.total // self.shards) + min(shard, self.total % self.shards)

    def quotas(self, shards: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, first draw, number of draws) by source: walks the tree down to the given shards."""
        stack = [(0, self.shards, np.zeros_like(self.draws), self.draws, sorted(shards))]
        while stack:
            lo, hi, first, count, wanted = stack.pop()
            if not wanted:
                continue
            if hi - lo == 1:
                yield lo, first, count
                continue
            mid = (lo + hi) // 2
            rng = np.random.default_rng([self.seed, lo, hi])
            left = rng.multivariate_hypergeometric(count, self.before(mid) - self.before(lo), method="marginals")
            stack.append((mid, hi, first + left, count - left, [x for x in wanted if x >= mid]))
            stack.append((lo, mid, first, left, [x for x in wanted if x < mid]))

    def drawn(self, shard: int, first: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
        """The blocks of a shard in the order of its output."""
        parts = []
        for i in np.flatnonzero(count):
            j = np.arange(first[i], first[i] + count[i])
            turn, place, n = j // self.blocks[i], j % self.blocks[i], int(self.blocks[i])
            block = np.empty_like(j)
            for e in np.unique(turn):
                block[turn == e] = feistel(place[turn == e], n, self.key(int(i), int(e)))
            words = np.full(len(j), self.block)
            words[(turn == self.passes[i]) & (place == self.whole[i])] = self.cut[i]
            parts.append((np.full(len(j), i), turn, block, words))
        source, turn, block, words = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4
        order = np.random.default_rng([self.seed, shard, 1]).permutation(len(source))
        return {"shard": np.full(len(order), shard), "slot": np.arange(len(order)), "s": source[order], "turn": turn[order], "block": block[order], "words": words[order]}


def make_plan(rows: DataFrame, seed: int, weights=WEIGHTS, share: float = 1.5) -> Plan:
    """Targets of all sources; one row per source reaches the driver."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r["size"]) for r in found]
    target = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share)
    block = max(BLOCK_WORDS, -(-2 * sum(sizes) // MAX_DRAWS))
    return Plan([r.source for r in found], sizes, target, block, seed)


def draws(spark: SparkSession, plan: Plan) -> DataFrame:
    """(shard, slot, s, turn, block, words) of the whole mix."""
    shared = spark.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first, count in shared.value.quotas(batch.column(0).to_pylist()):
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in shared.value.drawn(shard, first, count).items()})

    return spark.range(plan.shards).mapInArrow(tidy(run), "shard long, slot long, s long, turn long, block long, words long")


def placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """Stored rows with the number of their source and the start in its stream of words."""
    spark = rows.sparkSession
    schema = StructType([rows.schema["source"], StructField("s", LongType()), StructField("total", LongType())])
    names = spark.createDataFrame([(n, i, plan.sizes[i]) for i, n in enumerate(plan.names)], schema).withColumnRenamed("source", "name")
    known = rows.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).drop("name")  # one row per source
    bits = max(0, math.ceil(math.log2(max(1, rows.count())) / 2))
    known = known.withColumn("bucket", F.shiftrightunsigned("rank", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = known.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    whole = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "bucket", F.coalesce(F.sum("words").over(whole), F.lit(0)).alias("base"))
    part = Window.partitionBy("s", "bucket").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = known.join(sums, ["s", "bucket"]).withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(part), F.lit(0)))
    return stored(out.select("doc_id", "source", "s", "rank", "size", "start"), "placed")


def pieces(rows: DataFrame, plan: Plan) -> DataFrame:
    """(s, start, turn, shard, slot, first, last): words first .. last-1 of a placed row, for every draw that touches it."""
    b = plan.block
    reach = rows.where("size > 0").select("s", "start", "size", F.explode(F.sequence(F.expr(f"start div {b}"), F.expr(f"(start + size - 1) div {b}"))).alias("block"))
    # a merge join: the optimizer takes the draws for as small as the range of shards they come from
    met = reach.join(draws(rows.sparkSession, plan).hint("merge"), ["s", "block"])
    first = F.greatest("start", F.col("block") * b) - F.col("start")
    last = F.least(F.col("start") + F.col("size"), F.col("block") * b + F.col("words")) - F.col("start")
    return met.select("s", "start", "turn", "shard", "slot", first.alias("first"), last.alias("last")).where("last > first")


def mix(docs: DataFrame, seed: int = 3, weights=WEIGHTS, share: float = 1.5) -> tuple[DataFrame, DataFrame, Plan]:
    """The placed rows, the pieces of the mix, and the plan."""
    rows = sized(docs)
    plan = make_plan(rows, seed, weights, share)
    rows = placed(rows, plan)
    return rows, pieces(rows, plan), plan


def taken(rows: DataFrame, parts: DataFrame, plan: Plan) -> DataFrame:
    """One row per document: size, size and target of the source, words taken."""
    spark = rows.sparkSession
    sums = parts.groupBy("s", "start").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    facts = spark.createDataFrame([(i, n, float(t)) for i, (n, t) in enumerate(zip(plan.sizes, plan.target))], "s long, source_size long, target double")
    full = rows.join(sums, ["s", "start"], "left").join(F.broadcast(facts), "s")  # one row per source
    return full.select("doc_id", "size", "source_size", "target", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, seed: int = 3, weights=WEIGHTS, share: float = 1.5) -> DataFrame:
    """The texts of the mix in the columns of `docs`: a row per document and pass.

    A pass that takes all words of a document gives its text unchanged, one that takes
    parts gives these parts, joined by a line break; n_chars follows the text.  Every
    other column is carried over.
    """
    rows, parts, _ = mix(docs, seed, weights, share)
    parts = parts.join(rows.where("size > 0").select("s", "start", "rank", "source", "doc_id"), ["s", "start"])
    spans = parts.groupBy(F.col("rank").alias("__place"), F.col("source").alias("__source"), F.col("doc_id").alias("__id")).agg(F.sort_array(F.collect_list(F.struct("start", "turn", "first", "last"))).alias("__spans"))
    one = docs.withColumn("__rank", F.xxhash64("doc_id", "text")).dropDuplicates(["__rank", "doc_id", "source"])
    full = one.join(spans, (F.col("__rank") == F.col("__place")) & F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")))
    full = full.select(*(F.col(f"`{c}`") for c in docs.columns), "__spans")
    at, chars = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, texts = [], []
            for i, (text, spans) in enumerate(zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())):
                raw, (begin, end) = text.encode(), word_spans(text)
                runs: dict = {}
                for x in spans:
                    group = runs.setdefault((x["start"], x["turn"]), [])
                    if group and group[-1][1] == x["first"]:
                        group[-1][1] = x["last"]
                    else:
                        group.append([x["first"], x["last"]])
                for group in runs.values():
                    index.append(i)
                    texts.append(text if group == [[0, len(begin)]] else "\n".join(raw[begin[a] : end[b - 1]].decode() for a, b in group))
            kept = batch.select(batch.schema.names[:-1]).take(pa.array(index, pa.int64()))
            columns = list(kept.columns)
            columns[at] = pa.array(texts, pa.string())
            if chars >= 0:
                columns[chars] = pa.array(list(map(len, texts)), pa.int64()).cast(columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, schema=kept.schema)

    return full.mapInArrow(tidy(run), docs.schema)
