"""N-gram Jaccard join in metric space: pivots, regions, triangle windows, exact.

Jaccard distance on shingle sets is a metric.  The join works on distinct sets (copies
meet in one node) and knows two kinds of pivots:

* *Shingle pivots.*  Two unrelated documents are at distance 1 from nearly every
  document, so documents alone cannot divide them.  A single shingle ``{s}`` can: its
  region is the documents at distance below 1, those that hold it.  A document belongs
  to the regions of its first pivots in one global order, as many as the distance
  bound asks for: two documents within the radius share regions, at least ``votes`` many
  (the window below).  Common shingles come last in the order.
* *Document pivots.*  Regions of common shingles hold many near copies, the same ones in
  hundreds of regions.  There a document is the pivot, and regions with one pivot are one
  cell.  Large cells are divided by size and then into the Voronoi regions of further pivots; the
  triangle inequality says which documents lie at a boundary and must meet the next region too.
  Regions are joined in the same way until they are few enough to compare, all of
  them against all, in one task; a cell that pivots can't divide is compared slice by slice.

Window of shingle pivots: with n shingles a pair within the radius shares at least
o = ceil(0.75 / 1.75 * (n1 + n2)) of them.  From the first k = n - ceil(0.75 n) + ceil(n / 20)
of each, shared ones number at least o - max(n1 - k1, n2 - k2).  All candidates are compared exactly.

Defined cases: null, empty and blank texts have no set and are linked with nothing
(component: their own id); texts of one to four words are one shingle of all words;
repeated rows and equal sets are one node; null ids are never the smallest id; an empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import mix, released, slices, small_side, stored, text_array, tidy, words_of

WIDTH = 5
COMMON = 6  # a shingle counted so often comes last in the order
LARGE = 256  # regions above are divided further, never compared pair by pair
CELL, WEIGHT = 512, 4_000_000  # members, and shingles of a cell that is compared in one task
PIVOTS = 8  # of a cell that is divided
CHUNK = 2_000_000  # shingles a task counts at once
MAX_COMMON = 1 << 20  # bound on the common shingles that are broadcast


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of every text of a slice."""
    w = words_of(texts, lower=True)
    bounds = np.searchsorted(w.doc, np.arange(len(texts) + 1))
    h, last = w.hash, len(w.hash) - WIDTH + 1
    rolled = np.zeros(0, np.uint64)
    if last > 0:
        rolled = h[:last] + np.uint64(1)
        for k in range(1, WIDTH):
            rolled = mix(rolled) + h[k : last + k]
        rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= WIDTH:
            s = np.sort(rolled[a : b - WIDTH + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            one = h[a : a + 1] + mix(np.array([b - a], np.uint64))
            for k in range(a + 1, b):
                one = mix(one) + h[k : k + 1]
            out.append(mix(one))
        else:
            out.append(rolled[:0])
    return out


def signature(s: np.ndarray) -> int:
    """63 bits of the whole set; with the size they stand for the set."""
    if not len(s):
        return -1
    one, two = np.array([np.bitwise_xor.reduce(s)]), np.array([mix(s).sum(dtype=np.uint64)])
    return int((mix(mix(one) + mix(two + np.uint64(len(s)))) >> np.uint64(1))[0])


def prefix_size(n):
    return n - -(-3 * n // 4) + -(-n // 20)


def shared_at_least(n1, n2):
    """Shingles that two sets within the radius share: 100 i >= 75 (n1 + n2 - i)."""
    return -(-75 * (n1 + n2) // 175)


def survey(docs: DataFrame) -> DataFrame:
    """One row per document (id, hash of the text, signature, size) and rows of shingles that a task meets often."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(c, LongType()) for c in ("mark", "sig", "n", "shingle", "held"))])

    def often(kept: list[np.ndarray], kind) -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(kept), return_counts=True)
        value, count = value[count > 1], count[count > 1]
        none = pa.nulls(len(value), pa.int64())
        return pa.RecordBatch.from_arrays([pa.nulls(len(value), kind), none, none, none, pa.array(value.view(np.int64)), pa.array(count)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size, seen, kind = [], 0, set(), pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            texts = text_array(batch.column(1))
            for lo, hi in slices(texts):
                sets = shingle_sets(texts.slice(lo, hi - lo))
                sigs = [signature(s) for s in sets]
                for sig, s in zip(sigs, sets):
                    if sig >= 0 and sig not in seen:
                        seen.add(sig)
                        kept.append(s)
                        size += len(s)
                none = pa.nulls(hi - lo, pa.int64())
                found = pa.array([None if x < 0 else x for x in sigs], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), found, pa.array([len(s) for s in sets], pa.int64()), none, none], schema.names)
                if size > CHUNK:
                    yield often(kept, kind)
                    kept, size, seen = [], 0, set()
        if kept:
            yield often(kept, kind)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(tidy(run), schema)


def common_shingles(rows: DataFrame) -> np.ndarray:
    """The shingles that come last in the order, rarer ones first; at most MAX_COMMON, the most frequent ones.

    A shingle that no task meets twice is in at most one set of each counted
    chunk, which bounds the regions of all others.  The choice only sets the order; the result
    is exact for any order.
    """
    counts = rows.where("shingle is not null").groupBy("shingle").agg(F.sum("held").alias("held")).where(F.col("held") >= COMMON)
    counts = stored(counts, "common")
    kept = {r.power: r.rows for r in counts.groupBy(F.floor(F.log2("held")).alias("power")).agg(F.count("*").alias("rows")).collect()}
    power, total = 63, 0
    while power > 0 and total + kept.get(power - 1, 0) <= MAX_COMMON:
        power -= 1
        total += kept.get(power, 0)
    rows = counts.where(F.floor(F.log2("held")) >= power).orderBy("held", "shingle").select("shingle").toArrow()
    return rows.column(0).to_numpy().view(np.uint64)


def is_in(s: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of s are in the sorted array."""
    if not len(known):
        return np.zeros(len(s), bool)
    return known[np.minimum(np.searchsorted(known, s), len(known) - 1)] == s


def windows(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Rows (shingle, sig, info): each distinct set in the regions of its first pivots.

    info holds the size of the set and whether this pivot is a common one.
    """
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, (known, rank) = set(), shared.value
        for batch in batches:
            texts = text_array(batch.column(0))
            for lo, hi in slices(texts):
                shingle, sig, info = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for s in shingle_sets(texts.slice(lo, hi - lo)):
                    name, n = signature(s), len(s)
                    if not n or name in seen:
                        continue
                    seen.add(name)
                    k = prefix_size(n)
                    late = is_in(s, known)
                    first = s[~late][:k]
                    rest = s[late] if len(first) < k else s[:0]
                    rest = rest[np.argsort(rank[np.searchsorted(known, rest)])][: k - len(first)]
                    shingle += [first, rest]
                    sig.append(np.full(k, name))
                    info.append((np.int64(n) << 1) + (np.arange(k) >= len(first)))
                if len(seen) > 1_000_000:
                    seen = set()
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle).view(np.int64)), pa.array(np.concatenate(sig)), pa.array(np.concatenate(info))], ["shingle", "sig", "info"])

    return docs.select("text").mapInArrow(tidy(run), "shingle long, sig long, info long")


PAIR, MEMBER, OVERFULL = 0, 1, 2


def meet(rows: DataFrame) -> DataFrame:
    """Pairs that share regions of shingle pivots, with votes; members of common regions pass through.

    Rows of common regions are dealt by set, so that no partition holds a whole hot region.
    """
    schema = "kind int, a long, b long, a_info long, b_info long, votes long"
    names = ["kind", "a", "b", "a_info", "b_info", "votes"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def batch_of(kind, a, b, a_info, b_info, votes):
        full = np.full(len(a), kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (full, a, b, a_info, b_info, votes)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for batch in batches:
            shingle, sig, info = (batch.column(k).to_numpy() for k in range(3))
            late = (info & 1).astype(bool)
            zero = np.zeros(late.sum(), np.int64)
            yield batch_of(MEMBER, shingle[late], sig[late], info[late], zero, zero)
            kept.append((shingle[~late], sig[~late], info[~late]))
        if not kept:
            return
        shingle, sig, info = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((sig, shingle))
        shingle, sig, info = shingle[order], sig[order], info[order]
        new = np.ones(len(sig), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (sig[1:] != sig[:-1])
        shingle, sig, info = shingle[new], sig[new], info[new]
        first = np.concatenate([[True], shingle[1:] != shingle[:-1]]) if len(shingle) else np.zeros(0, bool)
        group = np.cumsum(first) - 1
        size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        over = np.flatnonzero(first & (size[group] > LARGE))
        zero = np.zeros(len(over), np.int64)
        yield batch_of(OVERFULL, shingle[over], zero, zero, zero, zero)
        at = np.flatnonzero((size[group] > 1) & (size[group] <= LARGE))
        shingle, sig, info = shingle[at], sig[at], info[at]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        live, step = np.arange(len(sig)), 1
        while len(live):
            live = live[live + step < len(sig)]
            live = live[shingle[live] == shingle[live + step]]
            n1, n2 = info[live] >> 1, info[live + step] >> 1
            near = 4 * np.minimum(n1, n2) >= 3 * np.maximum(n1, n2)
            a.append(live[near])
            b.append(live[near] + step)
            step += 1
        a, b = np.concatenate(a), np.concatenate(b)
        order = np.lexsort((sig[b], sig[a]))
        a, b = a[order], b[order]
        if len(a):
            new = np.concatenate([[True], (sig[a][1:] != sig[a][:-1]) | (sig[b][1:] != sig[b][:-1])])
            start = np.flatnonzero(new)
            votes = np.diff(np.append(start, len(a)))
            a, b = a[start], b[start]
            yield batch_of(PAIR, sig[a], sig[b], info[a], info[b], votes)

    dealt = rows.repartition(parts, "shingle", F.when(F.col("info") % 2 == 1, F.col("sig")))
    return dealt.mapInArrow(tidy(run), schema)


def size_of(info):
    return F.shiftright(F.col(info), 1)


def candidates(met: DataFrame) -> DataFrame:
    """Pairs with enough votes.  Pairs that share a common pivot as well meet in its region, whatever their votes."""
    # the in-region order of a pair is by signature, so a < b everywhere
    pairs = met.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("votes").alias("votes"), F.max("a_info").alias("a_info"), F.max("b_info").alias("b_info"))
    n1, n2 = size_of("a_info"), size_of("b_info")
    rest = lambda n: F.floor(3 * n / 4 + F.lit(0.999)).cast("long") - F.ceil(n / 20)  # noqa: E731  n - k
    least = F.ceil(F.lit(75.0) * (n1 + n2) / 175) - F.greatest(rest(n1), rest(n2))
    return pairs.where(F.col("votes") >= least).select("a", "b")


def sets_of(docs: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored (sig, shingles) of the wanted signatures, from one document of each."""
    one = members.where("sig is not null").join(wanted, "sig", "left_semi").groupBy("sig").agg(F.min("doc_id").alias("id"))
    ids = small_side(one.select("id").distinct())
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(0))
            for lo, hi in slices(texts):
                sets = [s for s in shingle_sets(texts.slice(lo, hi - lo)) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["sig", "shingles"])

    found = rows.mapInArrow(tidy(run), "sig long, shingles binary")
    return stored(found.groupBy("sig").agg(F.first("shingles").alias("shingles")), "sets")


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact (a, b, shared, joint) of every pair: sizes of intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, joint = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                i = int(is_in(x, y).sum())
                shared.append(i)
                joint.append(len(x) + len(y) - i)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(joint, pa.int64())], ["a", "b", "shared", "joint"])

    left = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("y"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return full.mapInArrow(tidy(run), "a long, b long, shared long, joint long")


LINKED = "100 * shared >= 75 * joint"


def divide(regions: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """Links (a, b) between components so far, among the members (region, sig, n) of common regions.

    The region's first member in a hash order is its pivot; regions with one pivot are one cell, so a pair that
    shares many regions meets once.  Cells are divided until they are small: by bands of set sizes, then by
    Voronoi regions of pivots; a cell that pivots can't divide, as all its members are about
    equally near to each other, is compared slice by slice.  A cell within one component is done.
    """
    best = regions.groupBy("region").agg(F.min(F.struct(F.xxhash64("sig"), "sig")).alias("best"))
    named = regions.join(best.select("region", F.col("best.sig").alias("cell")), "region")
    state = named.groupBy("cell", "sig").agg(F.max("n").alias("n")).select("cell", "sig", "n", F.lit(True).alias("home"))
    found, turn = links, 0
    while True:
        found = stored(found, "links")
        state = stored(state.join(components(found), "sig", "left").select("cell", "sig", "n", "home", F.coalesce("root", "sig").alias("comp")), "cells")
        sizes = state.groupBy("cell").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("home").alias("any"))
        sizes = sizes.where("lo != hi and any").select("cell", "size", "weight", ((F.col("size") > CELL) | (F.col("weight") > WEIGHT)).alias("large"))
        live = stored(state.join(sizes, "cell"), "cells")
        small = live.where("not large").select("cell", "sig", "comp", "home", F.lit(-1).alias("side"))
        found = found.unionByName(stored(compared(small, sets), "links"))
        large = live.where("large")
        if large.isEmpty():
            return found
        if turn == 0:
            band = F.floor(F.log("n") / math.log(1.334))  # sizes of linked sets differ by a third at most: neighbouring bands
            parts = large.withColumn("band", F.explode(F.array(band, band + 1))).withColumn("own", F.col("band") == band)
            parts = parts.select("cell", "sig", "n", "comp", (F.col("home") & F.col("own")).alias("home"), F.xxhash64("cell", "band").alias("child"), "size")
        else:
            parts, near = voronoi(large, sets, turn)
            found = found.unionByName(near)
        parts = stored(parts, "parts")
        # parts hardly smaller than their cell: pivots can't divide it
        stuck = parts.groupBy("cell", "child").agg(F.count("*").alias("n"), F.max("size").alias("size")).where("n > 0.75 * size").select("cell").distinct()
        stuck = stored(stuck, "stuck") if turn else stored(stuck.limit(0), "stuck")
        found = found.unionByName(stored(compared(slices_of(large.join(stuck, "cell", "left_semi")), sets), "links"))
        state = parts.join(stuck, "cell", "left_anti").select(F.col("child").alias("cell"), "sig", "n", "home")
        turn += 1


def voronoi(cells: DataFrame, sets: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Members of cells in the regions of their nearest pivots, with the boundary: (cell, child, sig, n, comp, home, size); and links to pivots.

    Of a pair within the radius r, d(x, q) <= d(x, p) + 2 r for the nearest pivots p of x and q of y: there x is a guest.
    """
    rank = F.xxhash64("sig", F.lit(turn))
    pivots = cells.groupBy("cell", F.pmod(rank, F.lit(PIVOTS)).alias("class")).agg(F.min(F.struct(rank, "sig")).alias("best")).select("cell", F.col("best.sig").alias("pivot"))
    placed = cells.join(pivots, "cell").select("cell", "sig", "n", "comp", "home", "size", "pivot")
    apart = placed.where("sig != pivot").select(F.least("sig", "pivot").alias("a"), F.greatest("sig", "pivot").alias("b")).distinct()
    measured = stored(distances(apart, sets), "distances")
    far = placed.withColumn("a", F.least("sig", "pivot")).withColumn("b", F.greatest("sig", "pivot")).join(measured, ["a", "b"], "left")
    far = far.withColumn("d", F.when(F.col("sig") == F.col("pivot"), 0.0).otherwise(1 - F.col("shared") / F.col("joint")))
    own = far.groupBy("cell", "sig", "home").agg(F.min(F.struct("d", "pivot")).alias("nearest"), F.max("n").alias("n"), F.max("comp").alias("comp"), F.max("size").alias("size"), F.collect_list(F.struct("d", "pivot")).alias("each"))
    every = own.withColumn("to", F.explode("each")).where("to.d <= nearest.d + 0.5000001")
    parts = every.select("cell", "sig", "n", "comp", (F.col("home") & (F.col("to.pivot") == F.col("nearest.pivot"))).alias("home"), F.xxhash64("cell", "to.pivot").alias("child"), "size")
    return parts, measured.where(LINKED).select("a", "b")


def slices_of(cells: DataFrame) -> DataFrame:
    """Each member in the cells of its slice with itself and with every other slice."""
    count = F.greatest(F.ceil(F.col("size") * 2 / CELL), F.ceil(F.col("weight") * 2 / WEIGHT)).cast("int")
    own = cells.withColumn("count", count).withColumn("own", F.pmod(F.xxhash64("sig"), F.col("count")).cast("int"))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    side = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int"))
    return pairs.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "sig", "comp", "home", side.alias("side"))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: rare shingles pair by pair, frequent ones by matrix products of blocks."""
    n = len(sets)
    counts = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    times = np.diff(np.append(start, len(value)))
    column = np.repeat(np.arange(len(start)), times)
    rare = times[column] <= 32
    a, b = owner[rare], column[rare]
    live, step = np.arange(len(a)), 1
    flat = counts.reshape(-1)
    while len(live):
        live = live[live + step < len(a)]
        live = live[b[live] == b[live + step]]
        np.add.at(flat, a[live] * n + a[live + step], 1)
        step += 1
    names, at = np.unique(column[~rare], return_inverse=True)
    who = owner[~rare]
    for lo in range(0, len(names), 4096):
        within = (at >= lo) & (at < lo + 4096)
        block = np.zeros((n, 4096), np.float32)
        block[who[within], at[within] - lo] = 1
        counts += np.triu(block @ block.T, 1)
    return counts


def compared(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of a cell (cell, sig, comp, home, side), every two of which are compared exactly.

    Two guests aren't compared, nor two members of one side of a cell with sides.
    """

    def run(table: pa.Table) -> pa.Table:
        sig, comp, side = (table[c].to_numpy() for c in ("sig", "comp", "side"))
        home = table["home"].to_numpy(zero_copy_only=False)
        out: list[tuple[int, int]] = []
        if len(np.unique(comp)) > 1:
            members = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"].combine_chunks()]
            size = np.array([len(s) for s in members], np.float32)
            i = shared_counts(members)
            a, b = np.nonzero((100 * i >= 75 * (size[:, None] + size[None, :] - i)) & (i > 0))
            take = (comp[a] != comp[b]) & (home[a] | home[b]) & ((side[a] != side[b]) | (side[a] < 0))
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while (up := parent.get(x, x)) != x:
                    parent[x] = x = parent.get(up, up)
                return x

            for x, y in zip(a[take].tolist(), b[take].tolist()):
                p, q = root(int(comp[x])), root(int(comp[y]))
                if p != q:
                    parent[p] = q
                    out.append((int(sig[x]), int(sig[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return cells.join(sets, "sig").groupBy("cell").applyInArrow(tidy(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(sig, root) of every linked node: repeated contraction towards the smallest neighbour."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = stored(both.distinct(), "edges")
    labels = stored(edges.select(F.col("u").alias("sig"), F.col("u").alias("root")).distinct(), "labels")
    while not edges.isEmpty():
        to = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to")), "parents")
        back = to.select(F.col("u").alias("root"), "to")
        labels = stored(labels.join(back, "root", "left").select("sig", F.coalesce("to", "root").alias("root")), "labels")
        ends = edges.join(to, "u").select(F.col("to").alias("x"), "v")
        ends = ends.join(to.select(F.col("u").alias("v"), F.col("to").alias("y")), "v")
        edges = stored(ends.where("x != y").select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "edges")
    return labels


def joined(docs: DataFrame) -> DataFrame:
    """Stored, one row per document: doc_id, mark (hash of the text), n, and `first`, the smallest (doc_id, mark) of its component."""
    return released(docs.sparkSession, lambda: components_of(docs), "components")


def components_of(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    seen = stored(survey(docs), "survey")
    members = seen.where("shingle is null").select("doc_id", "mark", "sig", "n")
    common = common_shingles(seen)
    while True:
        met = stored(meet(windows(docs, common)), "met")
        more = met.where(F.col("kind") == OVERFULL).select("a").distinct().limit(MAX_COMMON).toArrow().column(0).to_numpy().view(np.uint64)
        if not len(more):
            break
        common = np.concatenate([common, np.setdiff1d(more, common)])
    pairs = stored(candidates(met), "candidates")
    regions = met.where(F.col("kind") == MEMBER).groupBy(F.col("a").alias("region"), F.col("b").alias("sig")).agg(F.max(size_of("a_info")).alias("n"))
    shared = regions.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
    regions = stored(regions.join(shared.select("region"), "region"), "regions")
    wanted = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).unionByName(regions.select("sig")).distinct()
    sets = sets_of(docs, members, wanted)
    links = distances(pairs, sets).where(LINKED).select("a", "b")
    roots = components(stored(divide(regions, sets, links), "links"))
    least = members.where("sig is not null").groupBy("sig").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("least"))
    rooted = least.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return members.join(rooted.join(smallest, "root").select("sig", "first"), "sig", "left").select("doc_id", "mark", "n", "first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    found = joined(docs)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near duplicates: of each component the document with the smallest (id, hash of the text) stays.

    A row is known by its id and text, so another text under the same id is judged alone.  Documents
    without a set and documents with a null id stay; of rows repeated with the same id and text one stays.
    """
    found = joined(docs).where("doc_id is not null")
    key = (F.col("doc_id") == F.col("__id")) & (F.col("__mark") == F.xxhash64("text"))
    names = [F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")]
    gone = small_side(found.where("n > 0 and first is not null and (doc_id != first.doc_id or mark != first.mark)").select(*names).distinct())
    kept = docs.join(gone, key, "left_anti")
    again = found.groupBy("doc_id", "mark").agg(F.count("*").alias("rows")).where("rows > 1")
    if again.isEmpty():
        return kept
    again = small_side(again.select(*names))
    single = kept.join(again, key, "left_anti")
    return single.unionByName(kept.join(again, key, "left_semi").dropDuplicates(["doc_id", "text"]))
