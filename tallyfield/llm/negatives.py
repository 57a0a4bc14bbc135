"""Hard-negative mining with the threshold algorithm over per-dimension sorted lists.

Rows are packed into blocks of at most `BLOCK` rows, each with one ascending list of its rows per
dimension.  For an anchor the lists are read from the end that its sign favours (sorted access);
rows met for the first time are scored in whole numbers (random access); the value that no unseen
row can exceed is the sum of the anchor's components times those at the frontier of the lists.  A block
is left once this threshold is strictly below the k-th score of every window of the anchor, or below
the window itself.  Every block is searched for every anchor, block by batch of anchors; the best
k of all blocks are ranked by Spark.

Two searches run on the same lists: the positives (one window an anchor: all scores, same label) and
the negatives (one window a positive: a range of scores, another label).

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no
part; of rows with one id the smallest (label, vector) counts, so repeated rows count once; shorter
vectors are filled up with zeros; equal scores are ordered by id; anchors without positives or without
negatives in a window give no rows; a score that may exceed 63 bits is an error; an empty table
gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK = 8192  # rows of a block at most
FILE_BLOCKS = 4  # of a file at most: a task holds the blocks of a file at once
ANCHORS = 512  # anchors of a batch, about
K = 5
PACKED_BYTES = 32 << 20  # of packed blocks and batches in one Arrow batch
SCALE = 256
RELABEL_EVERY, LABELS = 7, 10
ANCHOR_EVERY = 100


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, q): one row per id that takes part, components as whole numbers."""
    sound = F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col(id_col) % RELABEL_EVERY == 0, (F.col(label).cast("long") + 1) % LABELS).otherwise(F.col(label).cast("long"))
    q = F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    kept = rows.where(sound & finite).select(F.col(id_col).cast("long").alias("vec_id"), moved.alias("label"), q.alias("q"))
    one = kept.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row"))
    return one.select("vec_id", "row.label", "row.q")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows by dimensions, shorter rows filled up with zeros, one dimension at least."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(1, int(size.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy()
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest signed kind."""
    low, high = int(a.min(initial=0)), int(a.max(initial=0))
    return a.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def sorted_lists(rows: DataFrame) -> DataFrame:
    """Blocks (block, n, wide, ids, labels, q, lists) of the rows of a partition, in order of id."""

    def pack(block: str, ids, labels, q) -> pa.RecordBatch:
        q = narrow(q)
        lists = np.argsort(q, axis=0, kind="stable").T.astype(np.uint16)
        values = [[block], [len(ids)], [q.dtype.itemsize], [ids.tobytes()], [labels.tobytes()], [q.tobytes()], [lists.tobytes()]]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["block", "n", "wide", "ids", "labels", "q", "lists"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush():
            t = pa.Table.from_batches(held)
            ids = t["vec_id"].to_numpy()
            return pack(str(ids[0]), ids, t["label"].to_numpy(), matrix(t["q"]))

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == BLOCK:
                    yield flush()
                    held, rows = [], 0
        if held:
            yield flush()

    return rows.sortWithinPartitions("vec_id").mapInArrow(run, "block string, n long, wide long, ids binary, labels binary, q binary, lists binary")


def anchors_of(blocks: DataFrame) -> DataFrame:
    """(anchor, label, q): the rows of the blocks whose id is divisible by `ANCHOR_EVERY`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                at = np.flatnonzero(ids % ANCHOR_EVERY == 0)
                q = np.frombuffer(r["q"], f"i{r['wide']}").reshape(len(ids), -1)[at].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(labels[at]), pa.array([x.tobytes() for x in q], pa.binary())], ["anchor", "label", "q"])

    return blocks.select("wide", "ids", "labels", "q").mapInArrow(run, "anchor long, label long, q binary")


def exact_kind(dims: int, a: int, b: int):
    """Number kind in which the products of whole numbers up to a and b are exact."""
    bound = dims * a * b
    if bound >= 1 << 63:
        raise ValueError("a score may exceed 63 bits")
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def threshold_search(q: np.ndarray, lists: np.ndarray, allowed: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window [low, high] the rows of the block with the k highest scores in it, and the scores.

    q: rows by dimensions, lists: dimensions by ranks (row numbers, ascending by value), allowed: rows
    that may be returned.  Rows tied with the k-th score are all returned.
    """
    n, dims = q.shape
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    if not len(up) and not len(down):
        up = np.zeros(1, np.int64)  # every score is zero: one list reaches all rows
    lists_up, lists_down = lists[up], lists[down]
    seen, scores, depth = np.zeros(n, bool), np.zeros(n, q.dtype), 0
    rows, found = np.zeros(0, np.int64), np.zeros(0, q.dtype)
    open_windows, reach = np.arange(len(low)), low.min()
    while True:
        next_depth = min(n, max(2 * depth, n // 8, 16))
        met = np.zeros(n, bool)
        met[lists_up[:, n - next_depth : n - depth]] = True  # sorted access
        met[lists_down[:, depth:next_depth]] = True
        fresh = np.flatnonzero(met & ~seen)
        seen |= met
        depth = next_depth
        if 2 * len(fresh) > n:  # random access: whole-number scores of the rows met for the first time
            scores = q @ anchor
            got = scores[fresh]
        else:
            got = q[fresh] @ anchor
        take = allowed[fresh] & (got >= reach)
        rows, found = np.concatenate([rows, fresh[take]]), np.concatenate([found, got[take]])
        threshold = (anchor[up] * q[lists_up[:, n - depth], up]).sum() + (anchor[down] * q[lists_down[:, depth - 1], down]).sum()
        still = []
        for w in open_windows:
            inside = found[(found >= low[w]) & (found <= high[w])]
            kth = np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else low[w]
            if threshold >= kth:
                still.append(w)
        open_windows = np.array(still, np.int64)
        if not len(open_windows) or depth == n or seen.all():
            break
    out = []
    for w in range(len(low)):
        at = np.flatnonzero((found >= low[w]) & (found <= high[w]))
        if len(at) > k:
            at = at[found[at] >= np.partition(found[at], len(at) - k)[len(at) - k]]
        out.append((rows[at], found[at]))
    return out


def search(blocks: DataFrame, queries: DataFrame, same: bool, k: int = K) -> DataFrame:
    """(anchor, tag, target, vec_id, score, place): the first k rows of every query's window, over all blocks.

    queries: anchor, label, q, tag, low, high.  `same`: rows of the anchor's label other than itself, else rows of other labels.
    """
    spark = blocks.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", PACKED_BYTES)
    size = queries.agg(F.count_distinct("anchor")).first()[0]
    slots = max(1, blocks.count())
    packed = queries.withColumn("batch", F.pmod(F.xxhash64("anchor"), F.lit(-(-size // ANCHORS) or 1))).groupBy("batch").applyInArrow(
        lambda t: pa.table({
            "batch": t["batch"][:1],
            **{c: pa.array([t[c].combine_chunks().cast(pa.int64()).to_numpy().tobytes()], pa.binary()) for c in ("anchor", "label", "tag", "low", "high")},
            "sizes": pa.array([np.array([len(x) // 8 for x in t["q"].to_pylist()], np.int64).tobytes()], pa.binary()),
            "wanted": pa.array([b"".join(t["q"].to_pylist())], pa.binary()),
        }),
        "batch long, anchor binary, label binary, tag binary, low binary, high binary, sizes binary, wanted binary",
    )
    # a stated set of queries against all rows: every batch travels once to every slot of blocks, by a shuffle, as the optimizer
    # would broadcast all copies by the size of one; the blocks of a slot are few and stand on the right, which the join holds
    packed = packed.withColumnRenamed("label", "own").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    placed = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    pairs = packed.hint("merge").join(placed, "slot").drop("slot", "block", "batch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                num = lambda c: np.frombuffer(r[c], np.int64)
                ids, labels, anchor, own, tag, low, high = (num(c) for c in ("ids", "labels", "anchor", "own", "tag", "low", "high"))
                q = np.frombuffer(r["q"], f"i{r['wide']}").reshape(len(ids), -1)
                lists = np.frombuffer(r["lists"], np.uint16).reshape(q.shape[1], -1)
                sizes, wanted = num("sizes"), num("wanted")
                ends = np.cumsum(sizes)
                kind = exact_kind(q.shape[1], int(np.abs(q.astype(np.int64)).max(initial=0)), int(np.abs(wanted).max(initial=0)))
                q, out = q.astype(kind), []
                order = np.lexsort((tag, anchor))
                cuts = np.flatnonzero(np.diff(anchor[order], prepend=anchor[order[0]] - 1)) if len(order) else order
                for at in np.split(order, cuts[1:]):
                    a = at[0]
                    vector = np.zeros(q.shape[1], kind)
                    given = wanted[ends[a] - sizes[a] : ends[a]][: q.shape[1]]
                    vector[: len(given)] = given
                    allowed = (labels == own[a]) & (ids != anchor[a]) if same else labels != own[a]
                    for i, (rows, scores) in zip(at, threshold_search(q, lists, allowed, vector, low[at], high[at], k)):
                        out.append((np.full(len(rows), anchor[a]), np.full(len(rows), tag[i]), np.full(len(rows), high[i]), ids[rows], scores.astype(np.int64)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["anchor", "tag", "target", "vec_id", "score"])

    best = pairs.mapInArrow(run, "anchor long, tag long, target long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("place", place).where(F.col("place") <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", k: int = K, least_percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive."""
    blocks = stored(sorted_lists(whole_vectors(rows, id_col, vector, label)), "sorted-lists", maxRecordsPerFile=FILE_BLOCKS)
    anchors = stored(anchors_of(blocks), "anchors")
    limit = (1 << 63) - 1
    all_scores = anchors.select("*", F.lit(0).cast("long").alias("tag"), F.lit(-limit).alias("low"), F.lit(limit).alias("high"))
    positives = stored(search(blocks, all_scores, True, k).select("anchor", F.col("vec_id").alias("tag"), F.col("score").alias("high")), "positives")
    # least_percent * positive <= 100 * negative <= 100 * positive, in whole numbers
    low = F.ceil(F.col("high").cast("decimal(38,0)") * least_percent / 100).cast("long")
    windows = anchors.hint("merge").join(positives.withColumn("low", low).where("low <= high"), "anchor")
    found = search(blocks, windows.select("anchor", "label", "q", "tag", "low", "high"), False, k)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("tag").alias("positive_id"), F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("target").alias("positive_score"), F.col("score").alias("negative_score"),
    )
