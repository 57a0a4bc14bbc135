"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes a hashed bag of words, word shapes and repetition marks, weighted by
inverse document frequency over *all* documents.  A truncated singular value
decomposition of a bounded labelled sample gives the latent space.  The labelled
vectors (at most ``2 * per_label`` rows of ``rank`` numbers) are broadcast; every
document is compared with all of them in exact blocked cosine products, and its
nearest neighbours vote with their similarity.

Defined cases: null and empty texts, and texts without words, have no vector and get
the share of label 1 among the labelled rows; repeated rows are scored one by one and
equal texts get equal scores; without any labelled row every score is 0.5; other
columns of the input pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import labelled_rows, mix, slices, text_array, tidy, words_of

BUCKETS = 4096
PER_LABEL = 1500  # the documented bound on labelled rows used for fitting
RANK, NEIGHBOURS, BLOCK = 48, 25, 256
#: Byte classes of a word's shape: upper case, lower case or non-ASCII, digit, else the byte itself.
SHAPE = np.arange(256, dtype=np.uint64)
SHAPE[0x41:0x5B], SHAPE[0x61:0x7B], SHAPE[0x80:], SHAPE[0x30:0x3A] = 0x41, 0x61, 0x61, 0x30


def bags(texts: pa.Array) -> np.ndarray:
    """Count matrix texts x BUCKETS: words in one half, shapes and repetitions in the other."""
    w, half, n = words_of(texts), BUCKETS // 2, len(texts)
    if not len(w.doc):
        return np.zeros((n, BUCKETS), np.float32)
    tail = [SHAPE[w.data[np.maximum(w.stop - k, w.start)]] for k in (1, 2, 3)]
    shape = mix(SHAPE[w.data[w.start]] << np.uint64(24) | tail[0] << np.uint64(16) | tail[1] << np.uint64(8) | tail[2])
    same = np.zeros(len(w.doc), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape[same] = mix(np.uint64(1) + same[same].astype(np.uint64))
    out = np.zeros(n * BUCKETS, np.int64)
    for h, at in ((w.hash, 0), (shape, half)):
        out += np.bincount(w.doc * BUCKETS + at + (h % np.uint64(half)).astype(np.int64), minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS).astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all documents hold each bucket; BUCKETS rows at most reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts = text_array(batch.column(0))
            n += len(texts)
            for lo, hi in slices(texts, rows=BLOCK):
                df += (bags(texts.slice(lo, hi - lo)) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(BUCKETS), -1)), pa.array(np.append(df, n))], ["bucket", "n"])

    sums = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in sums:
        out[r.bucket] = r.n  # -1, the number of documents, comes last
    return out[:-1], int(out[-1])


@dataclass
class Model:
    idf: np.ndarray  # BUCKETS
    axes: np.ndarray  # BUCKETS x rank
    vectors: np.ndarray  # labelled rows x rank, of length 1
    labels: np.ndarray
    prior: float

    def project(self, texts: pa.Array) -> np.ndarray:
        """Unit latent vectors; rows of zeros for texts without words."""
        x = np.log1p(bags(texts)) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        z = x @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def vote(self, texts: pa.Array) -> np.ndarray:
        score = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return score
        z = self.project(texts)
        cosine = z @ self.vectors.T  # every labelled row, exactly
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0) ** 4
        total = weight.sum(axis=1)
        known = (total > 0) & (np.abs(z).sum(axis=1) > 0)
        score[known] = (weight * self.labels[near]).sum(axis=1)[known] / total[known]
        return np.clip(score, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, rank: int = RANK) -> Model:
    """Statistics over all documents, axes and vectors from at most `per_label` rows of each label."""
    df, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    rows = labelled_rows(docs, labels, per_label).orderBy(F.xxhash64("text"), "text", "label").toArrow()
    texts, label = text_array(rows.column("text")), rows.column("label").to_numpy().astype(np.float64)
    if not len(texts):
        return Model(idf, np.zeros((BUCKETS, 1), np.float32), np.zeros((0, 1), np.float32), label, 0.5)
    x = np.concatenate([np.log1p(bags(texts.slice(lo, hi - lo))) * idf for lo, hi in slices(texts, rows=BLOCK)])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    rank = min(rank, *x.shape)
    probe = np.random.default_rng(8).standard_normal((x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32)
    base = np.linalg.qr(x @ probe)[0]
    for _ in range(3):  # subspace iterations of the randomised decomposition
        base = np.linalg.qr(x @ np.linalg.qr(x.T @ base)[0])[0]
    axes = np.linalg.svd(base.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)
    z = x @ axes
    size = np.linalg.norm(z, axis=1, keepdims=True)
    seen = size[:, 0] > 0
    prior = float(label.mean())
    return Model(idf, axes, (z[seen] / size[seen]).astype(np.float32), label[seen], prior)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """All columns of `docs` and the vote for label 1 as `out`."""
    if out in docs.columns:
        raise ValueError(f"column {out!r} is there already; name another")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = text_array(batch.column(at))
            votes = [model.vote(texts.slice(lo, hi - lo)) for lo, hi in slices(texts, rows=BLOCK)]
            votes = np.concatenate(votes) if votes else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(votes, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(out, DoubleType())]))
