"""Cells of common shingles, divided by size, by Voronoi regions and by slices: the same components as brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import jaccard

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)}).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def copies(seed, groups=4, each=45):
    """Groups of near copies with so many edits that some are linked to each other and some are not."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage, rows = [word() for _ in range(40)], []
    for g in range(groups):
        base = [word() for _ in range(r.choice([30, 60, 90]))] + passage * (g % 2)
        for _ in range(each):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w[: len(w) - r.choice([0, 0, 3, 12])])))
    return rows + [(len(rows), None), (len(rows) + 1, "  "), (len(rows) + 2, " ".join(passage)), (len(rows) + 3, "one two"), (len(rows) + 4, "One TWO")]


@pytest.mark.parametrize("cell,pivots,seed", [(512, 8, 1), (12, 3, 2), (6, 2, 3)])
def test_cells_keep_every_link(spark, monkeypatch, cell, pivots, seed):
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "COMMON", 3)
    rows = copies(seed)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit(1)))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_shared_counts():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, k, 60).astype(np.uint64)) for k in (30, 90, 2000) for _ in range(60)]
    counts = jaccard.shared_counts(sets)
    assert all(counts[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i + 1, len(sets)))


def test_another_text_under_one_id_stays(spark):
    r = random.Random(6)
    a, b = (" ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(40)) for _ in range(2))
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (3, b), (4, None), (None, a), (1, a), (5, a + " x"), (5, a + " y")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("mark", F.lit("mine"))
    kept = sorted(((-1 if x.doc_id is None else x.doc_id), x.text or "") for x in jaccard.one_of_each(df).collect())
    assert kept == sorted([(1, a), (2, b), (4, ""), (-1, a)])
