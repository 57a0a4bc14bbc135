"""The five stages of the corpus pipeline on a small corpus with nulls, empty and repeated rows, clashing columns and an empty table."""

import collections
import random

import corpus_pipeline as cp
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_jaccard_cells import brute

from tallyfield.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(12)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    good = [prose(r.randint(60, 120)) for _ in range(60)]
    bad = [" ".join(["BUY", "NOW!!", "$$$"][r.randrange(3)] for _ in range(40)) + f" {i}" for i in range(30)]
    passage = prose(70)
    texts = good + bad + [good[0], good[1] + " one more", prose(30) + "\n" + passage + "\n" + prose(40), prose(35) + "\n" + passage + "\n" + prose(20), None, "", "  \n", "short"]
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    return rows + [(3, good[3], "en", "a", 1), (3, prose(80), "en", "a", 1), (None, prose(50), None, "b", None)], len(good), len(bad), passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, good, bad, _ = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine")).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < good), 0) for i in range(good + bad)] + [(None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def key(rows):
    return collections.Counter((r.doc_id, r.text) for r in rows)


def test_stages_one_by_one(spark, folder):
    rows, good, bad, passage = corpus()
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing to target weights", "byte-level BPE"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = cp.stored(cp.good_quality(spark, docs, folder))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert set(range(good)) <= ids and not ids & set(range(good, good + bad))
    clean = cp.stored(cp.without_repeated_chunks(spark, kept, folder))
    texts = [r.text for r in clean.collect()]
    assert sum(passage in (t or "") for t in texts) == 1 and clean.columns == docs.columns
    single = cp.stored(cp.without_near_duplicates(spark, clean, folder))
    before, after = clean.where("doc_id is not null").collect(), single.collect()
    named = [(2 * i, r.text) for i, r in enumerate(before)]  # brute force tells rows of one id apart
    groups = collections.defaultdict(list)
    for (i, n, c), r in zip(brute(named), before):
        groups[c if n else ("own", i)].append(r)
    want = collections.Counter(min(g, key=lambda r: r.doc_id).doc_id for g in groups.values())
    found = collections.Counter(r.doc_id for r in after if r.doc_id is not None)
    assert set(want) == set(found) and sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in clean.collect())
    assert set(key(after)) <= set(key(clean.collect()))
    mixed = cp.stored(cp.mixed(spark, single, folder))
    size = lambda t: len((t or "").split())
    had, has = collections.Counter(), collections.Counter()
    for r in after:
        had[r.source] += size(r.text)
    for r in mixed.collect():
        has[r.source] += size(r.text)
    assert mixed.columns == docs.columns and abs(sum(has.values()) - 1.5 * sum(had.values())) <= 3 and all(has[s] <= 2 * had[s] + 1 for s in had)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.load_lines(cp.VOCABULARY)), special_tokens={})
    ids = collections.Counter((r.doc_id, tuple(r.ids)) for r in cp.tokens(spark, mixed, folder).collect())
    assert ids == collections.Counter((r.doc_id, tuple(coder.encode_ordinary(r.text or ""))) for r in mixed.collect())


def test_run_and_empty_tables(spark, folder, tmp_path):
    out = cp.run(spark, folder)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"] and out.count() > 40
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
