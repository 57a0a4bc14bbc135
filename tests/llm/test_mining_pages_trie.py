"""Hard negatives, page text and the conversation trie against brute force, with nulls, ties, repeated rows and empty tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfield.llm import negatives, pages, trie

INF = float("inf")


def brute_negatives(rows, k=5):
    own = {}
    for i, e, l in rows:
        if i is None or l is None or e is None or any(x is None or math.isnan(x) or math.isinf(x) for x in e):
            continue
        row = ((l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * x) for x in e])
        own[i] = min(own.get(i, row), row)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (l, q) in own.items():
        if a % 100:
            continue
        rank = lambda items: sorted(items, key=lambda x: (-x[0], x[1]))
        scored = [(dot(q, p), i, m) for i, (m, p) in own.items() if i != a]
        for ps, pos, _ in rank(x for x in scored if x[2] == l)[:k]:
            fit = rank(x for x in scored if x[2] != l and 80 * ps <= 100 * x[0] <= 100 * ps)[:k]
            out += [(a, pos, r + 1, i, ps, s) for r, (s, i, _) in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dims, wide):
    r = random.Random(seed)
    out = [(i, [r.choice((-1, 1)) * r.randint(0, wide) / 256 + 0.001 for _ in range(dims)], r.randint(0, 3)) for i in range(n)]
    out += [(100, [0.0] * dims, 1), (200, None, 1), (7, [None] * dims, 2), (8, [math.nan] * dims, 2), (9, [INF] * dims, 1), (10, [0.5], None), (None, [0.5] * dims, 1), (300, [0.25], 2), (11, [], 1), (3, out[3][1], out[3][2])]
    return out


def mined(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("mine")).withColumn("q", F.lit(1)).withColumn("block", F.lit(0))
    return sorted(tuple(r) for r in negatives.hard_negatives(df).collect())


@pytest.mark.parametrize("seed,wide,block", [(1, 200, 8192), (2, 2, 64), (3, 50, 17)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, wide, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    rows = vectors(seed, 520, 12, wide)
    single = [(i, e if e is None else [None if x is None else float(np.float32(x)) for x in e], l) for i, e, l in rows]
    found = mined(spark, rows)
    assert found == brute_negatives(single) and len(found) > 20


def test_hard_negatives_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 17)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.uniform(-1, 1))) for _ in range(16)], r.randint(0, 3)) for i in range(2500)]
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1k")  # any broadcast is larger
    try:
        found = mined(spark, rows)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert found == brute_negatives(rows) and len(found) > 20


def test_hard_negatives_keep_few_blocks_in_a_file(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 17)
    kept, stored = {}, negatives.stored
    monkeypatch.setattr(negatives, "stored", lambda df, label, **options: kept.setdefault(label, stored(df, label, **options)))
    rows = [r for r in vectors(6, 520, 4, 50) if r[0] is not None]
    assert mined(spark, rows)
    files = kept["sorted-lists"].groupBy(F.input_file_name()).agg(F.count("*").alias("blocks")).collect()
    assert sum(f.blocks for f in files) >= 30 and max(f.blocks for f in files) <= 4


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == []
    with pytest.raises(Exception, match="63 bits"):
        mined(spark, [(0, [1e9, 1e9], 1), (1, [1e9, 1e9], 1)])


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 6), st.sampled_from([1, 5, 300]))
def test_threshold_search_stops_without_loss(seed, n, dims, wide):
    r = np.random.default_rng(seed)
    q = r.integers(-wide, wide + 1, (n, dims)).astype(np.float64)
    anchor = r.integers(-wide, wide + 1, dims).astype(np.float64)
    allowed = r.random(n) < 0.7
    low = r.integers(-3 * wide, 3 * wide, 3).astype(np.int64) * wide // 2
    high = low + r.integers(0, 4 * wide, 3) * wide
    lists = np.argsort(q, axis=0, kind="stable").T.astype(np.uint16)
    for (rows, scores), lo, hi in zip(negatives.threshold_search(q, lists, allowed, anchor, low, high), low, high):
        full = q @ anchor
        want = sorted((-full[i], i) for i in np.flatnonzero(allowed & (full >= lo) & (full <= hi)))[:5]
        assert sorted((-s, i) for s, i in zip(scores, rows))[:5] == want


ARTICLE = "<h1>Title &amp; more</h1><p>First <b>bold</b>para, with <a href='/x'>a link</a>.<br>Next line<p>Second paragraph that is long enough to count as text. It goes on and on &lt;here&gt;."
TEXT = "Title & more First boldpara, with a link. Next line Second paragraph that is long enough to count as text. It goes on and on <here>."
MENU = "<nav><ul>" + "<li><a href='/a'>Menu entry</a></li>" * 5 + "</ul></nav>"
PAGES = {
    "plain": (f"<html><head><title>No</title><script>var t='</p>';</script></head><body>{MENU}<article>{ARTICLE}</article><footer>&copy; x</footer></body></html>", TEXT),
    "cut": (f"<body>{MENU}<article>{ARTICLE}</article><footer>&copy; ex", TEXT),
    "main": (f"<body><header><h2>Site</h2></header><main><div class='cookie-notice'>We use cookies on this page, please agree with it now.</div>{ARTICLE}<aside>See also</aside></main><div>Elsewhere</div>", TEXT),
    "divs": (f"<body><div id='topMenu'><p>Home of all pages</div><div class='has-sidebar post'>{ARTICLE}</div><div class='sidebar-left'><p>{'Other words here. ' * 20}</p></div><div class='comments'><p>{'I agree with it. ' * 20}</p></div><div>© 2020 someone</div>", TEXT),
    "box": (f"<article>{ARTICLE}</p><div class=ad>Buy!</div><form><p>Subscribe<input></form><div class='related'><ul><li>One<li>Two<li>Three<li>Four</ul></div><p>The end.</p></article>", TEXT + " The end."),
    "comment": (f"<article>{ARTICLE}<section id=comments><article class=comment><p>First!</p></article></section></article>", TEXT),
    "hidden": (f"<article>{ARTICLE}<p style='display:none'>secret</p><p hidden>x</p><!-- <p>no</p> --></article>", TEXT),
    "quotes": (f"<article><p title='a > b'>one</p><p title=\"x>y\">two 1 < 2</p><a \">three</a><p>four</article>", "one two 1 < 2 four"),
    "links": (MENU, ""),
    "short": ("<article><h1>A</h1></article>", "A"),
    "empty": ("", ""),
    "null": (None, ""),
    "text": ("no markup at all, but it is a text of more than eighty characters, so that it surges above the height.", "no markup at all, but it is a text of more than eighty characters, so that it surges above the height."),
    "open": ("<article><p>kept</p><!-- never ends <p>lost</p>", "kept"),
    "long": ("<article>" + "<p>word</p>" * 30_000 + "</article>", " ".join(["word"] * 30_000)),
    "nasty": ("<a \"" * 20_000, ""),
}


def test_pages(spark):
    rows = [(i, name, page) for i, (name, (page, _)) in enumerate(PAGES.items())] + [(None, None, "<article>x</article>"), (3, "divs", PAGES["divs"][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("weight", F.lit(1)).withColumn("n_chars", F.lit("old"))
    got = pages.extract(df)
    assert got.columns == ["page_id", "url", "weight", "text", "n_chars"]
    want = sorted((u or "", PAGES[u][1] if u else "x") for _, u, _ in rows)
    found = got.collect()
    assert sorted((r.url or "", r.text) for r in found) == want and all(r.n_chars == len(r.text) for r in found)
    assert pages.extract(df.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/a p\"'=!-&;b", max_size=60))
def test_any_page_ends(page):
    assert isinstance(pages.main_text(pages.lines_of(page)), str)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc .", min_size=1, max_size=30).filter(lambda t: t.strip()), min_size=1, max_size=12))
def test_all_blocks_of_an_article_are_kept(blocks):
    page = f"<body>{MENU}<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article><footer>f</footer>"
    assert pages.main_text(pages.lines_of(page)) == " ".join(" ".join(b.split()) for b in blocks)


def brute_trie(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    member = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            member.setdefault(seq[:d], []).append(c)
    names = {p: (min(m), len(p)) for p, m in member.items()}
    kids, leaves, saved = dict.fromkeys(member, 0), dict.fromkeys(member, 0), dict.fromkeys(member, 0)
    for p in sorted(member, key=len, reverse=True):
        leaves[p] += not kids[p]
        saved[p] += (len(member[p]) - 1) * (len(p[-1][1].split()) if p else 0)
        if p:
            kids[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    end = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(member[p]) if len(built[c]) == len(p)).encode()).hexdigest()
    return sorted((*names[p], names[p[:-1]][0] if p else -1, len(m), kids[p], leaves[p], saved[p], end(p)) for p, m in member.items())


def dialogues(seed):
    r = random.Random(seed)
    rows = []
    for c in range(90):
        if r.random() < 0.15 or c == 20:
            continue
        rows += [(c, t, r.choice(["user", "assistant", None]), r.choice(["hi", "hello there", "a b c", None, ""])) for t in range(r.choice([1, 2, 3, 5, 9, 14]))]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(11)]  # copies
    rows += [(200, t, "user", f"long {t % 7}") for t in range(61)] + [(201, t, "user", f"long {t % 7}") for t in range(40)]
    rows += [(205, None, "user", "x"), (205, None, None, None), (205, 1, "user", "x"), (205, 1, "user", "x"), (None, 1, "user", "x"), (40, 0, "user", "only one turn")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece,shards,length", [(4096, 8192, 64), (4, 3, 64), (5, 8192, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, piece, shards, length):
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie, "SHARDS", shards)
    monkeypatch.setattr(trie, "SPLITTER_TURNS", length)
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = dialogues(piece)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit("mine")).withColumn("n", F.lit(None).cast("long"))
    got = sorted(tuple(-1 if x is None else x for x in r) for r in trie.nodes(df).collect())
    assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.nodes(df).count() == 0
    one = spark.createDataFrame([(21, 0, "user", "a b")], "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r)[:2] for r in trie.nodes(one).collect()) == sorted(x[:2] for x in brute_trie([(21, 0, "user", "a b")]))
