"""Text operators against brute force, with nulls, empty and long texts, copies, clashing columns and empty tables."""

import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfield.llm import bpe, chat, imatch, jaccard, licenses, linededup, mixing, pii, quality, rules
from tallyfield.llm.common import held_out, labelled_rows
from tallyfield.llm.queries import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RND = random.Random(5)
WORDS = ["".join(RND.choice("abcdefgh") for _ in range(RND.randint(1, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


PASSAGE = prose(60, 99)
LONG = prose(4000, 7)
TEXTS = [
    None, "", "   \n\t", "one", "two words", prose(80, 1), prose(80, 1), prose(80, 1) + " tail", LONG, LONG + " x", "1 2 3",
    prose(30, 2) + "\n" + PASSAGE + "\n" + prose(30, 3), prose(20, 4) + "\n" + PASSAGE + "\nend", PASSAGE,
    "Éa mail a.b@mail.example.com or call +1 (407) 555-8973, ip 10.0.0.1 and 300.1.1.1 card 4012 8888 8888 1881 password=abcdef123456",
    "a@b.c_x@d.e +12 4012888888881882 1.2.3.4.5", "This is under the GNU General Public License, MIT license. cc by nc",
    "licensed under the apache license version 2 0 all rights reserved", "日本語 テキスト ١٢٣ 　x's don't 'll", "line\nline\n\nline\nother", "A\nb\nA\nb",
] + [prose(60, 200 + i) for i in range(12)] + ["BAD!! " * 60 + str(i) for i in range(6)]
ROWS = [(i, t, "en", ["b", "a", None, "ä"][i % 4], len(t or "")) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "en", "a", 1), (None, TEXTS[5], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    clash = [F.lit("mine").alias(c) for c in ("score", "size", "rank", "word", "key", "shingle", "marks", "found", "words", "taken", "block", "removed_", "Start")]
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *clash)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(not (t or "").startswith("BAD"))) for i, t in enumerate(TEXTS)] + [(None, 1)], "doc_id long, quality int")


def coder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.load_lines(VOCABULARY)), special_tokens={})


def test_bpe_round_trip(docs, none):
    made = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    assert made.columns == [c for c in docs.columns if c != "text"] + ["ids", "bytes"]
    rows, e = made.select("doc_id", "ids", "bytes").collect(), coder()
    want = sorted(((-1 if i is None else i), tuple(e.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in ROWS)
    assert sorted(((-1 if r.doc_id is None else r.doc_id), tuple(r.ids), bytes(r.bytes)) for r in rows) == want
    assert bpe.encode(none, VOCABULARY, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(docs.limit(1).select(F.array(F.lit(60_000)).alias("ids")), VOCABULARY).collect()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40) | st.text("a'sle \n\t1é!_　", max_size=30))
def test_pre_tokens_are_those_of_the_library(text):
    single = {bytes([i]): i for i in range(256)}
    marks = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.load_lines(VOCABULARY)), special_tokens={})
    pieces = bpe.splitter(public_tokenizers.PATTERN)(text)
    assert "".join(pieces) == text and single
    word = tiktoken.Encoding("w", pat_str=r"(?s).+", mergeable_ranks=marks._mergeable_ranks, special_tokens={})
    assert [i for p in pieces for i in word.encode_ordinary(p)] == marks.encode_ordinary(text)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_packed_numbers(numbers):
    assert bpe.unpack(bpe.pack(np.array(numbers, np.int64))).tolist() == numbers


def brute_base(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, m):
        d = [int(c) for c in m if c in "0123456789"]
        twice = [x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))]
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 16 <= len(d) <= 19 and sum(twice) % 10 == 0, "phone": 8 <= len(d) <= 15}[kind]

    return [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text) if ok(k, m[0])]


def test_pii_base_and_method(spark, docs, none):
    rows = pii.find(docs).collect()
    assert len(rows) == len(ROWS) and pii.find(none).count() == 0
    text = {i: t or "" for i, t, *_ in ROWS}
    for r in rows:
        if r.doc_id is not None:
            assert [tuple(s) for s in r.base] == brute_base(text[r.doc_id])
            assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}
    nasty = ["1 " * 3000, "1.2.3.4." * 2000, "a@b.c." * 2000, "+1 2 3 4 5 6 7 8" * 300, "a." * 5000 + "@x.y", "00010.0.0.00255 999.1.1.1", "+1234567 +12345678 +1234567890123456"]
    got = pii.find(spark.createDataFrame(list(enumerate(nasty)), "doc_id long, text string")).collect()
    for r in got:
        assert [tuple(s) for s in r.base] == brute_base(nasty[r.doc_id])


def test_dotted_phones_need_no_hyphen(spark):
    texts = ["call 407.555.8973 now", "call (407) 555.8973 now", "call 407.555.8973 now - or", "call 1407.555.8973", "call 407-555-8973"]
    got = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id: [(s.start, s.stop) for s in r.found if s.kind == "local_phone"] for r in got}
    assert found == {i: [m.span() for m in re.finditer(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])", t)] for i, t in enumerate(texts)}
    assert found[0] == [(5, 17)] and found[1] == [(5, 19)]


def test_reliabilities_tell_good_labelers_from_bad():
    rnd = np.random.default_rng(1)
    truth = rnd.random(4000) < 0.4
    votes = np.stack([np.where(rnd.random(4000) < (0.95 if i < 4 else 0.5), truth, ~truth) for i in range(5)], axis=1)
    pattern, count = np.unique(votes @ (1 << np.arange(5)), return_counts=True)
    real, rates = pii.reliabilities(pattern, count.astype(float))
    assert all(rates[i, 0] > 0.9 and rates[i, 1] < 0.1 for i in range(4)) and abs(rates[4, 0] - rates[4, 1]) < 0.1
    bits = np.concatenate([(pattern[:, None] >> np.arange(5)) & 1, np.ones((len(pattern), 1))], axis=1)
    w = pii.train(bits.astype(float), real, count.astype(float))
    assert min(w[:4]) > abs(w[4])


def test_mix_meets_targets_and_caps(docs, none):
    rows, parts, plan = mixing.mix(docs)
    got = mixing.taken(rows, parts, plan).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, _, s, _ in ROWS:
        sizes[s] = sizes.get(s, 0) + size(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    assert sum(want) == pytest.approx(1.5 * sum(sizes.values())) and all(t <= 2 * sizes[s] + 1e-9 for s, t in zip(names, want))
    taken, target = {}, {}
    for r in got:
        taken[r.target] = taken.get(r.target, 0) + r.taken
    for t, n in taken.items():
        assert abs(n - sum(w for w in want if w == pytest.approx(t))) <= 1 * len(names), target
    again = mixing.taken(*mixing.mix(docs)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key)
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns and sum(size(r.text) for r in texts.collect()) == sum(r.taken for r in got)
    assert mixing.taken(*mixing.mix(none)).count() == 0 and mixing.mixed_texts(none).count() == 0


@given(st.integers(1, 3000), st.integers(0, 50))
def test_feistel_is_a_permutation(n, key):
    x = np.arange(n)
    y = mixing.feistel(x, n, key)
    assert sorted(y.tolist()) == x.tolist() and (mixing.feistel(y, n, key, back=True) == x).all()


def test_splitting_tree_is_exact():
    plan = mixing.Plan(["a", "b", "c"], [700_000, 90_000, 5_000], [500_000.0, 170_000.0, 9_999.0], 1024, 3)
    seen = {}
    for shard, first, count in plan.quotas(list(range(plan.shards))):
        assert count.sum() == plan.before(shard + 1) - plan.before(shard)
        made = plan.drawn(shard, first, count)
        for s, t, b in zip(made["s"], made["turn"], made["block"]):
            assert (s, t, b) not in seen
            seen[s, t, b] = 1
    assert len(seen) == plan.total
    one = [(shard, first.tolist(), count.tolist()) for shard, first, count in plan.quotas([plan.shards - 1])]
    assert one == [(s, f.tolist(), c.tolist()) for s, f, c in plan.quotas(list(range(plan.shards))) if s == plan.shards - 1]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(range(len(sets)), 2):
        a, b = sets[x][1], sets[y][1]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            root[find(x)] = find(y)
    groups = {}
    for x, (i, s) in enumerate(sets):
        groups.setdefault(find(x), []).append(i)
    out = []
    for x, (i, s) in enumerate(sets):
        ids = [j for j in groups[find(x)] if j is not None]
        out.append((i, len(s), i if not s else min(ids, default=None)))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def test_jaccard_components(spark, docs, none):
    assert order(jaccard.near_duplicates(docs).collect()) == order(brute_components([(i, t) for i, t, *_ in ROWS]))
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.one_of_each(docs).where("doc_id is not null").select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({c for i, n, c in brute_components([(i, t) for i, t, *_ in ROWS]) if i is not None and n} | {i for i, t, *_ in ROWS if i is not None and not shingles(t)})


def near_copies(count, words, edits, seed):
    r = random.Random(seed)
    base = prose(words, seed).split()
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(WORDS) + str(r.random())
        out.append(" ".join(w))
    return out


def test_jaccard_hot_families_and_passages(spark):
    """Many near copies around the threshold, unrelated texts with one passage, families that share half."""
    texts = near_copies(70, 60, 5, 1) + near_copies(60, 120, 9, 2) + [prose(20, 500 + i) + " " + PASSAGE for i in range(60)]
    half = prose(50, 77)
    texts += [half + " " + t for t in near_copies(40, 50, 8, 3)]
    rows = list(enumerate(texts))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert order(got) == order(brute_components(rows))


def test_signature_and_windows_hold_the_bound():
    rnd = np.random.default_rng(4)
    for _ in range(300):
        n = int(rnd.integers(1, 200))
        a = np.unique(rnd.integers(0, 1 << 60, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) > rnd.random() * 0.3], rnd.integers(0, 1 << 60, int(rnd.integers(0, 30))).astype(np.uint64)]))
        i, n1, n2 = len(np.intersect1d(a, b)), len(a), len(b)
        if len(b) and 100 * i >= 75 * (n1 + n2 - i):
            k1, k2 = jaccard.prefix_size(n1), jaccard.prefix_size(n2)
            votes = len(np.intersect1d(a[:k1], b[:k2]))
            assert votes >= 1 and votes >= jaccard.shared_at_least(n1, n2) - max(n1 - k1, n2 - k2)


def test_fingerprints(spark, docs, none):
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = imatch.lexicon(texts, 0.05, 0.9)
    df = {}
    for _, t, *_ in ROWS:
        for w in set(re.split(r"[\x20\x09-\x0D]+", t or "")) - {""}:
            df[w] = df.get(w, 0) + 1
    assert known == sorted(w for w, n in df.items() if 0.05 * len(ROWS) <= n <= 0.9 * len(ROWS))
    rows = imatch.fingerprint(texts, known).collect()
    by = {}
    for r in rows:
        assert by.setdefault(r.text, r.fingerprint) == r.fingerprint and len(r.fingerprint) == imatch.SUBSETS
    r = next(x for x in rows if x.text == TEXTS[5])
    found = sorted(hashlib.md5(w.encode()).hexdigest() + w for w in set(TEXTS[5].split()) & set(known))
    found.sort(key=lambda h: h[32:])
    assert r.fingerprint[3] == hashlib.md5(" ".join(h for h in found if h[3] in "01").encode()).hexdigest()[:8]
    marked = imatch.with_next(texts.where("doc_id is not null"), "doc_id", "text", 5, lambda d: imatch.fingerprint(d, known, out="marks"))
    pairs = sorted(((i, t or "") for i, t, *_ in ROWS if i is not None))
    follow = {p: q[1] for p, q in zip(pairs, pairs[1:] + pairs[:1])}
    got = [(r.doc_id, r.text, r.next.text) for r in marked.collect()]
    assert len(got) == len(pairs) and all(n == follow[i, t] or (i, t) == (5, TEXTS[5]) for i, t, n in got)
    assert imatch.lexicon(none.select("doc_id", "text")) == []


def test_chat_repair_is_cheapest(spark):
    r = random.Random(3)
    rows = [(c if c else None, t if r.random() < 0.97 else None, r.choice(["system", "user", "assistant", "GPT", "tool", None]), r.choice(["hi", None, "<|x", ""])) for c in range(25) for t in range(r.choice([1, 2, 3, 8, 900]))]
    out = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()

    def best(roles):
        costs = {chat.START: 0}
        for role in roles:
            role = chat.ALIASES.get((role or "").strip().lower(), (role or "").strip().lower())
            n = chat.ROLES.index(role) + 1 if role in chat.ROLES else chat.START
            costs = {q: min(c + chat.STEPS[s][q][0] + chat.RELABEL * (q != n) for s, c in costs.items()) for q in (1, 2, 3)}
        return min(c + int(chat.FINAL[s]) for s, c in costs.items())

    for c in {r[0] for r in rows}:
        parts = sorted((x for x in out if x.conv_id == c), key=lambda x: x.segment)
        mine = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        text = "".join(x.rendered for x in parts)
        roles = re.findall(r"<\|(system|user|assistant)\|>", text)
        turns = roles[roles[0] == "system" :]
        assert sum(x.cost for x in parts) == best([x[2] for x in mine])
        assert turns and all(x == ("user", "assistant")[i % 2] for i, x in enumerate(turns)) and text.count("<|end|>") == len(roles)
    assert chat.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("shape", ["no id", "no turn", "one turn", "equal rows"])
def test_chat_segments_are_bounded(spark, shape):
    r = random.Random(8)
    make = {"no id": lambda i: (None, i % 256, r.choice(chat.ROLES), f"t{i}"), "no turn": lambda i: (1, None, r.choice(chat.ROLES), f"t{i}"), "one turn": lambda i: (1, 7, "user", f"t{i}"), "equal rows": lambda i: (1, 7, "user", "t")}[shape]
    rows = [make(i) for i in range(2000)] + [(2, 0, "user", "a"), (2, 1, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    sizes = chat.numbered(turns).groupBy("conv_id", "segment").agg(F.sum("copies").alias("n")).collect()
    assert max(x.n for x in sizes) <= chat.SEGMENT and sum(x.n for x in sizes) == len(rows)
    out = sorted((x for x in chat.repaired(turns).collect() if x.conv_id != 2), key=lambda x: x.segment)
    assert [x.segment for x in out] == list(range(8)) and [x.n_turns for x in out] == [256] * 7 + [208]
    mine = sorted(rows[:2000], key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
    assert re.findall(r"^t\d*(?=$|<)", "".join(x.rendered for x in out), re.M) == [x[3] for x in mine]


def test_chat_levels(spark, monkeypatch):
    rows = [(1, t, random.Random(t).choice(chat.ROLES), "x") for t in range(chat.SEGMENT * 13)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    flat = sorted(map(tuple, chat.repaired(turns).collect()))
    monkeypatch.setattr(chat, "LEVEL", 3)
    assert sorted(map(tuple, chat.repaired(turns).collect())) == flat


def test_license_places(docs, none):
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(ROWS) and licenses.scan(none).count() == 0
    text = {i: t or "" for i, t, *_ in ROWS}
    for r in rows:
        if r.doc_id is None:
            continue
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text[r.doc_id]))
        places = sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert (r.n_words, list(r.places), list(r.base_labels)) == (len(w), [i for i, _ in places], sorted({x for _, x in places}))
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
    assert {"cc-by-nc", "gpl", "mit"} <= set(next(r for r in rows if r.doc_id == 16).labels)
    assert "all-rights-reserved" in next(r for r in rows if r.doc_id == 17).labels


def test_diagonals_with_a_missing_word_are_merged(spark):
    text = "permission is hereby granted free of any charge to any person obtaining a copy of this software"
    r = licenses.scan(spark.createDataFrame([(1, "x y " + text)], "doc_id long, text string")).first()
    assert list(r.labels) == ["mit"] and r.n_words == 19 and list(r.places) == []


def test_quality_votes(spark, docs, none, labels):
    model = quality.fit(docs, labels)
    out = quality.score(docs, model, "vote")
    assert out.columns == [*docs.columns, "vote"]
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.vote <= 1 for r in rows)
    assert all((r.vote < 0.3) == (r.text or "").startswith("BAD") for r in rows if len((r.text or "").split()) > 20)
    z = model.project(quality.text_array(__import__("pyarrow").array([TEXTS[5]])))
    cosine = (z @ model.vectors.T)[0]
    near = np.argsort(-cosine)[: quality.NEIGHBOURS]
    weight = np.maximum(cosine[near], 0) ** 4
    assert next(r.vote for r in rows if r.doc_id == 5) == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=1e-5)
    assert quality.score(none, model, "vote").count() == 0
    blank = quality.fit(none, labels.limit(0))
    assert {r.vote for r in quality.score(docs, blank, "vote").collect()} == {0.5}


def test_rule_counts_and_verdicts(docs, none, labels):
    found = rules.fit(docs, labels)
    plain = docs.drop("score")
    rows = rules.verdicts(plain, found).collect()
    assert len(rows) == len(ROWS) and rules.verdicts(plain.limit(0), rules.fit(none, labels.limit(0))).count() == 0
    for r in rows:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 500 else None
        lines = [x for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        if hit is not None:
            assert r.n_repeat_words == len(hit)
        assert r.base_failed == (len(w) < 50 or 100 * r.n_repeat_words > 50 * len(w)) and not (r.kept and r.base_failed)


def brute_lines(rows):
    def chunks(text):
        lines = text.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        long = [len(x.split(" ")) >= linededup.LONG_WORDS for x in lines]
        at = [i for i in range(len(lines)) if i == 0 or (h[i - 1] * 31 + h[i]) % linededup.MODULUS == 0 or long[i - 1] or long[i]]
        return [("\n".join(lines[a:b]), b - a > 1 or long[a]) for a, b in zip(at, at[1:] + [len(lines)])]

    seen, out = {}, {}
    for i, t in sorted({(i, t) for i, t in rows if t is not None and i is not None}, key=lambda r: r[0]):
        kept = []
        for p, (c, whole) in enumerate(chunks(t)):
            first = seen.setdefault(c, (i, t, p)) if whole and c.strip(" \t\n\r") else None
            if first in (None, (i, t, p)):
                kept.append(c)
        out[i, t] = "\n".join(kept)
    return out


def test_line_chunks(spark, none):
    r = random.Random(8)
    pool = [prose(r.choice([2, 8, 60]), 900 + i) for i in range(12)]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 14)))) for i in range(60)] + [(100 + i, t) for i, t in enumerate(TEXTS) if t is not None]
    df = spark.createDataFrame(rows + [rows[3], (999, None)], "doc_id long, text string").withColumn("removed_", F.lit(1)).withColumn("key", F.lit("k"))
    got = linededup.dedup_lines(df).collect()
    want = brute_lines(rows)
    text = dict(rows)
    assert len(got) == len(rows) + 2 and all(x.text == (None if x.doc_id == 999 else want[x.doc_id, text[x.doc_id]]) for x in got)
    assert linededup.dedup_lines(none).count() == 0


def brute_passages(rows, words=50):
    """Line numbers that go: those of later chunks, and of every run of `words` words that begins earlier in the corpus."""
    first, gone = {}, {}
    ordered = sorted(((i, t) for i, t in rows if t is not None), key=lambda x: x[0])
    for i, t in ordered:
        lines, gone[i] = t.split("\n"), set()
        counts = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if counts[a] and counts[b - 1] and sum(counts[a:b]) >= words:
                    at = first.setdefault("\n".join(lines[a:b]), (i, a))
                    if at[0] != i or a >= at[1] + b - a:
                        gone[i].update(range(a, b))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in ordered}


def test_line_passages(spark, none):
    r = random.Random(17)
    rows = []
    for k in range(60):  # planted passages of lines of 3 to 30 words, each in two different surroundings
        sizes = [r.randint(3, 30) for _ in range(r.randint(2, 9))]
        passage = "\n".join(r.choice(["", "", " \t", "\n"]) + prose(n, 5000 + 100 * k + j) for j, n in enumerate(sizes))
        rows += [(10 * k + j, prose(12, 90000 + 10 * k + j) + "\n" + passage + "\n" + prose(7, 95000 + 10 * k + j)) for j in (0, 1)]
        rows.append((10 * k + 2, passage))
    rows += [(901, "\n".join(["same line here"] * 100)), (902, None), (903, ""), (904, "é\U0001f600 " * 60 + "\n"), (905, "x\n" + "é\U0001f600 " * 60 + "\ny"), (906, "\n".join(["same line here"] * 20))]
    got = {x.doc_id: x for x in linededup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want, lines = brute_passages(rows), {x.doc_id: x.text for x in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    held = lambda text, other: any(x in other.split("\n") for x in text.split("\n") if x.strip())
    short = 0
    for i, t in rows:
        if t is None:
            assert got[i].text is None
            continue
        kept, both = got[i].text.split("\n"), want[i].split("\n")
        assert set(kept) <= set(both) | {""} and got[i].removed == len(t.split("\n")) - (len(kept) if got[i].text or got[i].removed < len(t.split("\n")) else 0)
        if i % 10 in (1, 2) and i < 900 and len(t.split()) - (19 if i % 10 == 1 else 0) >= 50:
            passage = dict(rows)[i // 10 * 10 + 2]
            assert not held(passage, got[i].text)  # all of every planted passage is gone
            short += held(passage, lines[i])
    assert short  # what chunks alone leave
    assert got[901].text.count("same") < 100 and got[906].text == "" and got[905].text == "x\ny" and got[904].removed == 0
    assert all(got[10 * k].removed == 0 for k in range(60))
    assert linededup.dedup_passages(none).count() == 0


def test_threshold_is_exact_over_all_rows(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 2, 3000)
    ratio = np.round(rng.normal(label * 0.5, 1.0), 2)
    df = spark.createDataFrame([(int(x), float(y)) for x, y in zip(label, ratio)], "label int, ratio double")
    good, bad = ratio[label == 1], ratio[label == 0]
    cuts = np.unique(ratio)
    cut = np.concatenate([[cuts[0] - 1e-6], 0.7 * cuts[:-1] + 0.3 * cuts[1:]])
    gain = np.array([int((bad < c).sum()) * len(good) - int((good < c).sum()) * len(bad) for c in cut])
    width = np.concatenate([[0], np.diff(cuts)])
    want = max(zip(gain, width, -cut))
    for slice_rows in (50_000, 20):
        assert rules.best_threshold(df, slice_rows) == pytest.approx(-want[2], abs=1e-12)
    only = rules.best_threshold(df.where("label = 1"))
    assert only < good.min() and rules.best_threshold(df.where("label = 0")) == -np.inf


def test_rules_learn_from_every_labelled_row(spark):
    """Beyond 4,000 rows of a label, too: each of them carries a word of its own."""
    n = 4300
    docs = spark.range(n * 5 // 4 + 60).select(F.col("id").alias("doc_id"), F.format_string("own%d w%d common words", F.col("id"), F.col("id") % 7).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    used = labels.where(~held_out("doc_id")).count()
    assert used > 4000
    known = labelled_rows(docs, labels)
    assert known.count() == used
    target = rules.gram_counts(known, 64)
    found = rules.fit(docs, labels, buckets=64)
    assert target.sum() == used * 7 and np.allclose(found.weight, rules.log_ratio(target, rules.gram_counts(docs, 64), 1.0))
