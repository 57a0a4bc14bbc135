"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, imatch, jaccard, licenses, linededup, mixing, negatives, pages, pii, quality, rules, trie
from .common import held_out, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


@query("op1_byte_pair_coding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def listed(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op2_supervised_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", is_kind(k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def is_kind(kind: str):
    return lambda s: s["kind"] == kind


@query("op3_source_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(*mixing.mix(table(spark, sf_dir, "documents")))


@query("op4_jaccard_join", """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 75 * (a.n + b.n - i)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (
  WITH RECURSIVE t(doc_id, root) AS (
    SELECT x, x FROM e UNION SELECT e.y, t.root FROM t JOIN e ON e.x = t.doc_id)
  SELECT doc_id, min(root) AS root FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_chat_repair")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repaired(table(spark, sf_dir, "conversations"))


@query("op7_license_diagonals")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query("op8_neighbour_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op9_ratio_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    judged = rules.verdicts(docs, rules.fit(docs, labels))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "ratio")


LINES = """
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
h AS (
  SELECT doc_id, text, lines, list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h,
    list_transform(lines, lambda x: len(string_split(x, ' ')) >= 50) AS g FROM l),
a AS (
  SELECT doc_id, text, lines, g, list_filter(range(1, len(lines) + 1), lambda i: i = 1 OR (h[i - 1] * 31 + h[i]) % 3 = 0 OR g[i - 1] OR g[i]) AS a FROM h),
c AS (
  SELECT doc_id, k - 1 AS pos, array_to_string(lines[a[k]:coalesce(a[k + 1], len(lines) + 1) - 1], chr(10)) AS chunk,
    coalesce(a[k + 1], len(lines) + 1) - a[k] > 1 OR g[a[k]] AS whole
  FROM a, unnest(range(1, len(a) + 1)) AS u(k)),
w AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) AS nth FROM c
  WHERE whole AND length(trim(translate(chunk, chr(10) || chr(9) || chr(13), '   '))) > 0),
d AS (SELECT doc_id, pos FROM w WHERE nth > 1),
r AS (
  SELECT c.doc_id, string_agg(CASE WHEN d.pos IS NULL THEN chunk END, chr(10) ORDER BY c.pos) AS text, count(d.pos) AS removed
  FROM c LEFT JOIN d ON c.doc_id = d.doc_id AND c.pos = d.pos GROUP BY c.doc_id)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text, coalesce(r.removed, 0) AS removed
FROM documents o LEFT JOIN r ON o.doc_id = r.doc_id"""


@query("op10_line_chunks", LINES)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


@query("op10_line_passages")
def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_passages(docs)


IMATCH = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT *, length(text) AS n, coalesce(lead(text) OVER (ORDER BY doc_id, text), first_value(text) OVER (ORDER BY doc_id, text)) AS nx FROM d),
e AS (SELECT doc_id, text, n, nx, substr(text, 1, n - n // 2) || substr(nx, 1, n // 2) AS ed FROM t),
f AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+')) AS w FROM d) GROUP BY w),
x AS (SELECT list(w) AS ws FROM f WHERE w <> '' AND df BETWEEN 0.005 * (SELECT count(*) FROM d) AND 0.2 * (SELECT count(*) FROM d)),
k AS (SELECT text, list_transform(list_sort(list_intersect(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), coalesce(ws, []))), lambda w: md5(w) || w) AS found
  FROM (SELECT text FROM e UNION SELECT nx FROM e UNION SELECT ed FROM e) u, x),
g AS (SELECT text, CASE WHEN len(found) > 0
    THEN list_transform(range(1, 33), lambda i: substr(md5(coalesce(array_to_string(list_filter(found, lambda w: substr(w, i, 1) IN ('0', '1')), ' '), '')), 1, 8))
    ELSE list_transform(range(1, 33), lambda i: substr(md5(i::VARCHAR || md5('text ' || text)), 1, 8)) END AS fp FROM k),
j AS (SELECT e.*, a.fp AS a, b.fp AS b, c.fp AS c FROM e JOIN g a ON a.text = e.text JOIN g b ON b.text = e.ed JOIN g c ON c.text = e.nx)
SELECT doc_id, n AS n_chars, sha256(ed) AS edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  CASE WHEN a = b THEN 1.0 ELSE len(list_filter(range(1, 33), lambda i: a[i] = b[i] AND a[i] <> 'd41d8cd9'))::DOUBLE / len(list_filter(range(1, 33), lambda i: a[i] <> 'd41d8cd9' OR b[i] <> 'd41d8cd9')) END AS near_edited,
  CASE WHEN a = c THEN 1.0 ELSE len(list_filter(range(1, 33), lambda i: a[i] = c[i] AND a[i] <> 'd41d8cd9'))::DOUBLE / len(list_filter(range(1, 33), lambda i: a[i] <> 'd41d8cd9' OR c[i] <> 'd41d8cd9')) END AS near_next
FROM j"""


@query("op5_lexicon_fingerprints", IMATCH)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = imatch.lexicon(texts)
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = imatch.with_next(texts, "doc_id", "text", ranges, lambda rows: imatch.fingerprint(rows, known, out="marks"))
    changed = both.withColumn("changed", imatch.edited(F.col("text"), F.col("next.text")))
    full = imatch.fingerprint(changed, known, "changed", "changed_marks")
    return full.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("marks", "").alias("fingerprint"),
        F.array_join("changed_marks", "").alias("edited_fingerprint"),
        imatch.likeness(F.col("marks"), F.col("changed_marks")).alias("near_edited"),
        imatch.likeness(F.col("marks"), F.col("next.marks")).alias("near_next"),
    )


NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INTEGER AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 5"""


@query("op11_threshold_negatives", NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query("op12_line_blocks")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


TRIE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
z AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS lender, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 4 AS h
  FROM z),
r AS (
  SELECT c.conv_id, t.place AS depth, t.role, t.text FROM c JOIN t ON t.conv_id = c.lender AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(z.own, 0)), t.role, t.text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h LEFT JOIN z ON z.conv_id = c.lender),
s AS (
  SELECT c.conv_id, coalesce(q.p, []) AS p, coalesce(q.w, []) AS w
  FROM c LEFT JOIN (
    SELECT conv_id, list(md5(role) || md5(text) ORDER BY depth) AS p, list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) ORDER BY depth) AS w
    FROM r GROUP BY conv_id) q USING (conv_id)),
n AS MATERIALIZED (
  SELECT array_to_string(p[1:d], '') AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n, max(coalesce(w[d], 0)) AS words,
    coalesce(string_agg(CASE WHEN len(p) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ids
  FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM s) GROUP BY 1, 2),
k AS (SELECT left(path, 64 * (depth - 1)::BIGINT) AS path, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
b AS (
  SELECT x.path, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.path = y.path)) AS leaves, sum((y.n - 1) * y.words) AS saved
  FROM n x JOIN n y ON starts_with(y.path, x.path) GROUP BY x.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens,
  sha256(n.ids) AS ends_sha256
FROM n JOIN b ON b.path = n.path LEFT JOIN k ON k.path = n.path LEFT JOIN n u ON n.depth > 0 AND u.path = left(n.path, 64 * (n.depth - 1)::BIGINT)"""


@query("op13_conversation_trie", TRIE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))
