"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding never encodes a word twice:

1. The documents are cut into *blocks* (about 32 MB of text each).  A block keeps, for
   every document, the sequence of its pre-tokens as numbers into the block's own list of
   distinct words: words and positions exploded once, in columnar form.  The
   blocks are written to the shared folder, so a lost executor repeats nothing else.
2. Each block sends its distinct words, dealt by word hash into buckets, through one
   shuffle.  In a bucket a word arrives once per block at most, whatever its count
   in the corpus, and it is encoded once for all blocks.
3. The ids go back to the blocks, join their words there and replace the numbers at their
   positions.

A word that makes up a third of the corpus is one entry per block.  A task holds the
distinct words of one bucket, or one block; both are bounded.  Decoding joins the
token-byte table (its size is that of the vocabulary, checked) in Arrow batches.

Defined cases: null and empty texts have no ids and decode to no bytes; special tokens
are ordinary text; repeated rows are encoded row by row; an id outside the
vocabulary raises; an empty table gives an empty table.  Other columns of the input pass
through both directions untouched.
"""

from __future__ import annotations

import base64
import functools
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import fresh_path
from .common import slices, text_array, tidy

BLOCK_BYTES = 32 << 20
ROWS = 500  # documents of a block that are put together at once
MAX_VOCABULARY = 1 << 22  # bound on the token-byte table that is broadcast


def read_ranks(lines) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


def load_lines(path: str) -> list[str]:
    """The rank file, one token a line; it is small and lies beside the library on the driver."""
    with open(path, encoding="ascii") as file:
        lines = file.read().splitlines()
    if len(lines) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY} tokens is not broadcast")
    return lines


def for_latin(pattern: str) -> re.Pattern:
    """The split pattern for texts of Latin-1 characters, its classes written out: the faster engine then knows them."""
    of = {c: "".join(f"\\x{i:02x}" for i in range(256) if regex.match(c, chr(i))) for c in (r"\p{L}", r"\p{N}", r"\s")}
    of[r"\S"] = "".join(f"\\x{i:02x}" for i in range(256) if not regex.match(r"\s", chr(i)))
    inside = regex.sub(r"\[[^\]]*\]", lambda m: functools.reduce(lambda s, c: s.replace(c, of[c]), of, m[0]), pattern)
    return re.compile(functools.reduce(lambda s, c: s.replace(c, f"[{of[c]}]"), of, inside))


@functools.cache
def splitter(pattern: str):
    """Function from a text to its pre-tokens.

    The `regex` module may know a newer Unicode than the tokenizer library.  Characters
    whose classes differ are replaced by an unassigned one for the split alone.
    """
    latin, general = for_latin(pattern), regex.compile(pattern)
    drift: list = []

    def moved(text: str) -> str:
        if not drift:
            every = [chr(c) for c in range(0x250, 0x110000) if not 0xD800 <= c < 0xE000]
            whole = "".join(every)
            single = {bytes([i]): i for i in range(256)}
            changed = set()
            for c in (r"\p{L}", r"\p{N}", r"\s"):
                theirs = bytes(tiktoken.Encoding("class", pat_str=c, mergeable_ranks=single, special_tokens={}).encode_ordinary(whole)).decode()
                changed |= set(theirs) ^ set(regex.findall(c, whole))
            drift.append(changed)
            drift.append(str.maketrans(dict.fromkeys(changed, "͸")))
        return text if drift[0].isdisjoint(text) else text.translate(drift[1])

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            seen = moved(text)
            pieces = general.findall(seen)
            if seen is text:
                return pieces
            ends = np.cumsum([len(p) for p in pieces]).tolist()
            return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return latin.findall(text)

    return split


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative numbers below 2^32 as compressed byte planes."""
    numbers = numbers.astype("<u4")
    wide = 1 if not len(numbers) else max(1, (int(numbers.max()).bit_length() + 7) // 8)
    planes = numbers.view(np.uint8).reshape(-1, 4)[:, :wide].T
    return bytes([wide]) + zlib.compress(planes.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    wide, planes = packed[0], np.frombuffer(zlib.decompress(packed[1:]), np.uint8)
    out = np.zeros((len(planes) // wide, 4), np.uint8)
    out[:, :wide] = planes.reshape(wide, -1).T
    return out.view("<u4")[:, 0].astype(np.int64)


class Block:
    """Documents of one block while it is filled."""

    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.codes, self.rows, self.bytes = [], [], 0

    def add(self, texts: list[str], split) -> None:
        for t in texts:
            pieces = split(t)
            self.codes.append(np.fromiter(map(self.number.__getitem__, pieces), np.int32, len(pieces)))
            self.bytes += len(t)

    def batches(self, schema: pa.Schema, buckets: int) -> Iterator[pa.RecordBatch]:
        """Rows of documents with their numbers, then rows of words: number 0 is the most frequent word."""
        block = uuid.uuid4().int >> 65
        words = np.array(list(self.number), object)
        every = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(every, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        at = 0
        for kept in self.rows:
            codes = [pack(rank[c]) for c in self.codes[at : at + len(kept)]]
            at += len(kept)
            n = len(kept)
            made = [pa.array([block] * n, pa.int64()), pa.array(codes, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], schema=schema)
        words = words[order].tolist()
        deal = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
        by = np.argsort(deal, kind="stable")
        there, first = np.unique(deal[by], return_index=True)
        groups = np.split(by, first[1:])
        n = len(there)
        made = [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(there, pa.int32()), pa.array([pack(np.diff(g, prepend=0)) for g in groups], pa.binary()), pa.array([[words[i] for i in g] for g in groups], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(n, f.type) for f in list(schema)[:-5]), *made], schema=schema)


def in_blocks(docs: DataFrame, pattern: str, buckets: int, parts: int) -> DataFrame:
    """The documents as numbers and the words of each block, in one stored table bucketed by block."""
    kept = [c for c in docs.columns if c != "text"]
    docs = docs.select(*(F.col(f"`{c}`") for c in kept), "text")
    extra = "__block long, __codes binary, __bucket int, __numbers binary, __words array<string>"
    schema = StructType([*(StructField(f.name, f.dataType) for f in docs.schema.fields[:-1]), *StructType.fromDDL(extra).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, block = splitter(pattern), Block()
        for batch in batches:
            texts = text_array(batch.column(batch.num_columns - 1))
            for lo, hi in slices(texts):
                part = batch.slice(lo, hi - lo)
                block.rows.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(part.columns[:-1], arrow)], schema=pa.schema(list(arrow)[:-5])))
                block.add(texts.slice(lo, hi - lo).to_pylist(), split)
                if block.bytes >= BLOCK_BYTES:
                    yield from block.batches(arrow, buckets)
                    block = Block()
        if block.rows:
            yield from block.batches(arrow, buckets)

    spark, name = docs.sparkSession, f"text_blocks_{uuid.uuid4().hex}"
    made = docs.mapInArrow(tidy(run), schema)
    # bucketed by block: the documents meet their ids later without travelling
    made.write.bucketBy(parts, "__block").option("path", fresh_path(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def word_ids(dealt: DataFrame, ranks) -> DataFrame:
    """Encode every distinct word of a bucket once, for all blocks that hold it."""

    def encode(group: pa.Table) -> pa.Table:
        coder = whole_word_coder(ranks)
        words = group.column("__words").combine_chunks()
        flat = words.flatten().dictionary_encode()
        known = [coder.encode_ordinary(w) for w in flat.dictionary.to_pylist()]
        size = np.array([len(k) for k in known], np.int64)
        ids = np.fromiter((i for k in known for i in k), np.int64, int(size.sum()))
        start = np.cumsum(size) - size
        at = flat.indices.to_numpy()
        ends = np.cumsum(pc.list_value_length(words).to_numpy())
        rows = [at[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return pa.table({
            "__block": group.column("__block").cast(pa.int64()),
            "__numbers": group.column("__numbers").cast(pa.binary()),
            "__sizes": pa.array([pack(size[r]) for r in rows], pa.binary()),
            "__ids": pa.array([pack(ids[gather(start[r], size[r])]) for r in rows], pa.binary()),
        })

    out = "__block long, __numbers binary, __sizes binary, __ids binary"
    return dealt.groupBy("__bucket").applyInArrow(tidy(encode), out)


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0] + 1, ... start[0] + size[0] - 1, start[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


@functools.lru_cache(maxsize=2)
def coder_of(lines: tuple) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=read_ranks(lines), special_tokens={})


def whole_word_coder(ranks) -> tiktoken.Encoding:
    """The library's merges on a whole word; kept in the worker between groups."""
    return coder_of(ranks.value)


def encode(docs: DataFrame, vocabulary: str, pattern: str, out: str = "ids") -> DataFrame:
    """The columns of `docs` but `text`, and the token ids of the text as an array of integers."""
    spark = docs.sparkSession
    if out in docs.columns:
        raise ValueError(f"column {out!r} is there already; name another")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = spark.sparkContext.broadcast(tuple(load_lines(vocabulary)))
    both = in_blocks(docs, pattern, 4 * parts, parts)
    texts = both.where("__words is null").drop("__bucket", "__numbers", "__words")
    ids = word_ids(both.where("__words is not null").select("__block", "__bucket", "__numbers", "__words"), ranks)
    fields = [f for f in texts.schema.fields if not f.name.startswith("__")]
    schema = StructType([*fields, StructField(out, ArrayType(IntegerType()))])
    arrow = to_arrow_schema(schema)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        numbers = [np.cumsum(unpack(x)) for x in right.column("__numbers").to_pylist()]
        sizes = [unpack(x) for x in right.column("__sizes").to_pylist()]
        total = int(sum(map(len, numbers)))
        number = np.concatenate([np.zeros(0, np.int64), *numbers])
        size, start = np.zeros(total, np.int64), np.zeros(total, np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *(unpack(x) for x in right.column("__ids").to_pylist())]).astype(np.int32)
        size[number] = np.concatenate([np.zeros(0, np.int64), *sizes])
        start[number] = np.cumsum(size[number]) - size[number]
        made = []
        for at in range(0, max(1, left.num_rows), ROWS):  # small chunks: no second copy of the whole block
            part = left.slice(at, ROWS)
            lists = [flat[gather(start[c], size[c])] for c in map(unpack, part.column("__codes").to_pylist())]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *lists])))
            kept = [part.column(f.name).combine_chunks().cast(a.type) for f, a in zip(fields, arrow)]
            made.append(pa.Table.from_arrays([*kept, ids], schema=arrow))
        return pa.concat_tables(made)

    return texts.groupBy("__block").cogroup(ids.groupBy("__block")).applyInArrow(tidy(join), schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """All columns and the bytes of the ids: each id joined with its row of the token-byte table."""
    spark = encoded.sparkSession
    if out in encoded.columns:
        raise ValueError(f"column {out!r} is there already; name another")
    lines = spark.sparkContext.broadcast(tuple(load_lines(vocabulary)))
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte, start, size, known = byte_table(lines.value)
        for batch in batches:
            column = batch.column(at)
            values = []
            for i in range(len(column)):
                token = column[i].values.to_numpy(zero_copy_only=False) if column[i].is_valid else np.zeros(0, np.int64)
                if len(token) and not (0 <= token.min() and token.max() < len(known) and known[token].all()):
                    raise ValueError("an id is not in the vocabulary")
                values.append(byte[gather(start[token], size[token])].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], [*batch.schema.names, out])

    return encoded.mapInArrow(tidy(run), StructType([*encoded.schema.fields, StructField(out, BinaryType())]))


def byte_table(lines) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All token bytes end to end, and start, length and presence by id."""
    ranks = read_ranks(lines)
    n = max(ranks.values(), default=-1) + 1
    tokens = [b""] * n
    for token, rank in ranks.items():
        tokens[rank] = token
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size, size > 0
