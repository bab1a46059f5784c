"""Token ids of documents in Simple-8b blocks, in ascending doc_id order.

A 64-bit word holds a selector in its top four bits and 1 to 60 ids of equal width below. Selector 0 is the escape: its
payload is an index into the block's list of 64-bit values that need more than 60 bits. A block holds whole documents,
with the offset of each, so it can be decoded alone and in a few vector operations.

Block, little-endian: b"S8B1", documents u32, ids u64, words u64, escaped u64; then the documents' offsets (u64, one more
than documents), the words (u64) and the escaped values (u64). Blocks are rows of a Parquet table (part, start, doc_ids,
block); start counts the ids of the part before the block, and parts follow each other in doc_id order.

Defined cases: a null text counts as empty, its ids are the end id alone. Null doc_ids come first. Repeated doc_ids are
each encoded, in the order of their texts. An empty table gives an empty result. Columns besides doc_id and text are
ignored. The longest document bounds a block's size beyond block_ids.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CACHES, scratch_path

#: Width in bits of each selector's ids; selector 0 is the escape. As many ids as fit 60 bits share a word.
WIDTHS = (60, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
COUNTS = tuple(60 // w if i else 1 for i, w in enumerate(WIDTHS))
MAGIC, HEAD = b"S8B1", struct.Struct("<4sIQQQ")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escaped values of ids (uint64): each word takes as many of the next ids as any selector allows."""
    n = len(ids)
    ids = ids.astype(np.uint64, copy=False)
    step, pick = np.ones(n, dtype=np.int64), np.ones(n, dtype=np.uint64)
    wide = ids >> np.uint64(60) != 0
    pick[wide] = 0
    # how many widths are too narrow for each id, and the most of that among the next 1, 2, 4… ids
    narrow, top = np.zeros(n, dtype=np.uint8), int(ids.max(initial=0))
    values = ids.astype(np.uint32) if top >> 32 == 0 else ids
    for width in WIDTHS[1:]:
        if top >> width:
            narrow += values > values.dtype.type((1 << width) - 1)
    span, most = 1, {1: narrow}
    for sel in range(2, len(WIDTHS)):
        count = COUNTS[sel]
        if count > n:
            break
        while 2 * span <= count:
            most[2 * span] = np.maximum(most[span][:-span], most[span][span:])
            span *= 2
        whole = np.maximum(most[span][: n - count + 1], most[span][count - span : n - span + 1])
        fits = np.flatnonzero(whole <= len(WIDTHS) - 1 - sel)
        if not len(fits):
            break
        step[fits], pick[fits] = count, sel
    starts, steps, p = [], step.tolist(), 0
    while p < n:
        starts.append(p)
        p += steps[p]
    first = np.array(starts, dtype=np.int64)
    sels = pick[first]
    words, escaped = sels << np.uint64(60), ids[wide]
    for sel in np.unique(sels).tolist():
        mine = np.flatnonzero(sels == sel)
        if sel == 0:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
            continue
        cols = ids[first[mine][:, None] + np.arange(COUNTS[sel])]
        shifts = np.arange(COUNTS[sel], dtype=np.uint64) * np.uint64(WIDTHS[sel])
        words[mine] |= np.bitwise_or.reduce(cols << shifts, axis=1)
    return words, escaped


def unpack(words: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The n ids of pack()'s words."""
    sels = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS, dtype=np.int64)[sels]
    first = np.cumsum(counts) - counts
    out = np.empty(n, dtype=np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for sel in np.unique(sels).tolist():
        mine = np.flatnonzero(sels == sel)
        if sel == 0:
            out[first[mine]] = escaped[payload[mine].astype(np.int64)]
            continue
        shifts = np.arange(COUNTS[sel], dtype=np.uint64) * np.uint64(WIDTHS[sel])
        out[first[mine][:, None] + np.arange(COUNTS[sel])] = (payload[mine][:, None] >> shifts) & np.uint64((1 << WIDTHS[sel]) - 1)
    return out


def write_block(docs: list[np.ndarray]) -> bytes:
    """A block of documents' ids."""
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype("<u8")
    ids = np.concatenate(docs).astype(np.uint64) if docs else np.empty(0, np.uint64)
    words, escaped = pack(ids)
    head = HEAD.pack(MAGIC, len(docs), len(ids), len(words), len(escaped))
    return head + offsets.tobytes() + words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()


def read_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the documents, and all ids."""
    magic, n_docs, n_ids, n_words, n_escaped = HEAD.unpack_from(data)
    if magic != MAGIC or len(data) != HEAD.size + 8 * (n_docs + 1 + n_words + n_escaped):
        raise ValueError("not a whole Simple-8b block")
    body = np.frombuffer(data, dtype="<u8", offset=HEAD.size).astype(np.uint64)
    offsets, words, escaped = np.split(body, [n_docs + 1, n_docs + 1 + n_words])
    return offsets.astype(np.int64), unpack(words, escaped, n_ids)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


CACHES.append(_encoder.cache_clear)


class _Made(dict):
    """A dictionary that makes what it misses, and is emptied by shrink() beyond its size bound."""

    def __init__(self, make: Callable[[str], bytes], limit: int) -> None:
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.make(key)
        return value

    def shrink(self) -> None:
        if len(self) > self.limit:
            self.clear()


class WordEncoder:
    """The ids that Tokenizer.encode gives a text, put together from the ids of its space-parted words.

    The tokenizer parts at white space, so a word's ids do not depend on its neighbours. They are kept in dictionaries
    of bounded size. A new word of plain Latin letters is normalised and parted here by the tokenizer's own published
    rules and given to the tokenizer's model; any other, and a text that holds a special token, goes through Tokenizer.encode.
    """

    def __init__(self, path: str, limit: int = 600_000) -> None:
        import json

        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        rules = json.loads(Path(path).read_text())
        kinds = [x["type"] for x in rules["normalizer"]["normalizers"]] if (rules.get("normalizer") or {}).get("type") == "Sequence" else []
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
        self.quick = kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["invert"]
        self.parts = regex.compile(steps[0]["pattern"]["Regex"]).findall if self.quick else None
        self.plain = regex.compile("[!-~¡-¬®-ſ]+").fullmatch
        self.parted = any(x.get("type") in ("Split", "Whitespace", "WhitespaceSplit") for x in [*steps, rules.get("pre_tokenizer") or {}])
        self.specials = [x["content"] for x in rules.get("added_tokens", [])]
        shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
        self.table = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.words, self.pieces = _Made(self.word, limit), _Made(self.piece, limit)
        self.tokenize = self.tok.model.tokenize

    def piece(self, p: str) -> bytes:
        shown = p if p.isascii() else p.encode().decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def word(self, w: str) -> bytes:
        if not (self.quick and (w.isascii() and w.isprintable() or self.plain(w))):
            return array("I", self.tok.encode(w, add_special_tokens=False).ids).tobytes()
        low = w.lower()
        if low.isalpha():  # after lowering: that of U+0130 has a mark, where the tokenizer parts
            return self.piece(low) if low == w else self.words[low]
        # a piece of letters is kept as the word that it is, too
        return b"".join([self.words[p] if p.isalpha() and p == p.lower() else self.pieces[p] for p in self.parts(low)])

    def __call__(self, text: str) -> bytes:
        """The ids as native unsigned 32-bit integers."""
        if not self.parted or any(s in text for s in self.specials):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        self.words.shrink()
        self.pieces.shrink()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


BLOCKS = "part int, start long, n_ids long, doc_ids array<long>, block binary"


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, block_ids: int = 1 << 16, parts: int | None = None) -> None:
    """Encode docs' texts into a table of blocks at path, ranged and sorted by doc_id."""
    import pyarrow as pa

    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # texts of one doc_id come by their hashes, so that a doc_id that repeats much is dealt to several tasks
    ranged = ranged.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, end = _encoder(tokenizer), TaskContext.get().partitionId(), array("I", [end_id]).tobytes()
        start, names, held, size = 0, [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([size], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([write_block(held)], pa.binary())], ["part", "start", "n_ids", "doc_ids", "block"])

        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.frombuffer(encoder(text.as_py()) + end, dtype=np.uint32)
                names.append(name)
                held.append(ids)
                size += len(ids)
                if size >= block_ids:
                    yield block()
                    start, names, held, size = start + size, [], [], 0
        if held:
            yield block()

    ranged.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(path)


def part_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """The ids before each part; as many rows as parts go to the driver."""
    sums = spark.read.schema(BLOCKS).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    starts, at = {}, 0
    for r in sorted(sums, key=lambda r: r["part"]):
        starts[r["part"]], at = at, at + r["n"]
    return starts


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of every document in the blocks at path."""
    import pyarrow as pa

    starts = part_starts(spark, path)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start, names, data in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                offsets, ids = read_block(data)
                small = ids.astype("<u4")
                crcs = [zlib.crc32(small[x:y].tobytes()) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                cols = [pa.array(names, pa.int64()), pa.array(starts[part] + start + offsets[:-1]), pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return spark.read.schema(BLOCKS).parquet(path).select("part", "start", "doc_ids", "block").mapInArrow(decode, schema)


def token_ids(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Write docs' ids at path (a folder of its own in the shared folder if none is given) and return what they read back as."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "ids")
    write_ids(docs, tokenizer, path, end_id)
    return read_ids(spark, path, with_ids)
