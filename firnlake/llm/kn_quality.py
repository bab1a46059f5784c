"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Trusted text is that of documents labelled quality 1: a fifth of them (by crc32 of doc_id) sets the thresholds, the model
is trained on all others. Words become ids: the HELD most frequent are numbered, all others are their hashes. Trigrams, of
training texts with their counts and of all texts with their documents, go to shards by their middle word, in sorted and
compressed blocks (a frequent middle word has several shards, by the word before it). A shard then has all that a trigram's
context, its bigram and itself take, so counts and scores are joined there, and only sums by document leave it. Of a bigram the
shards count how many words go before it; these counts, and those of words, are tables. Scoring goes over the words' SLICES
one after another, so that a part of the trigrams is on disk at a time, and files of a finished slice's shuffles are deleted.
A document goes whose log perplexity is above its language's upper threshold or below its lower one; each is a quantile of the
language's reserved trusted documents, moved outwards by slack times its distance from the median.

Defined cases: a null or blank text has no words, perplexity null, and is rejected. A text of fewer than min_tokens words is too short to judge and kept.
Languages with fewer than min_docs reserved documents, and null, take the thresholds of all languages together. Without
trusted text nothing is rejected but blank texts. Labels that repeat a doc_id count once, by their least quality; documents that repeat one are judged each. Columns besides
doc_id, text and lang are ignored.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fold, framed, hashed, materialize, mix64, release, restored, shielded, small
from .lookup import Table

#: Words that have a number, parts of the words that are scored one after another, and words of texts whose trigrams a task deals to shards at once.
HELD, SLICES, CHUNK = 1_000_000, 3, 3 << 19
#: The bit that a hashed word has set, and what stands for the neighbours of a word that is asked for alone.
HASHED, ONE = np.uint64(1 << 63), np.uint64(1 << 62)
#: What stands for words that training texts lack, and the most hashed words that tasks hold a filter of.
UNKNOWN, FILTERED = np.uint64(1 << 62 | 1), 4_000_000
START, END = np.uint64(0x5EED), np.uint64(0xE0D)
_P = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def key_of(*words: np.ndarray) -> np.ndarray:
    """A mixed 64-bit key of an n-gram of word hashes."""
    total = np.full(len(words[0]), len(words), dtype=np.uint64)
    for w, p in zip(words, _P, strict=False):
        total += mix64(w ^ p) * p
    return mix64(total)


def sequences(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bounds, hashes) of some rows of an Arrow column of texts at a time: of each text two start marks, the words (case kept) and the end mark."""
    for bounds, words in hashed(texts, lower=False):
        yield framed(bounds, words, START, 2, END)


def trusted(labels: DataFrame) -> DataFrame:
    """_id of the documents labelled quality 1."""
    own = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("q"))
    return own.filter(F.col("q") == 1).select("_id")


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs' doc_id and text, with train for the trusted rows that the model is trained on."""
    own = materialize(trusted(labels).filter(fold(F.col("_id"), 5) != 0), "training")
    ids = small(own)
    out = docs.select("doc_id", "text").join(ids.withColumn("train", F.lit(True)), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    # where that takes a shuffle of the texts, it is done once
    return out if ids is not own else materialize(out, "marked")


_HEAD = struct.Struct("<QQ")


def squeeze(*columns: np.ndarray) -> bytes:
    """Some columns of equal length, by the bytes of their numbers: those of one place together, as such compress."""
    import pyarrow as pa

    codec, n = pa.Codec("zstd", 1), len(columns[0])
    planes = np.stack([c.view(np.uint64) for c in columns]).astype("<u8").view(np.uint8).reshape(len(columns), n, 8).transpose(0, 2, 1).reshape(8 * len(columns), n)
    used = np.flatnonzero(planes.any(axis=1)).tolist()
    step = 1 if n >= 4096 else len(used)
    out = [_HEAD.pack(n, sum(1 << i for i in used))]
    for i in range(0, len(used), step or 1):
        piece = codec.compress(np.ascontiguousarray(planes[used[i : i + step]]), asbytes=True)
        out += [struct.pack("<I", len(piece)), piece]
    return b"".join(out)


def spread(data: bytes, width: int) -> list[np.ndarray]:
    """The columns that squeeze() was given."""
    import pyarrow as pa

    codec, (n, mask), at = pa.Codec("zstd", 1), _HEAD.unpack_from(data), _HEAD.size
    planes = np.zeros((8 * width, n), dtype=np.uint8)
    used = [i for i in range(8 * width) if mask >> i & 1]
    step = 1 if n >= 4096 else len(used)
    for i in range(0, len(used), step or 1):
        size = struct.unpack_from("<I", data, at)[0]
        mine = used[i : i + step]
        planes[mine] = np.frombuffer(codec.decompress(data[at + 4 : at + 4 + size], n * len(mine)), dtype=np.uint8).reshape(len(mine), n)
        at += 4 + size
    return list(np.ascontiguousarray(planes.reshape(width, 8, n).transpose(0, 2, 1)).view("<u8").reshape(width, n).astype(np.uint64, copy=False))


#: Blocks on their way to a shard; the kinds are trigrams of training texts (middle, first and last word, count), bigrams (words, count, count
#: of the second word), trigrams of texts (middle, first and last word, row in the chunk), chunks' rows, and sums by row.
BLOCKS = "part int, kind int, chunk long, block binary"
TRAIN, PAIRS, ASKED, ROWS, SUMS = range(5)


def _blocks(rows: list[tuple[int, int, int, bytes]]):
    import pyarrow as pa

    part, kind, chunk, block = zip(*rows, strict=True) if rows else ([],) * 4
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(chunk, pa.int64()), pa.array(block, pa.binary())], ["part", "kind", "chunk", "block"])


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys in which equal ones stand together, and where each of them starts there."""
    order = np.argsort(keys)
    keys = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def _summed(keys: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and the sums of their counts."""
    order, starts = grouped(keys)
    return keys[order[starts]], order[starts], np.add.reduceat(c[order], starts) if len(starts) else c


def _placed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the place of each key among them."""
    order, starts = grouped(keys)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(keys)))
    return keys[order[starts]], place


@dataclass
class Words:
    """Numbers of the most frequent words by their hashes (in that order), and how many shards the trigrams about each of them are dealt to."""

    hashes: np.ndarray
    spans: np.ndarray
    parts: int

    def __post_init__(self) -> None:
        numbers = np.arange(len(self.hashes), dtype=np.uint64)
        self.table, self.held = Table(self.hashes, numbers), len(numbers)
        # the most frequent word of each slot is found at once
        self.near, self.number = np.zeros(1 << 16, dtype=np.uint64), np.full(1 << 16, HASHED)
        slots = (self.hashes[::-1] >> np.uint64(48)).astype(np.int64)
        self.near[slots], self.number[slots] = self.hashes[::-1], numbers[::-1]
        self.hashes = None  # the table has them

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes >> np.uint64(48)).astype(np.int64)
        out = self.number[slots]
        more = np.flatnonzero(self.near[slots] != hashes)
        at = self.table.find(hashes[more])
        out[more] = np.where(at >= 0, self.table.values[0][at], hashes[more] | HASHED) if self.held else hashes[more] | HASHED
        return out

    def span(self, v: np.ndarray) -> np.ndarray:
        out = np.ones(len(v), dtype=np.uint64)
        held = v < np.uint64(len(self.spans))
        out[held] = self.spans[v[held].astype(np.int64)]
        return out

    def shard(self, v: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The j-th shard of the trigrams about a word."""
        return (mix64(v + _P[0]) + j * _P[1] >> np.uint64(11)) % np.uint64(self.parts)

    def shard_of(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return self.shard(v, mix64(u + _P[2]) % self.span(v))

    def deal(self, kind: int, chunk: int, shard: np.ndarray, v: np.ndarray, *others: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        """Blocks of the columns by shard, in an order that compresses."""
        most = np.uint64((1 << 25) - 1)
        order = np.argsort(shard << np.uint64(50) | np.minimum(v, most) << np.uint64(25) | np.minimum(others[0], most))
        shard, v, others = shard[order], v[order], [x[order] for x in others]
        cuts = np.searchsorted(shard, np.arange(self.parts + 1, dtype=np.uint64)).tolist()
        for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                yield part, kind, chunk, squeeze(np.diff(v[a:b], prepend=np.uint64(0)), *(x[a:b] for x in others))


def undealt(block: bytes) -> list[np.ndarray]:
    first, *others = spread(block, 4)
    return [np.cumsum(first, dtype=np.uint64), *others]


def slice_of(v: np.ndarray) -> np.ndarray:
    return mix64(v ^ _P[1]) % np.uint64(SLICES)


def numbered(rows: DataFrame) -> Words:
    """Numbers for the most frequent words of training texts. They set what a word takes on its way and where it goes, not what is counted."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(found: list) -> list[np.ndarray]:
            w, n, t = (np.concatenate(x) for x in zip(*found, strict=True))
            order, starts = grouped(w)
            return [w[order[starts]], np.add.reduceat(n[order], starts), np.add.reduceat(t[order], starts)]

        release()
        found = []
        for b in batches:
            done = 0
            for bounds, s in sequences(b.column(0)):
                train = b.column(1).slice(done, len(bounds) - 1).is_valid().to_numpy(zero_copy_only=False)
                done += len(bounds) - 1
                own = s[np.repeat(train, np.diff(bounds))]
                for x, of in ((s, 1), (own, 2)):
                    w, c = np.unique(x, return_counts=True)
                    found.append([w, c * (of == 1), c * (of == 2)])
                if sum(len(w) for w, _, _ in found[1:]) > HELD // 4:
                    found = [merged(found)]
        if found and any(len(w) for w, _, _ in found):
            w, n, t = merged(found)
            often = n > 1
            yield pa.RecordBatch.from_arrays([pa.array(w[often].view(np.int64)), pa.array(n[often]), pa.array(t[often])], ["w", "n", "t"])
            del found, w, n, t, often
        release()

    counts = rows.select("text", "train").mapInArrow(count, "w long, n long, t long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    counts = materialize(counts, "words", tidy=True)
    best = counts.filter("t > 0").orderBy(F.desc("t"), "w").limit(HELD).toArrow()
    total = counts.agg(F.sum("n")).first()[0] or 1
    discard(counts)
    parts = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8191)
    words, n = best.column(0).to_numpy().view(np.uint64), best.column(1).to_numpy()
    return Words(words, np.clip(-(-4 * parts * n // total), 1, parts).astype(np.uint16), parts)


def trigrams(bounds: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a trigram ends, and its row; texts without words have none."""
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    at = np.flatnonzero((row[2:] == row[:-2]) & (np.diff(bounds) > 3)[row[2:]]) + 2
    return at, row[at]


def trained(words: Words, chunk: int, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """Blocks of the trigrams, counted."""
    _, first, c = _summed(key_of(u, v, w), np.ones(len(u), dtype=np.uint64))
    u, v, w = u[first], v[first], w[first]
    yield from words.deal(TRAIN, chunk, words.shard_of(u, v), v, u, w, c)


def pieces(batches, text: int) -> Iterator[tuple]:
    """Parts of the batches, their bounds and their words' hashes."""
    for b in batches:
        done = 0
        for bounds, s in sequences(b.column(text)):
            yield b.slice(done, len(bounds) - 1), bounds, s
            done += len(bounds) - 1


def joined(held: list) -> list[np.ndarray]:
    """The columns of some parts."""
    return [np.concatenate(x) for x in zip(*held, strict=True)]


def bigram_counts(rows: DataFrame, words) -> DataFrame:
    """kind, v, w, c: of a bigram the words met before it (kind 0; kind 1 where v has other shards, too), and the trigrams that are met v times (kind 2; v from 1 to 4), by shard."""
    import pyarrow as pa

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, bounds, s in pieces(batches, 0):
            ids, at = words.value.ids(s), trigrams(bounds, s)[0]
            held.append((ids[at - 2], ids[at - 1], ids[at]))
            size += len(at)
            if size >= CHUNK // 3:
                yield _blocks(list(trained(words.value, 0, *joined(held))))
                held, size = [], 0
        if held:
            yield _blocks(list(trained(words.value, 0, *joined(held))))
            del held
        release()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [undealt(x.as_py()) for b in batches for x in b.column(3)]
        if blocks:
            v, u, w, c = (np.concatenate(x) for x in zip(*blocks, strict=True))
            _, first, c = _summed(key_of(u, v, w), c)
            v, w = v[first], w[first]
            _, first, n = _summed(key_of(v, w), np.ones(len(v), dtype=np.uint64))
            order = np.lexsort((w[first], v[first]))  # as such they compress
            first, n = first[order], n[order]
            few = np.array([(c == i).sum() for i in range(1, 5)])
            kind = np.concatenate([words.value.span(v[first]) > np.uint64(1), np.full(4, 2)]).astype(np.int32)
            v, w = np.concatenate([v[first].view(np.int64), np.arange(1, 5)]), np.concatenate([w[first].view(np.int64), np.zeros(4, np.int64)])
            for i in range(0, len(kind), 100_000):
                own = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(kind[own]), pa.array(v[own]), pa.array(w[own]), pa.array(np.concatenate([n, few]).astype(np.int64)[own])], ["kind", "v", "w", "c"])

    parts = words.value.parts
    dealt = rows.filter("train").select("text").mapInArrow(deal, BLOCKS).repartitionById(parts, F.col("part"))
    return dealt.mapInArrow(count, "kind int, v long, w long, c long")


def _discounts(n: dict[int, int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the counts of counts."""
    n1, n2, n3, n4 = (float(n.get(i, 0)) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return np.array([0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([min(max(d, 0.05), k - 0.05) for d, k in zip(found, (1, 2, 3), strict=True)])


def _few(counts: DataFrame) -> dict[int, int]:
    return {r["c"]: r["n"] for r in counts.filter("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}  # at most 4 rows


def _less(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return d[np.clip(c, 1, 3).astype(np.int64) - 1]


@dataclass
class Known:
    """Counts of the words that have a number, and a filter of the others that training texts have (none if these are many)."""

    c1: np.ndarray
    seen: np.ndarray | None

    @staticmethod
    def filter(ids: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << max(10, (16 * len(ids)).bit_length()), dtype=bool)
        bits[Known.bit(ids, len(bits))] = True
        return np.packbits(bits, bitorder="little")

    @staticmethod
    def bit(ids: np.ndarray, size: int) -> np.ndarray:
        return (ids >> np.uint64(8) & np.uint64(size - 1)).astype(np.int64)

    def known(self, ids: np.ndarray) -> np.ndarray:
        """ids with UNKNOWN for words that the filter lacks."""
        if self.seen is not None:
            far = np.flatnonzero(ids >= HASHED)
            bit = self.bit(ids[far], 8 * len(self.seen))
            ids[far[self.seen[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 0]] = UNKNOWN
        return ids


@dataclass
class Model:
    """What a word's log10 probability is the sum of: that of an unknown one and the values of the n-grams that end in it or are its contexts.

    p(w | u, v) = share + weight(u, v) p(w | v) for known trigrams and weight(u, v) p(w | v) for others, and likewise below. An n-gram
    adds log10 of what it adds to its back-off, and its log10 weight as a context. rows: text and train. pairs: the counts of bigrams and
    of their second words, and those of words that have no number.
    """

    rows: DataFrame
    words: object
    pairs: DataFrame
    known: object
    discounts: list[np.ndarray]
    total: float
    unknown: float

    def own1(self, c: np.ndarray) -> np.ndarray:
        """Of words of the given counts."""
        p = (c - _less(c, self.discounts[0])) / self.total + self.unknown
        return np.where(c > 0, np.log10(p / self.unknown), 0.0)

    def scored(self, asked: DataFrame, part: int) -> DataFrame:
        """Sums by row of a chunk over the trigrams of a slice, as blocks; asked has those trigrams, the training texts' ones and the chunks' rows."""
        return _dealt(asked.unionByName(_pair_blocks(self.pairs, self.words, part)), self.words.value.parts).mapInArrow(_scorer(self.discounts, self.total, self.unknown, self.words.value.parts), BLOCKS)

    def log10(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Of a few trigrams."""
        spark, words = self.rows.sparkSession, self.words.value
        u, v, w = (words.ids(x) for x in (u, v, w))
        out, row = np.log10(self.unknown) + _near(self, w), np.arange(len(w), dtype=np.uint64)
        far = w >= HASHED
        whole = [np.concatenate(x) for x in ((v, w[far]), (u, np.full(far.sum(), ONE)), (w, np.full(far.sum(), ONE)), (row, row[far]))]
        for part in range(SLICES):
            mine = slice_of(whole[0]) == part
            v_, u_, w_, r_ = (x[mine] for x in whole)
            if mine.any():
                asked = spark.createDataFrame(list(words.deal(ASKED, 0, words.shard_of(u_, v_), v_, u_, w_, r_)), BLOCKS)
                for r in self.scored(asked.unionByName(_text_blocks(self, self.rows.filter("train"), part, ask=False)), part).collect():
                    at, sums = spread(r["block"], 2)
                    out[np.cumsum(at, dtype=np.uint64).astype(np.int64)] += sums.view(np.float64)
        return out


def _near(model: Model, w: np.ndarray) -> np.ndarray:
    """What words that have a number add themselves; 0 for the others."""
    out, held = np.zeros(len(w)), w < ONE
    out[held] = model.own1(model.known.value.c1[w[held].astype(np.int64)])
    return out


def _dealt(blocks: DataFrame, parts: int) -> DataFrame:
    return blocks.repartitionById(parts, F.col("part"))


def _pair_blocks(pairs: DataFrame, words, part: int) -> DataFrame:
    """The bigrams of a slice, for every shard of their first words."""
    import pyarrow as pa

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list) -> pa.RecordBatch:
            v, w, c, n = (np.concatenate(x) for x in zip(*held, strict=True))
            spans = words.value.span(v).astype(np.int64)
            at = np.repeat(np.arange(len(v)), spans)
            j = (np.arange(len(at)) - np.repeat(np.cumsum(spans) - spans, spans)).astype(np.uint64)
            return _blocks(list(words.value.deal(PAIRS, 0, words.value.shard(v[at], j), v[at], w[at], c[at], n[at])))

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i).to_numpy().view(np.uint64) for i in range(4)]
            mine = slice_of(columns[0]) == part
            held.append([x[mine] for x in columns])
            size += int(mine.sum())
            if size >= CHUNK // 3:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)

    return pairs.mapInArrow(deal, BLOCKS)


def _text_blocks(model: Model, rows: DataFrame, part: int, ask: bool = True) -> DataFrame:
    """The trigrams of a slice, counted in training texts and asked for in all, and the rows of each chunk."""
    import pyarrow as pa

    words, known, unknown = model.words, model.known, float(np.log10(model.unknown))
    own1 = Model(None, None, None, None, model.discounts, model.total, model.unknown).own1  # without tables, as tasks have none

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, own = words.value, own1(known.value.c1)

        def out(k: int, training: list, asked: list, docs: list) -> Iterator[pa.RecordBatch]:
            chunk = TaskContext.get().partitionId() << 32 | k
            yield _blocks(list(trained(held, chunk, *joined(training))))
            if ask:
                u, v, w, row = joined(asked)
                yield _blocks(list(held.deal(ASKED, chunk, held.shard_of(u, v), v, u, w, row)))
                yield _blocks([(chunk % held.parts, ROWS, chunk, squeeze(*joined(docs)))])

        k = size = base = 0
        training, asked, docs = [], [], []
        for b, bounds, s in pieces(batches, 0):
            ids = known.value.known(held.ids(s))
            at, row = trigrams(bounds, s)
            v = ids[at - 1]
            mine = slice_of(v) == part
            own_at = at[mine & b.column(1).is_valid().to_numpy(zero_copy_only=False)[row]]
            training.append((ids[own_at - 2], ids[own_at - 1], ids[own_at]))
            if ask:
                last, mine = ids[at], np.flatnonzero(mine & (v != UNKNOWN))
                alone = np.flatnonzero(last >= HASHED)
                alone = alone[slice_of(last[alone]) == part]
                one = np.full(len(alone), ONE)
                asked.append([np.concatenate(x) for x in ((ids[at[mine] - 2], one), (v[mine], last[alone]), (last[mine], one), ((row[mine] + base).astype(np.uint64), (row[alone] + base).astype(np.uint64)))])
                sizes, near = (np.diff(bounds) - 2) * (part == 0), np.zeros(len(bounds) - 1)
                if part == 0:
                    near_by = last < ONE
                    near = np.bincount(row[near_by], weights=own[last[near_by].astype(np.int64)], minlength=len(near)) + unknown * sizes
                flags = (sizes.astype(np.uint64) << np.uint64(1)) | b.column(2).is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
                docs.append([b.column(2).fill_null(0).to_numpy().view(np.uint64), b.column(3).to_numpy().view(np.uint64), flags, near.view(np.uint64)])
            size, base = size + len(s), base + len(bounds) - 1
            if size >= CHUNK:
                yield from out(k, training, asked, docs)
                k, size, base = k + 1, 0, 0
                training, asked, docs = [], [], []
                release()
        if training:
            yield from out(k, training, asked, docs)
            del training, asked, docs
        release()

    return rows.mapInArrow(deal, BLOCKS)


def _scorer(discounts: list[np.ndarray], total: float, unknown: float, parts: int):
    import pyarrow as pa

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        d1, d2, d3 = discounts
        got = {TRAIN: [], PAIRS: [], ASKED: []}
        for b in batches:
            for kind, chunk, block in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if kind == ROWS:
                    yield _blocks([(chunk_part(chunk, parts), ROWS, chunk, block)])
                else:
                    got[kind].append((chunk, block))
        none = [np.empty(0, np.uint64)] * 4

        def columns(kind: int) -> list[np.ndarray]:
            return [np.concatenate(x) for x in zip(none, *(undealt(block) for _, block in got[kind]), strict=True)]

        # bigrams; those of a frequent word may have come for several shards
        v, w, c, n = columns(PAIRS)
        keys, at, _ = _summed(key_of(v, w), c)
        v, w, c, n = v[at], w[at], c[at].astype(np.float64), n[at].astype(np.float64)
        p1 = (n - _less(n, d1)) / total + unknown
        alone = w == ONE
        less = np.where(alone, 0.0, _less(c, d2))
        contexts, place = _placed(mix64(v))
        sums, freed = (np.bincount(place, weights=x, minlength=len(contexts)) for x in (np.where(alone, 0.0, c), less))
        weight = np.divide(freed, sums, out=np.ones(len(sums)), where=sums > 0)
        lower = weight[place] * p1
        p2 = np.divide(c - less, sums[place], out=np.zeros(len(c)), where=sums[place] > 0) + lower
        own2 = np.where(alone, np.log10(p1 / unknown), np.log10(p2 / lower))
        ones, twos = Table(contexts, np.log10(weight)), Table(keys, own2, p2)
        # trigrams
        v, u, w, c = columns(TRAIN)
        keys, at, c = _summed(key_of(u, v, w), c)
        u, v, w = u[at], v[at], w[at]
        contexts, place = _placed(key_of(u, v))
        less = _less(c, d3)
        sums, freed = (np.bincount(place, weights=x, minlength=len(contexts)) for x in (c, less))
        contexts = Table(contexts, np.log10(freed / np.maximum(sums, 1)))
        threes = Table(keys, np.log10(1 + (c - less) / freed[place] / twos.get(key_of(v, w), 1, 1.0)))
        got[TRAIN] = got[PAIRS] = []

        for chunk, block in got[ASKED]:
            v, u, w, row = undealt(block)
            two = key_of(v, w)
            value = twos.get(two)
            more = u != ONE
            u, v, w = u[more], v[more], w[more]
            value[more] += ones.get(mix64(v)) + contexts.get(key_of(u, v)) + threes.get(key_of(u, v, w))
            row = row.astype(np.int64)
            sums = np.bincount(row, weights=value)
            rows = np.flatnonzero(np.bincount(row))
            yield _blocks([(chunk_part(chunk, parts), SUMS + TaskContext.get().partitionId(), chunk, squeeze(np.diff(rows, prepend=0), sums[rows]))])
        del ones, twos, threes, contexts, keys, place, at, u, v, w, c, got
        release()

    return score


def chunk_part(chunk: int, parts: int) -> int:
    return ((chunk >> 32) * 7919 + (chunk & 0xFFFFFFFF)) % parts


def _combine(batches) -> Iterator:
    """_doc, _text, n (words and end; 0 but in the first slice) and s of the rows of whole chunks."""
    import pyarrow as pa

    got = defaultdict(list)
    for b in batches:
        for kind, chunk, block in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            got[chunk].append((kind, block))
    for found in got.values():
        (_, block), *sums = sorted(found)  # the rows come first, then sums by shard: always in one order
        docs, texts, flags, near = spread(block, 4)
        s = near.view(np.float64).copy()
        for _, block in sums:
            at, more = spread(block, 2)
            s[np.cumsum(at, dtype=np.uint64).astype(np.int64)] += more.view(np.float64)
        null = (flags & np.uint64(1)).astype(bool)
        yield pa.RecordBatch.from_arrays([pa.array(docs.view(np.int64), mask=null), pa.array(texts.view(np.int64)), pa.array((flags >> np.uint64(1)).view(np.int64)), pa.array(s)], ["_doc", "_text", "n", "s"])


def train(rows: DataFrame) -> Model | None:
    """The model of the rows' texts (those that have train set, if there is such a column); None if they have no words."""
    if "train" not in rows.columns:
        rows = rows.withColumn("train", F.lit(True))
    sc = rows.sparkSession.sparkContext
    words = sc.broadcast(numbered(rows))
    found = materialize(bigram_counts(rows, words), "bigrams", tidy=True)
    d3 = _discounts({r["v"]: r["c"] for r in found.filter("kind = 2").groupBy("v").agg(F.sum("c").alias("c")).collect()})  # at most 4 rows
    parted = materialize(found.filter("kind = 1").groupBy("v", "w").agg(F.sum("c").alias("c")), "bigrams", tidy=True)
    two = found.filter("kind = 0").drop("kind").unionByName(parted)
    d2 = _discounts(_few(two))
    uni = materialize(two.groupBy("w").agg(F.count("*").alias("c")), "unigrams", tidy=True)
    total = uni.agg(F.sum("c").alias("s"), F.count("*").alias("n")).first()
    if not total["n"]:
        discard(found, parted, uni)
        return None
    few = _few(uni)
    d1 = _discounts(few)
    # what the discounts free is dealt to the words and an unknown one
    freed = sum(few.get(i, 0) * d1[i - 1] for i in (1, 2)) + (total["n"] - few.get(1, 0) - few.get(2, 0)) * d1[2]
    unknown = float(freed / total["s"] / (total["n"] + 1))
    held = uni.filter("w >= 0").toArrow()  # at most HELD rows
    c1 = np.zeros(len(words.value.spans), dtype=np.int64)
    c1[held.column(0).to_numpy()] = held.column(1).to_numpy()
    hashed_words = uni.filter("w < 0").select("w")
    far = hashed_words.limit(FILTERED + 1).toArrow().column(0).to_numpy().view(np.uint64)
    seen = Known.filter(np.append(far, START | HASHED)) if len(far) <= FILTERED else None  # no bigram ends in the start
    pairs = two.join(small(uni.withColumnRenamed("c", "n")), "w").select("v", "w", "c", "n")
    pairs = pairs.unionByName(uni.filter("w < 0").select(F.col("w").alias("v"), F.lit(int(ONE)).alias("w"), "c", F.col("c").alias("n")))
    pairs = materialize(pairs, "pairs", tidy=True)
    discard(found, parted, uni)
    return Model(rows, words, pairs, sc.broadcast(Known(c1, seen)), [d1, d2, d3], float(total["s"]), unknown)


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """docs, of which model.rows has the doc_id, text and train, with n_tokens (words) and log_ppl (mean negative log10 probability of words and end; null without words)."""
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = model.rows.select("text", "train", "doc_id", text.alias("_text"))
    parts = model.words.value.parts
    done = []
    for part in range(SLICES):
        sums = _dealt(model.scored(_text_blocks(model, rows, part), part), parts).mapInArrow(_combine, "_doc long, _text long, n long, s double")
        done.append(materialize(sums, "sums", tidy=True))
    # rows that repeat add to both sums alike
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    by = whole.groupBy("_doc", "_text").agg(F.sum("n").alias("n"), (F.max("n") - 1).alias("n_tokens"), F.array_sort(F.collect_list("s")).alias("s"))
    by = by.withColumn("s", F.aggregate("s", F.lit(0.0), lambda a, x: a + x))
    sums = materialize(by.select("_doc", "_text", "n_tokens", F.when(F.col("n_tokens") > 0, -F.col("s") / F.col("n")).alias("log_ppl")), "perplexities", tidy=True)
    discard(*done)
    return docs.withColumn("_hash", text).join(small(sums), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_text")), "left").drop("_hash", "_doc", "_text")


def thresholds(scored: DataFrame, labels: DataFrame, upper: float, lower: float, slack: float, min_docs: int, min_tokens: int) -> tuple[DataFrame, tuple[float, float]]:
    """low and high by language, and those of all languages together, from all reserved trusted documents."""
    own = materialize(trusted(labels).filter(fold(F.col("_id"), 5) == 0), "reserved")
    held = scored.select("doc_id", "lang", "log_ppl", "n_tokens").filter(fold(F.col("doc_id"), 5) == 0).join(small(own), F.col("doc_id") == F.col("_id"), "left_semi")
    held = held.filter(F.col("log_ppl").isNotNull() & (F.col("n_tokens") >= min_tokens))
    held = materialize(held.select("lang", "log_ppl"), "reserved")
    cuts = F.percentile_approx("log_ppl", F.lit([lower, 0.5, upper]), F.lit(10_000)).alias("q")

    def moved(q: Column) -> tuple[Column, Column]:
        return (q[0] - slack * (q[1] - q[0])).alias("low"), (q[2] + slack * (q[2] - q[1])).alias("high")

    by = held.groupBy(F.col("lang").alias("_lang")).agg(cuts, F.count("*").alias("n")).filter((F.col("n") >= min_docs) & F.col("_lang").isNotNull())
    all_ = held.agg(cuts).select(*moved(F.col("q"))).first()
    return by.select("_lang", *moved(F.col("q"))), (all_["low"], all_["high"]) if all_ and all_["low"] is not None else (-1.0, 1e9)


def quality(docs: DataFrame, labels: DataFrame, upper: float = 0.98, lower: float = 0.01, slack: float = 0.5, min_docs: int = 30, min_tokens: int = 5) -> DataFrame:
    """docs with n_tokens, log_ppl, low, high and kept; columns of these names must be shielded."""
    model = train(marked(docs, labels))
    if model is None:
        blank = F.coalesce(F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")), F.lit(0)) == 0
        none = F.lit(None).cast("double")
        return docs.select("*", F.lit(0).cast("long").alias("n_tokens"), none.alias("log_ppl"), none.alias("low"), none.alias("high"), (~blank).alias("kept"))
    scored = perplexities(docs, model)
    discard(model.pairs)
    by, (low, high) = thresholds(scored, labels, upper, lower, slack, min_docs, min_tokens)
    out = scored.join(small(materialize(by, "thresholds"), 100_000), F.col("lang") == F.col("_lang"), "left").drop("_lang")
    out = out.withColumn("low", F.coalesce("low", F.lit(low))).withColumn("high", F.coalesce("high", F.lit(high)))
    kept = F.when(F.col("log_ppl").isNull(), False).when(F.col("n_tokens") < min_tokens, True).otherwise(F.col("log_ppl").between(F.col("low"), F.col("high")))
    return out.withColumn("kept", kept)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rejected documents."""
    own, names = shielded(docs, ("doc_id", "text", "lang"))
    return restored(quality(own, labels).filter("kept"), names)
