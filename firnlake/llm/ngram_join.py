"""N-gram Jaccard join with count-vector R-trees.

A document's set is its distinct k-word shingles. Shingles are hashed into groups (a power of two, about one for every FINE
shingles, GROUPS at least); the counts by group are the document's point. The overlap of two sets is at most the sum of the
coordinate minima of their points, folded to the same groups, and for a tree node of the minima with the largest coordinates
below it. Pairs that survive this bound are verified on their exact sets.

Plan; every step hands on rows in proportion to its input, never pairs:
1. Frequent shingles and words are counted over all documents; at most MAX_FREQUENT of each are broadcast. They only set an
   order: shingles with a rare word first, frequent shingles last.
2. Texts meet by their least shingle (those of a frequent one are dealt to several tasks) and each is verified against
   recent ones of its run. This labels copies: all documents of a label are joined by links. Labels of one frequent shingle meet
   again by one set of each, and equal sets are one by their digests.
3. Two sets that link share one of their first n - ceil(t n) + 1 shingles in any common order. Documents meet in the buckets
   of these shingles, first without their points: rows with nobody of a like size and another label beside them go. Buckets of
   many rows (HOT_ROWS, or a HOT_SHARE of all) are dealt to a triangle of blocks.
4. In a bucket an R-tree over the points finds the documents with a partner of another label that survives the bound, and
   which labels these partners join. A task hands on each such document with one label of its group.
5. Joined labels make a block. Each of its documents' sets goes to it once (large blocks are a triangle of tiles), and an
   R-tree finds the pairs of labels not yet linked that survive. They are verified on exact sets; links that join labels are
   handed on and closed to components.

Defined cases: a null text, and one without words, has the empty set and links with nothing. With fewer than k words the
whole sequence is the one shingle. Rows that repeat a doc_id are one node, linked through any of their texts, and are
returned each. A null doc_id gets its n_shingles and a null component. An empty table gives an empty result. Columns
besides doc_id and text are ignored. Sets hold 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, hashed, materialize, mix64, release, restored, shielded, small
from .components import components
from .lookup import Table

GROUPS, LEAF = 64, 32
#: Shingles for each group of a point, and buckets up to this many rows that are paired without a tree.
FINE, FLAT = 4, 64
#: Frequent shingles and words that are broadcast at most.
MAX_FREQUENT = 200_000
#: A bucket is parted into blocks of about so many rows if it has so many and so large a share of all buckets' rows.
HOT_ROWS, HOT_SHARE = 50_000, 1e-5
#: Documents of one frequent least shingle that a task is dealt, about; bytes of sets that a run holds; and recent ones of a run that a document is verified against.
DEALT, RUN_BYTES, RECENT = 500, 1 << 26, 64
#: Pairs that are held against the bound at once, and shingles of a block's tile.
PAIRS, TILE = 1 << 18, 1 << 21
#: Hashes that a task counts at once, keys of buckets that it counts at once, and bytes of sets that it hands on at once.
COUNTED, KEYS, HANDED = 1 << 22, 1 << 20, 1 << 23


def shingled(texts, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text of an Arrow column its sorted distinct 64-bit shingle hashes, each one's first place in the text, and the hashes of its words."""
    odd = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    for bounds, words in hashed(texts):
        h = np.zeros(max(0, len(words) - k + 1), dtype=np.uint64)
        for j in range(k):
            h += words[j : j + len(h)] * odd[j]
        h = mix64(h)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            w = words[a:b]
            if b - a >= k:
                own = h[a : b - k + 1]
                order = np.argsort(own, kind="stable")
                s = own[order]
                new = np.concatenate([[True], s[1:] != s[:-1]])
                yield s[new], order[new], w
            elif b > a:
                yield mix64(np.array([(w * odd[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64)), np.zeros(1, dtype=np.int64), w
            else:
                yield w, np.empty(0, dtype=np.int64), w


def order_of(s: np.ndarray, first: np.ndarray, w: np.ndarray, k: int, frequent: np.ndarray, words: Table) -> np.ndarray:
    """Where a text's shingles come in the common order: frequent ones last, else by the count of the rarest word (powers of two), then by hash."""
    count = words.get(w)
    rare = np.minimum.reduce([count[np.minimum(first + j, len(w) - 1)] for j in range(min(k, len(w)))])
    order = s >> np.uint64(7) | np.log2(rare + 1).astype(np.uint64) << np.uint64(57)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        order |= (frequent[at] == s).astype(np.uint64) << np.uint64(63)
    return order


def point(s: np.ndarray) -> np.ndarray:
    """Counts by group, one byte each; 255 stands for any larger one, too."""
    groups = max(GROUPS, 1 << (max(1, len(s) // FINE) - 1).bit_length())
    c = np.bincount((s >> np.uint64(7) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(c, 255).astype(np.uint8)


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Rows of point()'s bytes as counts by fewer groups."""
    wide = np.where(points == 255, 1 << 20, points.astype(np.int32))
    return wide.reshape(len(points), points.shape[1] // groups, groups).sum(1, dtype=np.int32)


class Points:
    """The points of some rows, by their numbers of groups."""

    def __init__(self, points: list[bytes]) -> None:
        self.groups = np.array([len(p) for p in points], dtype=np.int64)
        self.at, self.of = np.zeros(len(points), dtype=np.int64), {}
        for g in np.unique(self.groups).tolist():
            rows = np.flatnonzero(self.groups == g)
            self.at[rows] = np.arange(len(rows))
            self.of[g] = np.frombuffer(b"".join(points[r] for r in rows.tolist()), dtype=np.uint8).reshape(-1, g)

    def coarse(self, rows: np.ndarray) -> np.ndarray:
        """Counts by GROUPS groups."""
        out = np.empty((len(rows), GROUPS), dtype=np.int32)
        for g, points in self.of.items():
            own = self.groups[rows] == g
            out[own] = folded(points[self.at[rows[own]]], GROUPS)
        return out

    def bound(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Summed coordinate minima of rows i with rows j, by the groups of whichever has fewer."""
        out = np.zeros(len(i), dtype=np.int64)
        kinds = self.groups[i] << 32 | self.groups[j]
        for kind in np.unique(kinds).tolist():
            gi, gj = kind >> 32, kind & (1 << 32) - 1
            g, own = min(gi, gj), np.flatnonzero(kinds == kind)
            step = max(1, (1 << 21) // max(gi, gj))
            for x in range(0, len(own), step):
                rows = own[x : x + step]
                a, b = (folded(self.of[y][self.at[z[rows]]], g) for y, z in ((gi, i), (gj, j)))
                out[rows] = np.minimum(a, b).sum(1, dtype=np.int64)
        return out


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    x, y = len(a), len(b)
    if 100 * min(x, y) < percent * max(x, y) or not x or not y:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (x + y - both)


def survives(na: np.ndarray, pa: np.ndarray, nb: np.ndarray, pb: np.ndarray, percent: int) -> np.ndarray:
    """Matrix of rows a by rows b: sizes fit, and the summed coordinate minima reach the least overlap of a link."""
    lo, hi = np.minimum.outer(na, nb), np.maximum.outer(na, nb)
    ok = 100 * lo >= percent * hi
    if ok.any():
        i, j = np.nonzero(ok)
        bound = np.minimum(pa[i], pb[j]).sum(1, dtype=np.int64)
        ok[i, j] = (100 + percent) * bound >= percent * (lo + hi)[i, j]
    return ok


def tree_pairs(n: np.ndarray, pts: np.ndarray, label: np.ndarray, percent: int, over: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one bucket with different labels that survive the bound, leaf by leaf.

    Points are packed into leaves by label (of large labels) and size. A leaf's box is its largest coordinates and its
    range of sizes; leaves are paired by the bound on their boxes, then their points. over(i, j) tells which pairs are settled by what was
    yielded before.
    """
    m = len(n)
    _, inverse, counts = np.unique(label, return_inverse=True, return_counts=True)
    large = np.where(counts[inverse] >= LEAF // 2, inverse, -1)
    order = np.lexsort((n, large))
    starts = np.arange(0, m, LEAF)
    on, op, ol = n[order], pts[order], label[order]
    box, lo, hi = (f.reduceat(x, starts, axis=0) for f, x in ((np.maximum, op), (np.minimum, on), (np.maximum, on)))
    pure_lo, pure_hi = np.minimum.reduceat(ol, starts), np.maximum.reduceat(ol, starts)
    for a in range(len(starts)):
        # the least overlap of two sizes grows with either, and so is least at the leaves' smallest sizes
        ok = (100 * hi[a:] >= percent * lo[a]) & (100 * hi[a] >= percent * lo[a:])
        ok &= ~((pure_lo[a] == pure_hi[a]) & (pure_lo[a:] == pure_hi[a:]) & (pure_lo[a:] == pure_lo[a]))
        near = np.flatnonzero(ok) + a
        bound = np.minimum(box[a], box[near]).sum(1, dtype=np.int64)
        near = near[(100 + percent) * bound >= percent * (lo[a] + lo[near])]
        rows = np.arange(starts[a], min(m, starts[a] + LEAF))
        for at in range(0, len(near), 64):
            cols = (starts[near[at : at + 64]][:, None] + np.arange(LEAF)).ravel()
            cols = cols[cols < m]
            ok = (ol[rows][:, None] != ol[cols][None, :]) & (rows[:, None] < cols[None, :])
            if over is not None:
                ok &= ~over(order[rows][:, None], order[cols][None, :])
            i, j = np.nonzero(ok)
            i, j = rows[i], cols[j]
            ok = 100 * np.minimum(on[i], on[j]) >= percent * np.maximum(on[i], on[j])
            i, j = i[ok], j[ok]
            ok = (100 + percent) * np.minimum(op[i], op[j]).sum(1, dtype=np.int64) >= percent * (on[i] + on[j])
            if ok.any():
                yield order[i[ok]], order[j[ok]]


class Labels:
    """Which of some labels are joined: root by label, always that of the whole group."""

    def __init__(self, label: np.ndarray) -> None:
        self.names, self.at = np.unique(label, return_inverse=True)
        self.root = np.arange(len(self.names))

    def same(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.root[self.at[i]] == self.root[self.at[j]]

    def join(self, i: int, j: int) -> None:
        a, b = self.root[self.at[i]], self.root[self.at[j]]
        if a != b:
            self.root[self.root == max(a, b)] = min(a, b)

    def join_all(self, i: np.ndarray, j: np.ndarray) -> None:
        pairs = np.unique(np.stack([self.root[self.at[i]], self.root[self.at[j]]], axis=1), axis=0)
        for a, b in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
            a, b = self.root[a], self.root[b]
            if a != b:
                self.root[self.root == max(a, b)] = min(a, b)


def flat_pairs(starts: np.ndarray, ends: np.ndarray, label: np.ndarray, n: np.ndarray, points: Points, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of small buckets, many buckets at once, with different labels that survive the bound."""
    lengths = ends - starts
    for size in np.unique(lengths):  # buckets of one size share the places of their pairs
        a, b = np.triu_indices(int(size), 1)
        own, step = starts[lengths == size], max(1, PAIRS // len(a))
        for at in range(0, len(own), step):
            i, j = ((own[at : at + step, None] + x).ravel() for x in (a, b))
            ok = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[ok], j[ok]
            ok = (100 + percent) * points.bound(i, j) >= percent * (n[i] + n[j])
            yield i[ok], j[ok]


def summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of several (hashes, counts), and the sums of their counts."""
    h, c = (np.concatenate(x) for x in zip(*counts, strict=True))
    h, at = np.unique(h, return_inverse=True)
    return h, np.bincount(at, weights=c, minlength=len(h)).astype(np.int64)


def frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, Table]:
    """Hashes (sorted) and document counts of shingles that runs of COUNTED show to be frequent, and a table of the counts
    of words that are: at most MAX_FREQUENT of each."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles: list[np.ndarray] = []
        words: list[tuple[np.ndarray, np.ndarray]] = []
        rows = size = 0

        def told() -> Iterator[pa.RecordBatch]:
            h = np.concatenate(shingles)
            shingles.clear()
            h.sort()
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
            pairs = ((h[starts], np.diff(np.append(starts, len(h)))), summed(words))
            words.clear()
            for kind, (least, (h, c)) in enumerate(zip((max(4, rows // 250), 4), pairs, strict=True)):
                much = c >= least
                yield pa.RecordBatch.from_arrays([pa.array(np.full(much.sum(), kind, dtype=np.int32)), pa.array(h[much].view(np.int64)), pa.array(c[much], pa.int64())], ["kind", "h", "c"])

        release()  # of what tasks of the operators before left in this worker
        for b in batches:
            held: list[np.ndarray] = []
            for s, _, w in shingled(b.column(0), k):
                shingles.append(s)
                held.append(w.copy())
                size += len(s)
                rows += 1
                if size >= COUNTED:
                    words.append(np.unique(np.concatenate(held), return_counts=True))
                    held.clear()
                    yield from told()
                    rows = size = 0
            if held:
                words.append(np.unique(np.concatenate(held), return_counts=True))
        if rows:
            yield from told()
        release()

    counts = docs.select("text").mapInArrow(count, "kind int, h long, c long").groupBy("kind", "h").agg(F.sum("c").alias("c"))
    counts = kept = materialize(counts.filter("c >= 100 OR kind = 1"), "frequent", tidy=True)
    out = []
    for kind in (0, 1):
        t = counts.filter(F.col("kind") == kind).orderBy(F.desc("c"), "h").limit(MAX_FREQUENT).select("h", "c").toArrow()
        h, c = t.column(0).to_numpy().view(np.uint64), t.column(1).to_numpy()
        order = np.argsort(h)
        out.append((h[order], c[order]))
    discard(kept)
    return *out[0], Table(*out[1])


def label_run(sets: list[np.ndarray], percent: int) -> tuple[list[int], list[bool]]:
    """The place of the first set that each set of a run is joined with, and whether it is the first of its kind there.

    Each set is verified against the RECENT ones before it whose points survive the bound; links join sets.
    """
    import xxhash

    root: list[int] = list(range(len(sets)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    seen: dict[bytes, int] = {}
    window, sizes, pts = np.zeros(RECENT, dtype=np.int64), np.zeros(RECENT, dtype=np.int64), np.zeros((RECENT, GROUPS), dtype=np.int32)
    first, used = [], 0
    for x, s in enumerate(sets):
        own = xxhash.xxh3_128_digest(s.tobytes())
        first.append(own not in seen)
        if not first[-1]:
            root[x] = top(seen[own])
            continue
        seen[own], n = x, len(s)
        wide = folded(point(s)[None], GROUPS)[0]
        k = min(used, RECENT)
        if k:
            near = (100 * np.minimum(sizes[:k], n) >= percent * np.maximum(sizes[:k], n)) & ((100 + percent) * np.minimum(pts[:k], wide).sum(1, dtype=np.int64) >= percent * (sizes[:k] + n))
            for y in window[:k][near].tolist():
                if top(x) != top(y) and links(s, sets[y], percent):
                    root[max(top(x), top(y))] = min(top(x), top(y))
        at = used % RECENT
        window[at], sizes[at], pts[at] = x, n, wide
        used += 1
    return [top(x) for x in range(len(sets))], first


def members(docs: DataFrame, k: int, percent: int, frequent: np.ndarray, counts: np.ndarray, words: Table) -> DataFrame:
    """Step 2: row (a number of its own), doc_id, n, label; for the first of each set in its run its prefix (bytes of 64-bit shingles), point and
    digest; for one document of each label of a run that is a part of several, first (the run's shingle) and its set."""
    import pyarrow as pa

    spark = docs.sparkSession
    parts, common = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.broadcast((frequent, counts, words))  # of bounded size

    def deals(first: np.ndarray) -> np.ndarray:
        """Tasks for each least shingle: a frequent one has a task for every DEALT of its documents."""
        frequent, counts, _ = common.value
        if not len(frequent):
            return np.ones(len(first), dtype=np.uint64)
        spot = np.minimum(np.searchsorted(frequent, first), len(frequent) - 1)
        return np.where(frequent[spot] == first, counts[spot] // DEALT + 1, 1).astype(np.uint64)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(s[0] if len(s) else 0, len(s)) for s, _, _ in shingled(b.column(1), k)]
            first = np.array([x for x, _ in found], dtype=np.uint64)
            ids = np.array([x or 0 for x in b.column(0).to_pylist()], dtype=np.int64).view(np.uint64)
            deal = first + mix64(ids) % deals(first)
            empty = np.array([not n for _, n in found], dtype=bool)
            deal[empty] = np.flatnonzero(empty).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(first.view(np.int64)), pa.array(mix64(deal).view(np.int64)), pa.array([n for _, n in found], pa.int32())], ["doc_id", "text", "first", "deal", "n"])
        release()

    keyed = docs.select("doc_id", "text").mapInArrow(least, "doc_id long, text string, first long, deal long, n int")
    dealt = keyed.repartition(parts, "deal").sortWithinPartitions("first", "n", "doc_id").select("doc_id", "text", "first")
    names = ["row", "doc_id", "n", "label", "prefix", "point", "digest", "first", "set"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        frequent, _, words = common.value
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
        row = TaskContext.get().partitionId() << 33

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal row
            ids = range(row, row + len(rows))
            row += len(rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, *zip(*rows, strict=True)), kinds, strict=True)], names)

        def run(first: int, rows: list[tuple], parted: bool) -> list[tuple]:
            own = [(doc, s) for doc, s, _ in rows if doc is not None and len(s)]
            tops, firsts = label_run([s for _, s in own], percent) if len(own) > 1 else ([0], [True])
            out, at = [], 0
            for doc, s, prefix in rows:
                if doc is None or not len(s):
                    out.append((doc, len(s), doc, None, None, None, None, None))
                    continue
                new, head = firsts[at], parted and tops[at] == at
                kept = (prefix, point(s).tobytes(), xxhash.xxh3_128_digest(s.tobytes())) if new else (None,) * 3
                out.append((doc, len(s), own[tops[at]][0], *kept, *((first, s.tobytes()) if head else (None, None))))
                at += 1
            return out

        def documents() -> Iterator[tuple]:
            for b in batches:
                for doc, first, (s, places, w) in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), shingled(b.column(1), k), strict=True):
                    prefix = None
                    if len(s):
                        need = len(s) + (-percent * len(s)) // 100 + 1  # n - ceil(t n) + 1
                        prefix = s[np.argpartition(order_of(s, places, w, k, frequent, words), need - 1)[:need]].tobytes()
                    yield first, (doc, s, prefix)

        out: list[tuple] = []
        weight = 0
        for first, rows in groupby(documents(), key=lambda x: x[0]):
            parted = bool(deals(np.array([first], dtype=np.int64).view(np.uint64))[0] > 1)
            held, held_bytes = [], 0
            for _, one in rows:
                held.append(one)
                held_bytes += one[1].nbytes
                if len(held) >= 4 * DEALT or held_bytes >= RUN_BYTES:
                    parted = True
                    yield batch(run(first, held, parted))
                    held, held_bytes = [], 0
            if held:
                out += run(first, held, parted)
                weight += held_bytes
                if len(out) >= 1000 or weight >= RUN_BYTES:
                    yield batch(out)
                    out, weight = [], 0
        if out:
            yield batch(out)
        release()

    return dealt.mapInArrow(label, "row long, doc_id long, n int, label long, prefix binary, point binary, digest binary, first long, set binary")


def joined_heads(found: DataFrame, percent: int, rounds: int = 3) -> DataFrame:
    """Links (a, b) between labels whose runs are parts of one least shingle's, by one set of each label.

    Those of one shingle are dealt to tasks of DEALT again, and what is left of each to the next round.
    """
    import pyarrow as pa

    spark = found.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = materialize(found.filter("first IS NOT NULL").select("first", F.col("label").alias("a"), "set"), "heads")
    out = None
    for _ in range(rounds):
        tasks = materialize(heads.groupBy("first").agg(F.count("*").alias("n")).withColumn("tasks", (F.col("n") / F.lit(DEALT)).cast("long") + 1).select(F.col("first").alias("_first"), "n", "tasks"), "tasks")
        dealt = heads.join(small(tasks.filter("n > 1")), F.col("first") == F.col("_first")).withColumn("deal", F.pmod(F.xxhash64("a"), F.col("tasks")))
        dealt = dealt.repartition(parts, "first", "deal").sortWithinPartitions("first", "deal", F.length("set"), "a").select("first", "deal", "a", "set")

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for b in batches:
                    yield from zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)

            for (first, _), group in groupby(rows(), key=lambda x: x[:2]):
                held: list[tuple] = []

                def run(held: list[tuple], first: int = first) -> pa.RecordBatch:
                    tops, _ = label_run([np.frombuffer(s, dtype=np.uint64) for _, _, _, s in held], percent)
                    cols = ([first] * len(held), [x[2] for x in held], [held[t][2] for t in tops], [x[3] if t == at else None for at, (x, t) in enumerate(zip(held, tops, strict=True))])
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["first", "a", "b", "set"])

                weight = 0
                for x in group:
                    held.append(x)
                    weight += len(x[3])
                    if len(held) >= 4 * DEALT or weight >= RUN_BYTES:
                        yield run(held)
                        held, weight = [], 0
                if held:
                    yield run(held)
            release()

        done = materialize(dealt.mapInArrow(join, "first long, a long, b long, set binary"), "heads", tidy=True)
        links_ = done.filter("a <> b").select("a", "b")
        out = links_ if out is None else out.unionByName(links_)
        heads = done.filter("set IS NOT NULL").select("first", "a", "set")
        if not tasks.filter("tasks > 1").limit(1).count():
            break
    return out


def representatives(found: DataFrame, roots: DataFrame) -> DataFrame:
    """row and label (its root) of one document of each distinct set."""
    one = found.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("row", "label")).alias("r")).select("r.*")
    return one.join(small(roots), F.col("label") == F.col("node"), "left").select("row", F.coalesce("root", "label").alias("label"))


def hot_keys(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Prefix shingles (sorted) with HOT_ROWS rows or more and a HOT_SHARE of all, hence at most 1 / HOT_SHARE of them, and their blocks.

    Counts under four in a run of KEYS are left out, so a share near the least may be missed and its bucket stay whole.
    """
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = size = 0
        held: list[bytes] = []

        def told() -> pa.RecordBatch:
            h, c = np.unique(np.frombuffer(b"".join(held), dtype=np.int64), return_counts=True)
            held.clear()
            much = c >= 4
            return pa.RecordBatch.from_arrays([pa.array(h[much]), pa.array(c[much], pa.int64())], ["h", "c"])

        for b in batches:
            for prefix in b.column(0).to_pylist():
                held.append(prefix)
                size += len(prefix) // 8
                if size >= KEYS:
                    yield told()
                    total, size = total + size, 0
        if held:
            yield told()
            total += size
        release()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["h", "c"])

    counts = materialize(rows.select("prefix").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "keys", tidy=True)
    total = counts.filter("h IS NULL").first()
    least = max(HOT_ROWS, HOT_SHARE * (total["c"] if total else 0))
    t = counts.filter((F.col("c") >= least) & F.col("h").isNotNull()).toArrow()
    discard(counts)
    h, c = t.column(0).to_numpy().view(np.uint64), t.column(1).to_numpy()
    order = np.argsort(h)
    return h[order], (c[order] // int(least) + 1).astype(np.int64)


def buckets(batches: Iterator, columns: int) -> Iterator[list]:
    """The columns (key first, in runs) of Arrow batches, cut between keys."""
    import pyarrow as pa

    held: list = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(0).to_numpy()
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if last or (held and held[-1].column(0)[-1].as_py() != int(keys[0])):
            yield pa.Table.from_batches([*held, b.slice(0, last)]).combine_chunks().columns[:columns]
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().columns[:columns]


def meetings(rows: DataFrame, percent: int, hot: np.ndarray) -> DataFrame:
    """Step 3 without points: key and row of prefix shingles where a row has one of a like size beside it and labels differ, or that are hot."""
    import pyarrow as pa

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, label, n = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2))
            prefixes = [np.frombuffer(x, dtype=np.uint64) for x in b.column(3).to_pylist()]
            sizes = np.cumsum([len(p) for p in prefixes])
            at = 0
            while at < len(row):
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + (1 << 18), side="right")))
                keys, who = np.concatenate(prefixes[at:end]), np.repeat(np.arange(at, end), [len(p) for p in prefixes[at:end]])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *(pa.array(x[who]) for x in (row, label, n))], ["key", "row", "label", "n"])
                at = end

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select("row", "label", "n", "prefix").mapInArrow(emit, "key long, row long, label long, n long")
    if len(hot):
        known = F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in hot.view(np.int64).tolist()], "_hot long"))  # at most 1 / HOT_SHARE
        dealt = keyed.join(known, F.col("key") == F.col("_hot"), "left_anti")
        hot_rows = keyed.join(known, F.col("key") == F.col("_hot"), "left_semi").select("key", "row")
    else:
        dealt, hot_rows = keyed, None

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in buckets(batches, 4):
            key, row, label, n = (c.to_numpy() for c in cols)
            if len(key) < 2:
                continue
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            mixed = np.minimum.reduceat(label, cut) != np.maximum.reduceat(label, cut)
            near = (key[1:] == key[:-1]) & (100 * n[:-1] >= percent * n[1:])  # in a key's run by size
            ok = np.repeat(mixed, np.diff(np.append(cut, len(key)))) & (np.append(near, False) | np.insert(near, 0, False))
            yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(row[ok])], ["key", "row"])

    out = dealt.repartition(parts, "key").sortWithinPartitions("key", "n").mapInArrow(meet, "key long, row long")
    return out if hot_rows is None else out.unionByName(hot_rows)


def candidates(met: DataFrame, rows: DataFrame, percent: int, hot: np.ndarray, blocks: np.ndarray) -> DataFrame:
    """Step 4: doc_id and label of documents with a partner of another label that survives the bound in some bucket, and top: a label of its group in that task."""
    import pyarrow as pa

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(F.col("row").alias("_row"), "doc_id", "label", "n", "point")
    keyed = met.join(rows, F.col("row") == F.col("_row")).select("key", "doc_id", "label", "n", "point")
    if len(hot):
        known = rows.sparkSession.createDataFrame(list(zip(hot.view(np.int64).tolist(), blocks.tolist(), strict=True)), "_hot long, g long")  # at most 1 / HOT_SHARE
        keyed = keyed.join(F.broadcast(known), F.col("key") == F.col("_hot"), "left")
        mine = F.pmod(F.xxhash64("doc_id", "n"), F.col("g"))
        # block row and column of a document in the triangle of blocks
        keyed = keyed.withColumn("o", F.explode(F.when(F.col("g").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("g") - 1))))
        tile = F.xxhash64("key", F.least(mine, "o"), F.greatest(mine, "o"))
        keyed = keyed.select(F.when(F.col("g").isNull(), F.col("key")).otherwise(tile).alias("key"), "doc_id", "label", "n", "point")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top_of: dict[int, int] = {}
        marked: dict[int, int] = {}

        def top(x: int) -> int:
            path = []
            while (y := top_of.get(x, x)) != x:
                path.append(x)
                x = y
            for y in path:
                top_of[y] = x
            return x

        def told() -> pa.RecordBatch:
            cols = (list(marked), list(marked.values()), [top(x) for x in marked.values()])
            marked.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "label", "top"])

        def take(doc: np.ndarray, label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
            if not len(i):
                return
            both = np.unique(np.concatenate([i, j]))
            marked.update(zip(doc[both].tolist(), label[both].tolist(), strict=True))
            pairs = np.unique(np.stack([label[i], label[j]], axis=1), axis=0)
            for a, b in pairs.tolist():
                x, y = top(a), top(b)
                if x != y:
                    top_of[max(x, y)] = min(x, y)

        for cols in buckets(batches, 5):
            key, doc, label, n = (c.to_numpy().astype(np.int64) for c in cols[:4])
            points = Points(cols[4].to_pylist())
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            ends = np.append(cut[1:], len(key))
            mixed = np.minimum.reduceat(label, cut) != np.maximum.reduceat(label, cut)
            flat, large = mixed & (ends - cut <= FLAT), mixed & (ends - cut > FLAT)
            for i, j in flat_pairs(cut[flat], ends[flat], label, n, points, percent):
                take(doc, label, i, j)
            for x, y in zip(cut[large].tolist(), ends[large].tolist(), strict=True):
                own, here = np.arange(x, y), Labels(label[x:y])
                seen = np.zeros(y - x, dtype=bool)

                def over(i: np.ndarray, j: np.ndarray, here: Labels = here, seen: np.ndarray = seen) -> np.ndarray:
                    return seen[i] & seen[j] & here.same(i, j)

                for i, j in tree_pairs(n[x:y], points.coarse(own), label[x:y], percent, over):
                    ok = (100 + percent) * points.bound(i + x, j + x) >= percent * (n[i + x] + n[j + x])
                    i, j = i[ok], j[ok]
                    if len(i):
                        seen[i] = seen[j] = True
                        here.join_all(i, j)
                        take(doc, label, i + x, j + x)
            if len(marked) >= 1_000_000:
                yield told()
        yield told()
        release()

    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(search, "doc_id long, label long, top long").distinct()


def linked_labels(label: np.ndarray, part: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of labels that links of documents of two parts (or of one, if there is only one) join: a spanning forest of them."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    groups, out = Labels(label), []
    pts = np.concatenate([folded(point(s)[None], GROUPS) for s in sets])
    parts = len(np.unique(part)) > 1

    def over(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        same = groups.same(i, j)
        return same | (part[i] == part[j]) if parts else same

    for i, j in tree_pairs(n, pts, label, percent, over):
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for a, b in zip(*np.unique(i, return_index=True), strict=True):
            others = j[b : np.searchsorted(i, a, side="right")]
            for at in range(0, len(others), 16):
                some = others[at : at + 16]
                some = some[~groups.same(np.full(len(some), a), some)]
                if not len(some):
                    continue
                # overlaps of a's set with several at once
                joined, own = np.concatenate([sets[x] for x in some.tolist()]), sets[a]
                hit = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
                both = np.add.reduceat(hit.astype(np.int64), np.cumsum([0, *n[some[:-1]]]))
                for x in some[100 * both >= percent * (n[a] + n[some] - both)].tolist():
                    if not groups.same(a, x):
                        groups.join(a, x)
                        out.append((int(label[a]), int(label[x])))
    return out


def verify(docs: DataFrame, blocks: DataFrame, k: int, percent: int) -> DataFrame:
    """Step 5: links (a, b) between labels of documents (doc_id, label, block, tiles) of one block, on exact sets."""
    import pyarrow as pa

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", "text").join(small(blocks.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
    texts = texts.select("doc_id", "label", "block", "tiles", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tile", "label", "part", "s"]
        for b in batches:
            rows: list[tuple] = []
            weight = 0
            for doc, label, block, tiles, (s, _, _) in zip(*(b.column(i).to_pylist() for i in range(4)), shingled(b.column(4), k), strict=True):
                if not len(s):
                    continue
                mine = int(mix64(np.array([doc, len(s)], dtype=np.int64).view(np.uint64))[0]) % tiles
                for o in range(tiles):  # a document meets every other part of its block once
                    tile = mix64(np.array([block], dtype=np.int64).view(np.uint64)) + np.uint64(min(mine, o) * tiles + max(mine, o))
                    rows.append((int(mix64(tile).view(np.int64)[0]), label, mine, s.tobytes()))
                    weight += s.nbytes
                    if weight >= HANDED:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)
                        rows, weight = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)
        release()

    dealt = texts.mapInArrow(sets, "tile long, label long, part long, s binary").repartition(parts, "tile").sortWithinPartitions("tile")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(held: list[tuple]) -> pa.RecordBatch:
            found = linked_labels(np.array([x[1] for x in held]), np.array([x[2] for x in held]), [np.frombuffer(x[3], dtype=np.uint64) for x in held], percent)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        rows = (x for b in batches for x in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        for _, group in groupby(rows, key=lambda x: x[0]):
            yield told(list(group))
        release()

    return dealt.mapInArrow(hold, "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links, itself included) of every row of docs.

    Two documents link when 100 x intersection >= percent x union of their sets of k-word shingles.
    """
    frequent, counts, words = frequent_shingles(docs, k)
    found = materialize(members(docs, k, percent, frequent, counts, words), "members", tidy=True)
    # labels of one document's rows, of equal sets, and of one least shingle's runs
    own = found.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("label").alias("b"))
    rows_ = own.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("x")).filter("m <> x").select(F.col("a").alias("_a"), "m")
    edges = own.join(small(materialize(rows_, "several")), F.col("a") == F.col("_a")).select("m", "b").toDF("a", "b")
    equal = found.filter("digest IS NOT NULL").select("digest", F.col("label").alias("b"))
    least = equal.groupBy(F.col("digest").alias("_d")).agg(F.min("b").alias("a"), F.max("b").alias("x")).filter("a <> x").select("_d", "a")
    edges = edges.unionByName(equal.join(small(materialize(least, "equal")), F.col("digest") == F.col("_d")).select("a", "b"))
    edges = materialize(edges.unionByName(joined_heads(found, percent)), "edges")
    roots = materialize(components(edges), "roots")

    alive_ = materialize(representatives(found, roots), "alive")
    alive = small(alive_)
    rows = found.select(F.col("row").alias("_r"), "doc_id", "n", "prefix", "point").join(alive, F.col("_r") == F.col("row")).drop("_r")
    hot, blocks = hot_keys(rows)
    met = materialize(meetings(rows, percent, hot), "meetings", tidy=True)
    near = materialize(candidates(small(met, 300_000), rows, percent, hot, blocks), "candidates", tidy=True)
    discard(met, alive_)
    groups = materialize(components(near.select(F.col("label").alias("a"), F.col("top").alias("b"))), "groups")
    sizes = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_doc")).agg(F.sum("n").alias("n"))
    members_ = near.select("doc_id", "label").distinct().join(small(groups), F.col("label") == F.col("node"), "left")
    members_ = members_.select("doc_id", "label", F.coalesce("root", "label").alias("block")).join(sizes, F.col("doc_id") == F.col("_doc")).drop("_doc")
    members_ = materialize(members_, "blocks")
    tiles = members_.groupBy(F.col("block").alias("_block")).agg((F.sum("n") / F.lit(TILE)).cast("long").alias("t"))
    tiled = members_.join(small(materialize(tiles, "tiles")), F.col("block") == F.col("_block")).select("doc_id", "label", "block", (F.col("t") + 1).alias("tiles"))
    tiled = materialize(tiled, "tiled")
    links_ = materialize(verify(docs, tiled, k, percent), "links", tidy=True)

    before, edges = edges, materialize(edges.unionByName(links_), "edges")
    discard(near, groups, members_, tiled, links_, before)
    roots = small(materialize(components(edges), "roots"))
    named = found.select("doc_id", "n", "label").join(roots, F.col("label") == F.col("node"), "left").select("doc_id", "n", F.coalesce("root", "label").alias("root"))
    least = materialize(named.groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("least")), "least")
    out = named.join(small(least), F.col("root") == F.col("_root"), "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component: that of the least doc_id, its least row (by text, then the rest as JSON) if that repeats. Null doc_ids all stay."""
    found = jaccard_components(docs, k, percent).filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_n"))
    found = materialize(found, "kept")
    own, names = shielded(docs, ("doc_id", "text"))
    kept = own.join(small(found), F.col("doc_id") == F.col("_id"))
    once, often = kept.filter("_n = 1").drop("_id", "_n"), kept.filter("_n > 1").drop("_id", "_n")
    rest = [c for c in names if c not in ("doc_id", "text")]
    least = F.min_by(F.struct("text", *rest), F.struct("text", F.to_json(F.struct(F.lit(0), *rest))))
    least = often.groupBy("doc_id").agg(least.alias("_row")).select("doc_id", "_row.*")
    return restored(once.unionByName(least).unionByName(own.filter("doc_id IS NULL")), names)
