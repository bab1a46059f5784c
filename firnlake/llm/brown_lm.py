"""Perplexity under a Brown class-based bigram model.

Every word that training saw more than once has a class of its clustering. The CORE likeliest found the classes by exchange:
each moves to the class that raises the likelihood of the class bigrams most, in passes over all of them. Then each other word joins
the class that raises it most, by the counts of the classes and shapes before and after it, in tasks by word. Words seen once or
never belong to one of SHAPES classes by their length and last letter. A token's probability is that of its class after the
class before, smoothed towards the class's own frequency, times the word's share of its class. Shapes discount every count by a
constant; what this frees is for the words that training did not see, of which as many are taken to exist as it saw (one
more), each as likely.

Counts and classes of words stay distributed tables; tasks hold those of the HELD likeliest, all others are joined by word with
the distinct words of each document. To the driver go the CORE counts, the bigram counts between CORE words and shapes, at
most (CORE + SHAPES + 2)^2 rows, and those between classes.

Defined cases: a null text counts as empty and has the end alone. A null doc_id has a null fold, is learned from and is
not held out. Without training rows both scores are 0 for the end and log10(1) for any token. Rows that repeat are
learned from and scored each. An empty table gives an empty result. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, framed, hashed, materialize
from .lookup import Table

#: Words that found the classes; words whose counts and classes the tasks hold; shape classes.
CORE, HELD, SHAPES = 1_000, 100_000, 32
END = np.uint64(0xE0D << 5)


def tokens_of(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bounds, hashes) of the words and the ends of some rows of an Arrow column of texts at a time; a word's shape is in the lowest five bits."""
    for bounds, words in hashed(texts, shaped=True):
        yield framed(bounds, words, END, 0, END)


def before(bounds: np.ndarray, values: np.ndarray, start: int) -> np.ndarray:
    """The value before each of some rows' values, start before a row's first."""
    out = np.empty_like(values)
    out[1:], out[bounds[:-1]] = values[:-1], start
    return out


def word_counts(rows: DataFrame) -> DataFrame:
    """h and c of every distinct token of the rows' texts."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                h, c = np.unique(np.concatenate([h for _, h in tokens_of(b.column(0))]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c, pa.int64())], ["h", "c"])

    return rows.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def unit_ids(core: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A token's unit: its place among the CORE words (sorted hashes), or len(core) and its shape."""
    if not len(core):
        return (h & np.uint64(31)).astype(np.int64)
    at = np.minimum(np.searchsorted(core, h), len(core) - 1)
    return np.where(core[at] == h, at, len(core) + (h & np.uint64(31)).astype(np.int64))


def unit_bigrams(rows: DataFrame, core: np.ndarray) -> np.ndarray:
    """Matrix of counts of unit after unit; the last unit is the start."""
    import pyarrow as pa

    size = len(core) + SHAPES + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size * size, dtype=np.int64)
        for b in batches:
            for bounds, h in tokens_of(b.column(0)):
                u = unit_ids(core, h)
                out += np.bincount(before(bounds, u, size - 1) * size + u, minlength=size * size)
        p = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(out[p])], ["p", "c"])

    found = rows.select("text").mapInArrow(count, "p long, c long").groupBy("p").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(size * size)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def exchange(bigrams: np.ndarray, n_core: int, classes: int, passes: int = 8) -> np.ndarray:
    """Class of each unit: CORE words 0 to classes - 1, by exchange; each shape, and the start, a class of its own."""
    units = len(bigrams)
    of = np.concatenate([np.zeros(n_core, dtype=np.int64), classes + np.arange(units - n_core)])
    # the likeliest words found classes, the others join by rank
    of[np.argsort(-bigrams[:, :n_core].sum(0), kind="stable")] = np.arange(n_core) % classes
    k = classes + units - n_core
    left, right = np.zeros((units, k)), np.zeros((k, units))  # counts of unit then class, and class then unit
    np.add.at(left.T, of, bigrams.T)
    np.add.at(right, of, bigrams)
    both = np.zeros((k, k))
    np.add.at(both, of, left)
    for _ in range(passes):
        moved = 0
        for w in range(n_core):
            a, out, inn, own = of[w], left[w].copy(), right[:, w].copy(), bigrams[w, w]
            out[a] -= own
            inn[a] -= own
            # take w out of its class
            both[a] -= out
            both[:, a] -= inn
            both[a, a] -= own
            rows, cols = both[:classes], both[:, :classes]
            # what adding w to each class changes: its row, its column and its own corner
            corner = np.arange(classes)
            r, c = rows + out, cols + inn[:, None]
            gain = (_xlogx(r) - _xlogx(rows)).sum(1) + (_xlogx(c) - _xlogx(cols)).sum(0)
            gain -= _xlogx(r[corner, corner]) - _xlogx(rows[corner, corner]) + _xlogx(c[corner, corner]) - _xlogx(cols[corner, corner])
            gain += _xlogx(both[corner, corner] + out[corner] + inn[corner] + own) - _xlogx(both[corner, corner])
            # the totals of each class: w follows and is followed by others wherever it goes
            before, after = rows.sum(1) + inn[:classes], cols.sum(0) + out[:classes]
            gain -= _xlogx(before + out.sum() + own) - _xlogx(before) + _xlogx(after + inn.sum() + own) - _xlogx(after)
            b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-9 else int(a)
            both[b] += out
            both[:, b] += inn
            both[b, b] += own
            if b != a:
                moved += 1
                of[w] = b
                left[:, a] -= bigrams[:, w]
                left[:, b] += bigrams[:, w]
                right[a] -= bigrams[w]
                right[b] += bigrams[w]
        if not moved:
            break
    return of


def contexts(rows: DataFrame, core: np.ndarray, of: np.ndarray) -> DataFrame:
    """h, ctx and n of words outside the core: ctx is the class before, or that after plus the number of classes."""
    import pyarrow as pa

    k = int(of.max()) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.uint64((2 * k).bit_length())
        for b in batches:
            hs, cs = [], []
            for bounds, h in tokens_of(b.column(0)):
                u = unit_ids(core, h)
                cls, mine = of[u], np.flatnonzero(u >= len(core))
                last = np.zeros(len(h), dtype=bool)
                last[bounds[1:] - 1] = True
                inner = mine[~last[mine]]  # nothing follows the end
                hs += [h[mine], h[inner]]
                cs += [before(bounds, cls, k - 1)[mine], cls[inner + 1] + k]
            if hs:
                h, c = np.concatenate(hs), np.concatenate(cs)
                # a word's contexts come together, but for words with the same lower bits, which assigned() puts right
                order = np.argsort(h << bits | c.astype(np.uint64))
                h, c = h[order], c[order]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])[: len(h)])
                n = np.diff(np.append(first, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(c[first], pa.int32()), pa.array(n, pa.int64())], ["h", "ctx", "n"])

    return rows.select("text").mapInArrow(count, "h long, ctx int, n long")


def best_classes(both: np.ndarray, classes: int, starts: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class that each word raises the likelihood of the class bigrams in most; a word's contexts begin at starts."""
    k = len(both)
    cells = np.concatenate([both[:, :classes], both[:classes].T])  # by context: counts of each class after it, and before it
    gain = np.empty((len(starts), classes))
    ends = np.append(starts[1:], len(ctx))
    step = 2_000
    for at in range(0, len(starts), step):
        x, y = starts[at], ends[min(at + step, len(starts)) - 1]
        old = cells[ctx[x:y]]
        gain[at : at + step] = np.add.reduceat(_xlogx(old + n[x:y, None]) - _xlogx(old), starts[at : at + step] - x)
    for t, mine in ((both[:classes].sum(1), ctx >= k), (both[:, :classes].sum(0), ctx < k)):
        gain -= _xlogx(t + np.add.reduceat(np.where(mine, n, 0), starts)[:, None]) - _xlogx(t)
    return gain.argmax(1)


def assigned(rows: DataFrame, core: np.ndarray, of: np.ndarray, bigrams: np.ndarray, classes: int) -> DataFrame:
    """h and cls of the words outside the core that the rows have more than once."""
    import pyarrow as pa

    k = int(of.max()) + 1
    both = np.zeros((k, k))
    np.add.at(both, (of[:, None], of[None, :]), bigrams)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)]

        def done(h: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])]))
            h, ctx, n = h[new], ctx[new], np.add.reduceat(n, new)  # several tasks may have counted a context
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            total = np.add.reduceat(np.where(ctx < k, n, 0), starts)
            cls = best_classes(both, classes, starts, ctx, n)
            return pa.RecordBatch.from_arrays([pa.array(h[starts][total > 1]), pa.array(cls[total > 1], pa.int32())], ["h", "cls"])

        for b in batches:  # a word's rows follow each other and may go on in the next batch
            held = [np.concatenate([x, b.column(i).to_numpy().astype(np.int64)]) for i, x in enumerate(held)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut:
                yield done(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield done(*held)

    dealt = contexts(rows, core, of).repartition("h").sortWithinPartitions("h", "ctx")
    return dealt.mapInArrow(assign, "h long, cls int")


@dataclass
class Model:
    """core: sorted hashes of the words that found the classes; of: class of each unit; first_shape: number of clusters; steps: log10 of class
    transitions (set once all words have classes); core_share: log10 of each core word's share of its class; class_total and class_types: tokens and words
    by class; held: counts and classes of likely words; n and v: of training tokens."""

    core: np.ndarray
    of: np.ndarray
    first_shape: int
    steps: np.ndarray
    core_share: np.ndarray
    class_total: np.ndarray
    class_types: np.ndarray
    held: Table
    n: int
    v: int
    discount: float


def transitions(joint: np.ndarray, smooth: float) -> np.ndarray:
    """log10 of the chance of class after class."""
    to = joint.sum(0)
    to[:-1] += 0.5  # nothing follows into the start
    share = to / to.sum()
    with np.errstate(divide="ignore"):
        return np.log10((joint + smooth * share) / (joint.sum(1, keepdims=True) + smooth))


def fit(rows: DataFrame, classes: int = 64, smooth: float = 5.0) -> tuple[Model, DataFrame]:
    """The model of the rows' texts, its transitions those of the core and shapes, and the table (h, c, cls) of all their words."""
    counts = materialize(word_counts(rows), "counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    best = counts.orderBy(F.desc("c"), "h").limit(CORE).toArrow()
    h, c = best.column(0).to_numpy().view(np.uint64), best.column(1).to_numpy()
    order = np.argsort(h)
    core, core_c = h[order], c[order].astype(float)
    bigrams = unit_bigrams(rows, core)
    classes = max(1, min(classes, len(core)))
    of = exchange(bigrams, len(core), classes)
    k = int(of.max()) + 1
    joint = np.zeros((k, k))
    np.add.at(joint, (of[:, None], of[None, :]), bigrams)
    # classes of all words: of the core by exchange, of words seen again by their contexts, of the rest by shape
    spark = rows.sparkSession
    known = spark.createDataFrame([(int(x), int(y)) for x, y in zip(core.view(np.int64), of, strict=False)], "h long, cls int").unionByName(assigned(rows, core, of, bigrams, classes))
    shape = (F.lit(classes) + F.col("h").bitwiseAND(31)).cast("int")
    words = materialize(counts.join(known, "h", "left").select("h", "c", F.coalesce("cls", shape).alias("cls")), "words")
    sums = np.zeros((2, k))
    for r in words.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # at most one for each class
        sums[:, r["cls"]] = r["n"], r["v"]
    likely = words.orderBy(F.desc("c"), "h").limit(HELD).toArrow()
    held = Table(likely.column(0).to_numpy().view(np.uint64), likely.column(1).to_numpy(), likely.column(2).to_numpy())
    once = {r["c"]: r["n"] for r in counts.filter("c <= 2").groupBy("c").agg(F.count("*").alias("n")).collect()}  # at most 2 rows
    discount = min(0.9, max(0.1, once.get(1, 0) / max(1, once.get(1, 0) + 2 * once.get(2, 0))))  # the usual estimate of absolute discounting
    core_share = np.log10(core_c / sums[0][of[: len(core)]]) if len(core) else np.empty(0)
    return Model(core, of, classes, transitions(joint, smooth), core_share, sums[0], sums[1], held, int(total["n"] or 0), int(total["v"]), discount), words


def class_bigrams(classed: DataFrame, k: int) -> np.ndarray:
    """Matrix of counts of class after class; the last class is the start."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(k * k, dtype=np.int64)
        for b in batches:
            pairs = [np.concatenate([[k - 1], cls[:-1]]) * k + cls for cls in sequences(b)]
            if pairs:
                out += np.bincount(np.concatenate(pairs), minlength=k * k)
        p = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(out[p])], ["p", "c"])

    found = classed.select("seq", "at", "cls").mapInArrow(count, "p long, c long").groupBy("p").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(k * k)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out.reshape(k, k)


def packed(places: np.ndarray) -> bytes:
    """Whole numbers of 16 bits, or else 32, with their width before them."""
    width = 2 if not len(places) or (places.min() >= -(1 << 15) and places.max() < 1 << 15) else 4
    return bytes([width]) + zlib.compress(places.astype(f"<i{width}").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), dtype=f"<i{data[0]}")


def sequences(b) -> Iterator[np.ndarray]:
    """The classes of each row's tokens, from seq (a class, or -1 less the place of a far word), and the far words' places and classes."""
    for seq, at, cls in zip(b.column(0), b.column(1), b.column(2), strict=True):
        s = unpacked(seq.as_py()).astype(np.int64)
        if at.is_valid:
            by = np.zeros(len(at), dtype=np.int64)
            by[at.values.to_numpy()] = cls.values.to_numpy()
            far = s < 0
            s[far] = by[-1 - s[far]]
        yield s


def brown_scores(docs: DataFrame, modulus: int = 7, held_out: int = 2, classes: int = 64, smooth: float = 5.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    import pyarrow as pa

    out_of = F.coalesce(fold(F.col("doc_id"), modulus) == held_out, F.lit(False))
    model, words_ = fit(docs.filter(~out_of), classes, smooth)
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: HELD counts and tables over CORE words and classes
    n, v, step, k = model.n, model.v, 1 << 33, len(model.steps)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        m, row = held.value, TaskContext.get().partitionId() * step
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for bounds, tokens in tokens_of(b.column(1)):
                rows = len(bounds) - 1
                found = [np.unique(tokens[x:y], return_inverse=True, return_counts=True) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                words, times = (np.concatenate([f[i] for f in found]) for i in (0, 2))
                ends = np.cumsum([len(f[0]) for f in found])
                whose = np.repeat(np.arange(rows), np.diff(ends, prepend=0))
                at = m.held.find(words)
                near = at >= 0
                c, cls = (x[at[near]] for x in m.held.values) if near.any() else (np.empty(0), np.empty(0, np.int64))
                by, k_ = whose[near], times[near]
                base = np.bincount(by, weights=np.log10((c + 1) / (n + v + 1)) * k_, minlength=rows)
                own = np.bincount(by, weights=np.log10((c - np.where(cls >= m.first_shape, m.discount, 0)) / m.class_total[cls]) * k_, minlength=rows)
                known = np.bincount(by, weights=k_, minlength=rows).astype(np.int64)
                # a near word's class, or -1 less a far word's place among the far ones of its text
                far_at = np.cumsum(~near)
                place = np.empty(len(words), dtype=np.int64)
                place[near], place[~near] = cls, -far_at[~near] + np.concatenate([[0], far_at[ends - 1]])[whose[~near]]
                for i, (x, y) in enumerate(zip((ends - np.diff(ends, prepend=0)).tolist(), ends.tolist(), strict=True)):
                    other = ~near[x:y]
                    seq = packed(place[x:y][found[i][1]])
                    for col, value in zip(cols, (row, len(found[i][1]), int(known[i]), float(base[i]), float(own[i]), seq, words[x:y][other].view(np.int64), times[x:y][other]), strict=True):
                        col.append(value)
                    row += 1
            sizes = np.cumsum([0, *map(len, cols[6])])
            far = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64())) for x in cols[6:]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], kinds[0]), b.column(0), b.column(2), *(pa.array(x, t) for x, t in zip(cols[1:6], kinds[1:], strict=True)), *far], ["row", "doc_id", "held_out", "n_tokens", "near", "base_near", "model_near", "seq", "far", "times"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, near long, base_near double, model_near double, seq binary, far array<long>, times array<long>"
    looked = materialize(docs.select("doc_id", "text", out_of.alias("held_out")).mapInArrow(look, schema), "near")
    # words outside the held counts: one row for each distinct one of a document, joined by word
    far = looked.select("row", F.posexplode(F.arrays_zip("far", "times")).alias("at", "x")).select("row", "at", F.col("x.far").alias("h"), F.col("x.times").alias("k"))
    shape = (F.lit(model.first_shape) + F.col("h").bitwiseAND(31)).cast("int")
    far = far.join(words_, "h", "left").withColumn("c", F.coalesce("c", F.lit(0))).withColumn("cls", F.coalesce("cls", shape))

    def of_class(values: np.ndarray) -> Column:
        return F.element_at(F.array(*(F.lit(float(x)) for x in values)), F.col("cls") + 1)

    total, types = of_class(model.class_total), of_class(model.class_types)
    less = F.when(F.col("cls") >= model.first_shape, F.lit(model.discount)).otherwise(F.lit(0.0))
    share = F.when(F.col("c") > 0, (F.col("c") - less) / total).when(total > 0, F.lit(model.discount) * types / total / (types + 1)).otherwise(F.lit(1.0 / (v + 1)))
    # places and classes of the far words of a document
    pairs = F.collect_list(F.struct("at", "cls")).alias("pairs")
    far = far.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"), F.sum(F.col("k") * F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))).alias("base"), F.sum(F.col("k") * F.log10(share)).alias("model"), pairs)
    zero = F.lit(0.0)
    classed = looked.drop("far", "times").join(far, "row", "left").select("seq", F.col("pairs.at").alias("at"), F.col("pairs.cls").alias("cls"), "doc_id", "held_out", "n_tokens", (F.col("near") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base_near") + F.coalesce("base", zero)).alias("base_score"), (F.col("model_near") + F.coalesce("model", zero)).alias("shares"))
    classed = materialize(classed, "classed")
    steps = transitions(class_bigrams(classed.filter(~F.col("held_out")), k), smooth)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            moves = [float(steps[np.concatenate([[k - 1], cls[:-1]]), cls].sum()) for cls in sequences(b)]
            total = b.column(9).to_numpy() + np.array(moves, dtype=float)
            yield pa.RecordBatch.from_arrays([*b.columns[3:9], pa.array(total, pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return classed.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
