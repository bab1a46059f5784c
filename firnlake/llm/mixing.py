"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a budget in words. Whole passes over the source come first; the rest of the budget is fitted exactly, or
as nearly as sums of lengths allow, by choosing how many documents of each exact length to add: a proportional share of
every length, then a bounded-knapsack dynamic program over what that leaves. Which documents of a length are taken
follows from a seeded hash of doc_id and text, so reruns agree.

Defined cases: a null or blank text has size 0 and is taken 0 words. A null source is a source of its own, last in the
order. Rows of a source that repeat a doc_id and its text are taken together, so such a source may exceed its budget by them; other texts of
a doc_id are documents of their own. A source without words has target 0. An empty table gives an empty result. Other columns are kept; those added start with mix_, and
repeat_documents() keeps columns of any name.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, materialize, restored, shielded, small

#: Buckets of the seeded hash within one length of one source: ranks are counted within buckets, so no length is ranked by one task.
BUCKETS = 256


def water_fill(sizes: list[int], weights: list[float], cap: float) -> list[float]:
    """Targets that share the sum of sizes by weight; none is above cap times its size, the excess is shared again."""
    targets, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_ and left > 0:
        total = sum(weights[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
            open_.discard(i)
        left = float(sum(sizes)) - sum(targets[i] for i in range(len(sizes)) if i not in open_)
    return targets


def fit(counts: dict[int, int], budget: int, span: int = 1 << 16) -> dict[int, int]:
    """How many documents of each length to take so that their sum is at most budget and as near to it as can be found.

    counts: documents by length. Each length first gives its proportional share of what exceeds span, then the longest are
    added while more than span words are open; what is left is a bounded knapsack over sums up to span, one bit per sum.
    """
    lengths = sorted((n for n, c in counts.items() if n > 0 and c > 0), reverse=True)
    whole = sum(n * counts[n] for n in lengths)
    if budget >= whole:
        return {n: counts[n] for n in lengths}
    take = {n: counts[n] * max(0, budget - span) // whole for n in lengths}
    left = budget - sum(n * k for n, k in take.items())
    for n in lengths:
        if left <= span:
            break
        more = min(counts[n] - take[n], (left - span + n - 1) // n, left // n)
        take[n], left = take[n] + more, left - n * more
    mask, seen, steps = (1 << (left + 1)) - 1, 1, []
    for n in lengths:
        spare, k = min(counts[n] - take[n], left // n), 1
        while spare > 0 and not seen >> left & 1:
            k = min(k, spare)
            steps.append((n, k, seen))
            seen |= (seen << n * k) & mask
            spare, k = spare - k, 2 * k
        if seen >> left & 1:
            break
    at = seen.bit_length() - 1
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            take[n], at = take[n] + k, at - n * k
    return {n: k for n, k in take.items() if k}


def plan(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """source, size, source_size, target, passes and extra (documents of that size taken once more).

    The sources' totals go to the driver (one row for each source); each source's lengths are fitted in a task of its own.
    """
    counts = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("total")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["total"] for r in totals]
    targets = water_fill(sizes, [float(weights[i % len(weights)]) for i in range(len(sizes))], cap)
    rows = [(r["source"], r["total"], t) for r, t in zip(totals, targets, strict=True)]
    sources = sized.sparkSession.createDataFrame(rows, "_source string, source_size long, target double")

    def of_source(pdf: pd.DataFrame) -> pd.DataFrame:
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = min(cap, int(target // total)) if total else 0
        budget = 0 if passes >= cap else int(round(target - passes * total))
        extra = fit(dict(zip(pdf["size"].tolist(), pdf["n"].tolist(), strict=True)), budget)
        return pdf.assign(passes=passes, extra=[extra.get(s, 0) for s in pdf["size"].tolist()])[["source", "size", "source_size", "target", "passes", "extra"]]

    joined = counts.join(sources, counts["source"].eqNullSafe(sources["_source"])).drop("_source")
    return joined.groupBy("source").applyInPandas(of_source, "source string, size long, source_size long, target double, passes long, extra long")


def word_count() -> Column:
    """Number of words of column text."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long")


def cuts(sized: DataFrame, lengths: DataFrame) -> DataFrame:
    """lengths with cut_h and cut_id: the hash and id of the extra-th document of the length; null if extra is 0.

    sized has source, size, h and doc_id. A document's rank in its length is the number of documents in the buckets before
    its own and its place there.
    """
    group = ["source", "size"]
    d = sized.withColumn("bucket", F.shiftrightunsigned("h", 64 - (BUCKETS - 1).bit_length()).cast("int"))
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    full = d.groupBy(*group, "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = lengths.filter("extra > 0").select(F.col("source").alias("_s"), F.col("size").alias("_z"), "extra")
    full = full.join(small(wanted), F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).filter("before < extra AND extra <= before + n")
    full = materialize(full.select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("bucket").alias("_b"), (F.col("extra") - F.col("before")).alias("place")), "buckets")
    last = d.join(small(full), F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("bucket") == F.col("_b")))
    unsigned = F.shiftrightunsigned("h", 1)  # the order of buckets is that of unsigned hashes
    last = last.withColumn("rank", F.row_number().over(Window.partitionBy(*group, "bucket").orderBy(unsigned, "h", "doc_id"))).filter("rank = place")
    last = last.select(F.col("source").alias("_s"), F.col("size").alias("_z"), unsigned.alias("cut_u"), F.col("h").alias("cut_h"), F.col("doc_id").alias("cut_id"))
    return lengths.join(last, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left").drop("_s", "_z")


def mix(docs: DataFrame, seed: int = 17, weights: tuple[float, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_times (how often the mix takes the document).

    The plan has a row for each length of each source and is joined to the documents, so their texts are not shuffled while it is small.
    """
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = materialize(docs.select("doc_id", "source", word_count().alias("size"), h.alias("h")), "sized")
    lengths = materialize(plan(sized, weights, cap), "plan")
    found = small(materialize(cuts(sized, lengths).select(*(F.col(c).alias(f"_plan_{c}") for c in ("source", "size", "source_size", "target", "passes", "cut_u", "cut_h", "cut_id"))), "cuts"), 500_000)
    out = docs.withColumn("mix_size", word_count()).withColumn("_plan_h", h)
    out = out.join(found, F.col("source").eqNullSafe(F.col("_plan_source")) & (F.col("mix_size") == F.col("_plan_size")), "left")
    u, cu, ch, ci = F.shiftrightunsigned("_plan_h", 1), F.col("_plan_cut_u"), F.col("_plan_cut_h"), F.col("_plan_cut_id")
    after_id = F.when(F.col("doc_id").isNull(), False).when(ci.isNull(), True).otherwise(F.col("doc_id") > ci)  # nulls come first
    after = (u > cu) | ((u == cu) & ((F.col("_plan_h") > ch) | ((F.col("_plan_h") == ch) & after_id)))
    times = F.col("_plan_passes") + F.when(cu.isNotNull() & ~after, 1).otherwise(0)
    return out.select(*docs.columns, "mix_size", F.col("_plan_source_size").alias("mix_source_size"), F.col("_plan_target").alias("mix_target"), times.cast("int").alias("mix_times"))


def repeat_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mixture itself: docs' columns, each document as often as the mix takes it. A document without words is not taken."""
    own, names = shielded(docs, ("doc_id", "text", "source"))
    mixed = mix(own, seed).withColumn("_times", F.when(F.col("mix_size") > 0, F.col("mix_times")).otherwise(0))
    return restored(mixed.filter("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))), names)
