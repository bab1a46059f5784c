"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Tokens are runs of letters and digits in lower case. Each of three fixed masks looks at 8 positions of a window of 12 and
ignores the other 4; together they ignore every position once, so a window with any one substitution, or with several at
distances of three, still hits. Hashes of benchmark windows are joined with those of the documents' windows. A hit is a place
in a document and a place in an item, every such pair of them. It is verified along its diagonal: of the 24 aligned positions around it (fewer at
the borders of the item or the text) a share of 75 % must be equal, or RUN in a row. Items of fewer than 12 tokens are looked for whole and
unchanged. The least overlap that is found within longer items is thus RUN equal tokens, or 12 near both borders; overlaps in which
no window of 12 agrees with a mask, such as those with every fourth token changed, are not.

Windows meet the seeds as narrow rows of numbers; only for texts that hit are the aligned tokens read, in a second step.

Defined cases: null and empty texts have no tokens and are clean; so is everything if the benchmark is empty. Rows that repeat a
doc_id answer together, each distinct text once. An item's text that repeats is named by its least item_id; items without an id count as one more item
and are in no list of ids. Columns besides doc_id and text (item_id and text) are ignored by find_contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, restored, shielded, small

SPAN, AROUND, RUN = 12, 6, 13
#: Positions that each mask looks at.
MASKS = tuple(tuple(j for j in range(SPAN) if j % 3 != k) for k in range(3))
#: Seeds, and hits, up to this many (narrow) rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def tokens(text: str = "text") -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), '[\\\\p{{L}}\\\\p{{N}}]+', 0)"


def _hash(mask: int, positions: tuple[int, ...], at: str) -> str:
    return f"xxhash64({mask}, {', '.join(f'th[{at} + {j}]' for j in positions)})"


def _windows(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and a row (at, h) for each window and mask of column th."""
    places = df.withColumn("at", F.explode(F.expr(f"CASE WHEN size(th) >= {SPAN} THEN sequence(0, size(th) - {SPAN}) END")))
    return places.select(*keys, "at", F.explode(F.expr(f"array({', '.join(_hash(k, m, 'at') for k, m in enumerate(MASKS))})")).alias("h"))


def _short_windows(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """keys and a row (at, h) for each place of column th and length that fits there."""
    places = df.withColumn("at", F.explode(F.expr("CASE WHEN size(th) > 0 THEN sequence(0, size(th) - 1) END")))
    hashes = ", ".join(f"CASE WHEN at + {n} <= size(th) THEN {_hash(100 + n, tuple(range(n)), 'at')} END" for n in lengths)
    return places.select(*keys, "at", F.explode(F.expr(f"array({hashes})")).alias("h")).filter("h IS NOT NULL")


def _around(at: str) -> str:
    """The tokens from AROUND before place at of th to AROUND after its window, as far as there are any."""
    return f"slice(th, greatest({at} - {AROUND}, 0) + 1, least({at}, {AROUND}) + {SPAN + AROUND})"


def find_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.75) -> DataFrame:
    """doc_id, item_id, n_hits, best_share and matched of each document and item with a verified overlap."""
    docs = docs.select("doc_id", "text")
    b = benchmark.select("item_id", F.expr(f"transform({tokens()}, w -> xxhash64(w))").alias("th")).filter("size(th) > 0")
    b = materialize(b.groupBy("th").agg(F.min("item_id").alias("item_id")).withColumn("item", F.xxhash64("th")), "benchmark")
    # distinct lengths below SPAN: at most SPAN - 1 rows
    short = sorted(r[0] for r in b.filter(f"size(th) < {SPAN}").select(F.size("th")).distinct().collect())
    seeds = _windows(b, ["item"])
    for n in short:
        seeds = seeds.unionByName(b.filter(f"size(th) = {n}").select("item", F.lit(0).alias("at"), F.expr(_hash(100 + n, tuple(range(n)), "0")).alias("h")))
    seeds = materialize(seeds.withColumnsRenamed({"at": "b_at", "h": "b_h"}), "seeds")
    if seeds.count() <= BROADCAST_ROWS:
        seeds = F.broadcast(seeds)

    d = docs.select("doc_id", F.expr(f"transform({tokens()}, w -> xxhash64(w))").alias("th")).withColumn("text", F.xxhash64("th"))
    windows = _windows(d, ["doc_id", "text"])
    if short:
        windows = windows.unionByName(_short_windows(d, ["doc_id", "text"], short))
    hits = windows.join(seeds, F.col("h") == F.col("b_h")).select("doc_id", "text", "item", "at", "b_at").distinct()
    hits = materialize(hits, "hits")

    # a text's hits meet its tokens in one row, from which only the aligned ones go on
    few = hits.count() <= BROADCAST_ROWS
    of = hits.groupBy(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).agg(F.collect_list(F.struct("item", "at", "b_at")).alias("hits"))
    of = F.broadcast(of) if few else of
    ids = small(materialize(hits.select(F.col("doc_id").alias("_id")).distinct(), "hit"))
    again = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    again = again.select("doc_id", F.expr(f"transform({tokens()}, w -> xxhash64(w))").alias("th")).withColumn("text", F.xxhash64("th"))
    found = again.join(of, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text") == F.col("_text"))).select("doc_id", "text", "th", F.explode("hits").alias("x"))
    found = found.select("doc_id", "text", "x.item", "x.at", "x.b_at", F.expr(_around("x.at")).alias("dw"))
    places = hits.select("item", "b_at").distinct().join(b, "item").select(F.col("item").alias("_item"), F.col("b_at").alias("_at"), "item_id", F.expr(_around("b_at")).alias("bw"))
    places = small(materialize(places, "places"), 100_000)
    found = found.join(places, (F.col("item") == F.col("_item")) & (F.col("b_at") == F.col("_at")))
    # tokens before the hit that both have, and those from it on
    found = found.withColumn("l", F.expr(f"least(at, b_at, {AROUND})"))
    found = found.withColumn("r", F.expr(f"least(size(dw) - least(at, {AROUND}), size(bw) - least(b_at, {AROUND}))"))
    same = f"CASE WHEN dw[j + least(at, {AROUND}) - l] = bw[j + least(b_at, {AROUND}) - l] THEN '1' ELSE '0' END"
    found = found.withColumn("same", F.expr(f"array_join(transform(sequence(0, l + r - 1), j -> {same}), '')"))
    found = found.withColumn("aligned", F.length("same")).withColumn("matched", F.length(F.replace("same", F.lit("0"), F.lit(""))))
    found = found.filter((F.col("matched") >= F.lit(share) * F.col("aligned")) | F.col("same").contains("1" * RUN))
    found = found.select("doc_id", "text", "item", "item_id", "at", "b_at", "matched", "aligned").distinct()
    return found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_hits"), F.max(F.col("matched") / F.col("aligned")).alias("best_share"), F.max("matched").cast("int").alias("matched"))


def verdicts(docs: DataFrame, benchmark: DataFrame, share: float = 0.75) -> DataFrame:
    """doc_id, contaminated, n_items, n_hits and item_ids (ascending) of every document."""
    found = find_contaminated(docs, benchmark, share).groupBy(F.col("doc_id").alias("_id"))
    found = found.agg(F.count("*").alias("n_items"), F.sum("n_hits").alias("n_hits"), F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    found = materialize(found, "contaminated")
    out = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = 0.75) -> DataFrame:
    """docs without the contaminated documents; a null doc_id's documents are judged together."""
    ids = small(materialize(find_contaminated(docs, benchmark, share).select(F.col("doc_id").alias("_id")).distinct(), "contaminated"))
    own, names = shielded(docs, ("doc_id",))
    return restored(own.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti"), names)
