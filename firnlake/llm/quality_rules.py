"""Host-level quality rules, in DataFrame functions only.

Each document is measured in one pass over its text. Rule failures are then summed by host, each host's failure rate
is shrunk towards the corpus by a beta prior fitted to all hosts (method of moments), and the hosts' verdicts are joined
back to the documents.

Defined cases: a null text counts as empty (no words, so base_failed). A null source is a host of its own. Repeated
rows are measured and returned each. An empty table gives an empty result. Columns besides doc_id, text and source
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RE, WORD_RE, materialize

#: Columns that measure() returns after doc_id and host.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Positions (0-based) of windows whose hash another window of the text has, then the words that these windows cover.
_REPEATS = """
CASE WHEN size(win) = size(array_distinct(win)) THEN 0L ELSE
  transform(array(sort_array(transform(win, (h, i) -> struct(h AS h, i AS i)))), s ->
    transform(array(sort_array(filter(transform(s, (x, j) ->
        CASE WHEN get(s, j - 1).h = x.h OR get(s, j + 1).h = x.h THEN x.i END), p -> p IS NOT NULL))), d ->
      aggregate(d, struct({first} AS last, 0L AS total),
        (a, p) -> struct(p AS last, a.total + CAST(least({width}, p - a.last) AS BIGINT) AS total), a -> a.total))[0])[0]
END
"""


def measure(docs: DataFrame, window: int = 8) -> DataFrame:
    """doc_id, host and the MEASURES of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col("source").alias("host"), text.alias("t"))
    d = d.withColumn("words", F.regexp_extract_all("t", F.lit(WORD_RE), F.lit(0)))
    d = d.withColumn("lines", F.expr(f"filter(split(t, '\\n'), l -> l rlike '{WORD_RE}')".replace("\\x", "\\\\x")))
    d = d.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE_RE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("wh"),
    )
    win = f"CASE WHEN size(wh) < {window} THEN array() ELSE transform(sequence(1, size(wh) - {window - 1}), i -> xxhash64(slice(wh, i, {window}))) END"
    d = d.withColumn("win", F.expr(win))
    d = d.withColumn("n_repeat_words", F.expr(_REPEATS.format(first=-window, width=window)))
    return d.select("doc_id", "host", *MEASURES)


def rule_failures(n_words: str = "n_words") -> dict[str, str]:
    """The rules as SQL conditions over MEASURES. The first two are the base, the others weigh with the host's verdict."""
    return {
        "base_short": f"{n_words} < 20",
        "base_repeats": f"100 * n_repeat_words > 30 * {n_words}",
        "symbols": f"100 * n_symbols > 10 * {n_words}",
        "dup_lines": "100 * n_dup_lines > 30 * n_lines",
        "word_length": f"word_chars < 2 * {n_words} OR word_chars > 15 * {n_words}",
    }


def host_rates(measured: DataFrame) -> DataFrame:
    """host, n_docs, n_failed and failure_rate: (failed + a) / (docs + a + b), with Beta(a, b) fitted to all hosts.

    Moments: m is the mean of the hosts' rates, v their variance less what sampling of n documents explains; a + b is
    m (1 - m) / v - 1, held between 1 and 10,000. One row of moments goes to the driver.
    """
    hosts = measured.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = materialize(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    row = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("n_docs")).alias("inv")).first()
    m = min(max(row["m"] or 0.0, 1e-6), 1 - 1e-6)
    v = max((row["v"] or 0.0) - m * (1 - m) * (row["inv"] or 0.0), 1e-9)
    strength = min(max(m * (1 - m) / v - 1, 1.0), 10_000.0)
    return hosts.withColumn("failure_rate", (F.col("n_failed") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength)))


def quality_rules(docs: DataFrame, bad_rate: float = 0.9, watch_rate: float = 0.5) -> DataFrame:
    """doc_id, MEASURES, base_failed, n_soft (other rules failed), host, failure_rate, host_verdict and kept.

    A document fails for its host's rate if it fails the base or any other rule. Verdicts: a host of bad_rate or more is
    bad and none of its documents stay; one of watch_rate or more is watched and a document that fails any rule goes; in
    a good host a document goes that fails two rules besides the base.
    """
    rules = rule_failures()
    base = " OR ".join(f"({c})" for k, c in rules.items() if k.startswith("base_"))
    soft = " + ".join(f"CAST(({c}) AS INT)" for k, c in rules.items() if not k.startswith("base_"))
    m = measure(docs).withColumn("base_failed", F.expr(base)).withColumn("n_soft", F.expr(f"CASE WHEN n_words = 0 THEN 0 ELSE {soft} END"))
    m = materialize(m.withColumn("failed", F.expr("base_failed OR n_soft > 0")), "measures")
    rates = host_rates(m).select(F.col("host").alias("_host"), "failure_rate")
    verdict = F.when(F.col("failure_rate") >= bad_rate, "bad").when(F.col("failure_rate") >= watch_rate, "watch").otherwise("good")
    out = m.join(rates, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host").withColumn("host_verdict", verdict)
    stays = F.expr("NOT base_failed AND host_verdict <> 'bad' AND NOT (host_verdict = 'watch' AND n_soft > 0) AND n_soft < 2")
    return out.withColumn("kept", stays).drop("failed")
