"""Toxicity by weak supervision.

Voters (lexicons by language, lexicons mined from labelled rows of the training fold, and patterns) vote 1 toxic, -1 not,
0 abstain. A generative label model estimates by expectation-maximisation each voter's chance of each vote given the
class, with the rows' own labels as one noisy voter more, and the voters' correlations given the class; a voter's evidence is
divided by what correlated voters repeat. A linear classifier over the voters and a few densities is trained on the posterior
labels and scores every whole text in one pass without a shuffle.

Bounds: the model is fitted on at most max_rows labelled rows of the training fold, those of the least seeded hash; at
most max_words words are mined. Scores use the text alone.

Defined cases: a null text counts as empty and gets the score of a text without votes. Without labelled rows the lexicons
decide with preset weights. Rows that repeat are scored each; labels that repeat a doc_id count once, as toxic if any is. A null doc_id has
a null fold: it is not learned from and counts as not held out. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize

# Insults and threats by language and kind.
LEXICONS = {
    "en_person": "idiot idiots moron morons loser losers clown clowns scum imbecile fool fools jerk jerks bastard bastards creep cretin dumbass asshole bitch whore slut pig swine rat vermin freak freaks",
    "en_judgement": "stupid dumb pathetic worthless disgusting trash garbage useless ridiculous filthy vile repulsive hideous brainless shameful despicable ugly",
    "en_swearing": "fuck fucking fucked shit shitty crap damn bullshit piss",
    "en_threat": "kill murder hang beat burn destroy rape stab shoot",
    "en_hate": "hate hates hated despise loathe subhuman parasite parasites savages infest",
    "fr": "idiote imbécile crétin connard connasse salaud salope débile abruti ordure merde minable pourriture dégoûtant stupide",
    "de": "idiot dummkopf trottel arschloch schwein abschaum scheiße scheisse blöd dumm wertlos ekelhaft versager müll missgeburt",
    "es": "idiota imbécil estúpido estúpida basura asqueroso inútil tonto pendejo cabrón mierda puta escoria payaso patético",
}
PATTERNS = ("you_are", "masked", "shouting", "exclaiming", "no_insult", "long_and_calm")
MINED = 6
LETTERS = re.compile(r"[^\W\d_]+")
_YOU = re.compile(r"\b(?:you|u|tu|du|usted|eres|ihr)\b[^.!?\n]{0,12}\b(?:%s)\b" % "|".join(w for k in ("en_person", "en_judgement") for w in LEXICONS[k].split()), re.I)
_MASKED = re.compile(r"\b(?:f[*@#$]+c?k|sh[*!1]+t|b[*!1]+tch|a[*$@]+s?hole|[i1!]d[i1!]0t|m0r0n|st[*u]p[*!1]d)\b", re.I)


@dataclass
class Model:
    """mined: voter by word; weights of the features; accuracies and correlations are for reading."""

    mined: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray | None = None
    table: np.ndarray | None = None
    correlation: np.ndarray | None = None


def voters() -> list[str]:
    return [*LEXICONS, *(f"mined_{i}" for i in range(MINED)), *PATTERNS]


_WORDS: dict[str, list[int]] = defaultdict(list)
for _i, _words in enumerate(LEXICONS.values()):
    for _w in _words.split():
        _WORDS[_w].append(_i)


def terms(words: set[str]) -> set[str]:
    """The words and, marked by a hyphen, the first five and seven letters of longer ones."""
    return words | {f"{w[:n]}-" for n in (5, 7) for w in words if len(w) > n}


def features(text: str, mined: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """A text's votes, and its features: 1 for each vote of 1 or -1 (two for each voter), densities, and a constant."""
    names = voters()
    votes = np.zeros(len(names), dtype=np.int8)
    words = LETTERS.findall(text.lower())
    found = set(words)
    fixed, own = [w for w in found if w in _WORDS], [w for w in terms(found) if w in mined]
    for w in fixed:
        votes[_WORDS[w]] = 1
    for w in own:
        votes[len(LEXICONS) + mined[w]] = 1
    at, hits, n = len(LEXICONS) + MINED, set(fixed) | set(own), max(1, len(words))
    upper = sum(map(str.isupper, text)) / max(1, sum(map(str.isalpha, text))) if text else 0.0
    marks = text.count("!") / n
    votes[at] = bool(fixed) and _YOU.search(text) is not None
    votes[at + 1] = _MASKED.search(text) is not None if "*" in text or "0" in text or "1" in text or "@" in text else 0
    votes[at + 2] = 1 if upper > 0.5 and n > 5 and hits else 0
    votes[at + 3] = 1 if marks > 0.05 and hits else -1 if marks == 0 and not hits else 0
    votes[at + 4] = 0 if hits else -1
    votes[at + 5] = -1 if not hits and n >= 50 and upper < 0.2 else 0
    dense = [math.log1p(len(hits)), min(1.0, 10 * sum(w in hits for w in words) / n) if hits else 0.0, 1.0]
    return votes, np.concatenate([votes == 1, votes == -1, dense]).astype(float)


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 50, trust: float = 0.9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(vote | class) by voter, the voters' correlations given the class, and the posteriors, by EM.

    votes: rows x voters. labels: 0 or 1, a voter that is right with chance trust.
    """
    hot = np.stack([votes == -1, votes == 0, votes == 1], axis=2).astype(float)
    prior_odds = np.where(labels == 1, math.log(trust / (1 - trust)), -math.log(trust / (1 - trust)))
    post = 1 / (1 + np.exp(-(prior_odds + np.clip(votes, 0, 1).sum(1) - 1)))
    share, corr, table = np.ones(votes.shape[1]), np.eye(votes.shape[1]), None
    for _ in range(rounds):
        weight = np.stack([1 - post, post])
        table = np.einsum("zr,rvk->zvk", weight, hot) + 0.5
        table /= table.sum(2, keepdims=True)
        base = min(max(float(post.mean()), 0.005), 0.5)
        evidence = np.einsum("rvk,vk->rv", hot, np.log(table[1]) - np.log(table[0]))
        # correlations given the class: of what is left of the votes after the class's mean
        mean = table @ np.array([-1.0, 0.0, 1.0])
        rest = votes - (post[:, None] * mean[1] + (1 - post)[:, None] * mean[0])
        cov = rest.T @ rest / len(votes)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-6))
        corr = cov / np.outer(sd, sd)
        np.fill_diagonal(corr, 1.0)
        share = 1 / np.maximum(np.clip(corr, 0, 1).sum(1), 1)
        odds = math.log(base / (1 - base)) + evidence @ share + prior_odds
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return table, corr, post


def linear_classifier(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - l2 * w)
        w += step / max(1.0, float(np.abs(step).max()))
    return w


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, modulus: int, held_out: int) -> DataFrame:
    """text and toxic of the labelled documents that are learned from, max_rows at most; one that repeats its doc_id has its least text."""
    own = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), "toxic").filter(fold(F.col("_id"), modulus) != held_out)
    own = own.groupBy("_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64(F.lit(7), F.col("_id")), "_id").limit(max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(own), F.col("doc_id") == F.col("_id"))  # own has at most max_rows rows
    return found.groupBy("_id").agg(F.min("text").alias("text"), F.max("toxic").cast("int").alias("toxic")).drop("_id")


def mine_words(rows: DataFrame, max_words: int, least: int = 5) -> dict[str, int]:
    """Voter by word for the words that toxic rows have far more often than others.

    Rows are counted by the least hash of their words, so copies of a text count about once. A word is taken if toxic
    texts of at least `least` such groups have it and its share among them is at least five times that of toxic texts.
    """
    import pyarrow as pa

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = set(LETTERS.findall(text.lower())) | {""}
                group = min(xxhash.xxh64_intdigest(w) for w in own) >> 1
                own = terms(own)
                out[0].extend(own)
                out[1].extend([group] * len(own))
                out[2].extend([toxic] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], ["word", "grp", "toxic"])

    counts = rows.mapInArrow(words, "word string, grp long, toxic int").groupBy("word", "toxic").agg(F.count_distinct("grp").alias("n"))
    counts = counts.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("good"))
    counts = materialize(counts, "words")
    total = counts.filter("word = ''").first()  # every row has the empty word
    if not total or not total["bad"] or not total["good"]:
        return {}
    share = total["bad"] / (total["bad"] + total["good"])
    apart = (F.col("bad") >= least) & (F.col("bad") / (F.col("bad") + F.col("good")) >= min(0.8, 5 * share)) & (F.col("word") != "")
    best = counts.filter(apart).orderBy(F.desc(F.col("bad") - F.col("good") * share), "word").limit(max_words).collect()
    return {r["word"]: i % MINED for i, r in enumerate(best)}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_words: int = 200, modulus: int = 3, held_out: int = 1) -> Model:
    import pyarrow as pa

    rows = materialize(training_rows(docs, labels, max_rows, modulus, held_out), "labelled")
    mined = mine_words(rows, max_words)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t, mined) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([v.tolist() for v, _ in got], pa.list_(pa.int32())), pa.array([x.tolist() for _, x in got], pa.list_(pa.float64())), b.column(1)], ["votes", "x", "toxic"])

    got = rows.mapInArrow(measured, "votes array<int>, x array<double>, toxic int").collect()  # at most max_rows rows
    if not got:
        weights = np.zeros(2 * len(voters()) + 3)
        weights[: len(LEXICONS)], weights[-1] = 3.0, -2.0
        return Model(mined, weights)
    got.sort(key=lambda r: (r["votes"], r["toxic"], r["x"]))  # the order of rows must not matter
    votes, x, y = (np.array([r[k] for r in got], dtype=float) for k in ("votes", "x", "toxic"))
    table, corr, post = label_model(votes, y)
    return Model(mined, linear_classifier(x, post), table, corr)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    import pyarrow as pa

    mined, weights = model.mined, model.weights

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            odds = [float(features(t.as_py(), mined)[1] @ weights) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([round(1 / (1 + math.exp(-min(30.0, max(-30.0, o)))), 9) for o in odds], pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(scored, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    out = score(docs, fit(docs, labels, modulus=modulus, held_out=held_out))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
