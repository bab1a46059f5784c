"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from regular expressions. Labelers vote on each (+1 personal, -1 not, 0 abstains): shape and
checksum, gazetteers, words before the span, placeholder patterns, and the span's borders. Expectation-maximisation over
the counts of vote patterns estimates each labeler's reliability; a logistic span classifier is trained on the posterior
labels and decides on spans of the additional kinds. Spans of the base kinds that pass their check always stay.

Only counts of patterns go to the driver: at most KINDS x 3^5 x 16 rows, whatever the input.

Defined cases: a null text counts as empty (no spans). Repeated rows are answered each. An empty table gives an empty
result. Columns besides doc_id and text are ignored. Positions are code points, the end exclusive. The expressions are
possessive where the greedy form cannot give anything back, so a very long run is read in linear time.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import materialize

# The base expressions in possessive form. A local part or number starts where its run starts or where the last match ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Shapes of the additional kinds, as (not before, shape, not after).
MORE = {
    "national_id": (r"(?<![0-9A-Za-z-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?![0-9A-Za-z-])"),
    "iban": (r"(?<![0-9A-Za-z])", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", r"(?![0-9A-Za-z])"),
    "local_phone": (r"(?<![0-9A-Za-z+.-])", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}", r"(?![0-9A-Za-z-])"),
    "birth_date": (r"(?<![0-9A-Za-z/.-])", r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})", r"(?![0-9A-Za-z/.-])"),
    "secret": (r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])", r"[A-Za-z0-9_-]{20,}+", ""),
    "person": (r"(?<![\p{L}])", r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?", ""),
}
KINDS = [*BASE, *MORE]
# Words that announce a kind, looked for in the 32 code points before a span.
CUES = {
    "email": "mail|contact|write|escri|kontakt|correo",
    "ip": r"\bip\b|address|host|server|login|adresse",
    "card": "card|visa|master|credit|pay|carte|karte|tarjeta",
    "phone": "phone|call|tel|mobil|fax|anruf|appel",
    "national_id": r"ssn|social|\bid\b|identi|security",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "local_phone": "phone|call|tel|mobil|fax",
    "birth_date": r"born|birth|\bdob\b|geboren|née?|nacid",
    "secret": "key|token|secret|passw|auth|bearer|credential",
    "person": "name|dear|from|regards|signed|patient|contact|by",
}
VOTERS = ("shape", "gazetteer", "context", "placeholder", "border")
VOTES = (-1, 0, 1)
_CAND = "array<struct<kind:int,s:int,e:int,m:string>>"


def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(kind: int, found: str, regex: str) -> str:
    """Candidates from the matches in column found: the pieces between the matches give the positions."""
    step = "struct(a.at + length(x.p[k]) + length(x.m[k]) AS at, array_append(a.out, struct({0} AS kind, a.at + length(x.p[k]) AS s, a.at + length(x.p[k]) + length(x.m[k]) AS e, x.m[k] AS m)) AS out)".format(kind)
    return (
        f"CASE WHEN size({found}) = 0 THEN CAST(array() AS {_CAND}) ELSE transform(array(struct({found} AS m, split(t, {_lit(regex)}, -1) AS p)), x -> "
        f"aggregate(sequence(0, size(x.m) - 1), struct(0 AS at, CAST(array() AS {_CAND}) AS out), (a, k) -> {step}, a -> a.out))[0] END"
    )


_DIGITS = "regexp_replace(c.m, '[^0-9]', '')"
_LUHN = f"transform(array({_DIGITS}), d -> aggregate(sequence(1, length(d)), 0, (a, k) -> a + transform(array(CAST(substr(d, length(d) - k + 1, 1) AS INT) * (2 - k % 2)), v -> CASE WHEN v > 9 THEN v - 9 ELSE v END)[0]))[0] % 10 = 0"
_IP = "forall(transform(split(c.m, '[.]'), p -> regexp_replace(p, '^0+', '')), p -> length(p) = 0 OR (length(p) <= 3 AND CAST(p AS INT) <= 255))"
#: Whether a candidate passes its kind's check.
_VALID = f"""CASE c.kind WHEN 0 THEN true WHEN 1 THEN {_IP}
 WHEN 2 THEN CASE WHEN length({_DIGITS}) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END
 WHEN 3 THEN length({_DIGITS}) BETWEEN 10 AND 15
 WHEN 4 THEN NOT c.m rlike '^(000|666|9)' AND NOT c.m rlike '-00-|-0000$'
 WHEN 5 THEN length(replace(c.m, ' ', '')) BETWEEN 15 AND 34
 WHEN 6 THEN NOT regexp_replace(c.m, '[^0-9]', '') rlike '^[01]'
 WHEN 7 THEN regexp_extract(c.m, '([12][0-9]{{3}})', 1) BETWEEN '1900' AND '2030'
 WHEN 8 THEN c.m rlike '[0-9]' AND c.m rlike '[A-Za-z]' AND size(array_distinct(split(c.m, ''))) >= 8
 ELSE true END"""
#: Known good and known harmless values.
_GAZETTEER = """CASE WHEN c.kind = 0 THEN CASE WHEN lower(c.m) rlike '[.](com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|ch|at|us)$' THEN 1 ELSE 0 END
 WHEN c.kind = 1 THEN CASE WHEN c.m rlike '^(0|127|255)[.]' THEN -1 ELSE 0 END
 WHEN c.kind = 2 THEN CASE WHEN c.m rlike '^(4|5[1-5]|2[2-7]|3[47]|6)' THEN 1 ELSE -1 END
 WHEN c.kind = 3 THEN CASE WHEN c.m rlike '^[+](1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])' THEN 1 ELSE -1 END
 WHEN c.kind = 5 THEN CASE WHEN c.m rlike '^(DE|FR|ES|IT|GB|NL|BE|AT|CH|PT|IE|PL|SE|DK|FI|NO|LU)' THEN 1 ELSE -1 END
 WHEN c.kind = 8 THEN CASE WHEN c.m rlike '^(AKIA|ghp_|sk-|xox|eyJ)' THEN 1 ELSE 0 END ELSE 0 END"""


def _votes() -> str:
    """A candidate c with its votes and buckets, from its text t."""
    before, cue = "lower(substr(t, greatest(1, c.s - 31), least(32, c.s)))", " ".join(f"WHEN {i} THEN {_lit(CUES[k])}" for i, k in enumerate(KINDS))
    border = "CASE WHEN (c.s = 0 OR NOT substr(t, c.s, 1) rlike '[\\\\p{L}\\\\p{N}]') AND NOT substr(t, c.e + 1, 1) rlike '[\\\\p{L}\\\\p{N}]' THEN 1 ELSE -1 END"
    fields = {
        "shape": f"CASE WHEN ({_VALID}) THEN 1 ELSE -1 END",
        "gazetteer": _GAZETTEER,
        "context": f"CASE WHEN {before} rlike (CASE c.kind {cue} END) THEN 1 ELSE 0 END",
        "placeholder": f"CASE WHEN c.m rlike '(?i)x{{4}}|0{{6}}|123456|(.)\\\\1{{6}}' THEN -1 ELSE 0 END",
        "border": border,
        "long": "CASE WHEN c.e - c.s < 12 THEN 0 WHEN c.e - c.s < 17 THEN 1 WHEN c.e - c.s < 30 THEN 2 ELSE 3 END",
        "digits": f"least(3, CAST(4 * length({_DIGITS}) / (c.e - c.s) AS INT))",
    }
    return "struct(c.kind AS kind, c.s AS s, c.e AS e, " + ", ".join(f"{x} AS {n}" for n, x in fields.items()) + ")"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and cands: an array of kind, s, e, the votes, and the buckets long and digits."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    regexes = [*BASE.values(), "|".join(f"(?:{before}{shape}{after})" for before, shape, after in MORE.values())]
    d = d.withColumns({f"f{i}": F.regexp_extract_all("t", F.lit(r), F.lit(0)) for i, r in enumerate(regexes)})
    parts = [_spans(i, f"f{i}", r) for i, r in enumerate(regexes)]
    which = " ".join(f"WHEN c.m rlike {_lit(f'^(?:{shape})$')} THEN {len(BASE) + i}" for i, (_, shape, _) in enumerate(MORE.values()))
    parts[-1] = f"transform({parts[-1]}, c -> struct(CASE {which} ELSE {KINDS.index('secret')} END AS kind, c.s AS s, c.e AS e, c.m AS m))"
    d = d.select("doc_id", "t", F.expr(f"concat({', '.join(parts)})").alias("c0"))
    return d.select("doc_id", F.expr(f"transform(c0, c -> {_votes()})").alias("cands"))


def reliabilities(patterns: list[Row], rounds: int = 40) -> tuple[dict, list[float]]:
    """EM over counts of (kind, votes): each labeler's P(vote | personal or not), and each pattern's posterior."""
    post = [1 / (1 + math.exp(-1.5 * sum(r[v] for v in VOTERS))) for r in patterns]
    table: dict = {}
    for _ in range(rounds):
        prior: dict = {k: [1.0, 1.0] for k in range(len(KINDS))}
        table = {(v, x): [1.0, 1.0] for v, x in product(VOTERS, VOTES)}
        for r, p in zip(patterns, post, strict=True):
            for z, w in ((0, (1 - p) * r["n"]), (1, p * r["n"])):
                prior[r["kind"]][z] += w
                for v in VOTERS:
                    table[v, r[v]][z] += w
        for v in VOTERS:
            for z in (0, 1):
                total = sum(table[v, x][z] for x in VOTES)
                for x in VOTES:
                    table[v, x][z] /= total
        post = []
        for r in patterns:
            odds = math.log(prior[r["kind"]][1] / prior[r["kind"]][0]) + sum(math.log(table[v, r[v]][1] / table[v, r[v]][0]) for v in VOTERS)
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return table, post


def _features(r: Row) -> list[tuple]:
    return [("kind", r["kind"]), ("long", r["long"]), ("digits", r["digits"]), *((v, r[v]) for v in VOTERS)]


def span_classifier(patterns: list[Row], post: list[float], rounds: int = 300, rate: float = 0.5, l2: float = 1e-3) -> dict[tuple, float]:
    """Weights of a logistic model by feature value, fitted to the posterior labels by full gradient steps."""
    total = sum(r["n"] for r in patterns) or 1
    w: dict[tuple, float] = {f: 0.0 for r in patterns for f in _features(r)}
    for _ in range(rounds):
        g = {f: -l2 * x for f, x in w.items()}
        for r, p in zip(patterns, post, strict=True):
            e = (p - 1 / (1 + math.exp(-sum(w[f] for f in _features(r))))) * r["n"] / total
            for f in _features(r):
                g[f] += e
        for f in w:
            w[f] += rate * 4 * g[f]
    return w


def _score(weights: dict[tuple, float]) -> str:
    """The model's log odds of candidate c."""
    parts = []
    for name in ("kind", "long", "digits", *VOTERS):
        cases = " ".join(f"WHEN {x} THEN {w!r}D" for (n, x), w in sorted(weights.items()) if n == name)
        parts.append(f"(CASE c.{name} {cases} ELSE 0D END)" if cases else "0D")
    return " + ".join(parts)


def find_pii(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, base and spans: arrays of struct(s, kind, e) by start, then kind (an index of KINDS).

    base holds the checked matches of the base kinds, spans these and the additional kinds' spans that the classifier
    gives at least threshold and that overlap no base span.
    """
    c = materialize(candidates(docs), "pii")
    keys = ["kind", *VOTERS, "long", "digits"]
    counted = c.select(F.explode("cands").alias("c")).groupBy(*(F.col(f"c.{k}").alias(k) for k in keys)).agg(F.count("*").alias("n"))
    patterns = sorted(counted.collect(), key=lambda r: tuple(r[k] for k in keys))  # bounded: see the module's text
    score = _score(span_classifier(patterns, reliabilities(patterns)[1]))
    cut = math.log(threshold / (1 - threshold))
    c = c.withColumn("base", F.expr(f"filter(cands, c -> c.kind < {len(BASE)} AND c.shape = 1)"))
    c = c.withColumn("more", F.expr(f"filter(cands, c -> c.kind >= {len(BASE)} AND ({score}) >= {cut!r}D AND NOT exists(base, b -> b.s < c.e AND c.s < b.e))"))
    short = "transform({0}, c -> struct(c.s AS s, c.kind AS kind, c.e AS e))"
    return c.select("doc_id", F.expr(f"sort_array({short.format('base')})").alias("base"), F.expr(f"sort_array({short.format('concat(base, more)')})").alias("spans"))


def spans_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = f"array({', '.join(map(_lit, KINDS))})"
    return F.expr(f"array_join(transform({spans}, c -> concat_ws(':', {names}[c.kind], c.s, c.e)), ',')")


def count_kind(spans: str, kind: str) -> Column:
    return F.expr(f"CAST(size(filter({spans}, c -> c.kind = {KINDS.index(kind)})) AS BIGINT)")


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs (unique doc_id) with text where every span is replaced by <kind>; other columns are kept."""
    spans = find_pii(docs, threshold).select(F.col("doc_id").alias("_id"), F.col("spans").alias("_spans"))
    names = f"array({', '.join(map(_lit, KINDS))})"
    cut = f"""aggregate(_spans, struct(0 AS at, CAST(array() AS array<string>) AS out), (a, c) -> CASE WHEN c.s < a.at THEN a ELSE
      struct(c.e AS at, concat(a.out, array(substr(text, a.at + 1, c.s - a.at), concat('<', {names}[c.kind], '>'))) AS out) END,
      a -> concat(array_join(a.out, ''), substr(text, a.at + 1)))"""
    return docs.join(spans, docs["doc_id"].eqNullSafe(spans["_id"]), "left").withColumn("text", F.expr(f"CASE WHEN size(_spans) > 0 THEN {cut} ELSE text END")).drop("_id", "_spans")
