"""Each operator against a brute-force version on small fixtures, and on the odd cases that its text defines."""

import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import firnlake.llm.brown_lm as brown
import firnlake.llm.ngram_join as join
from firnlake.llm import common, decontam, kn_quality, licenses, mixing, pii, quality_rules, simple8b, toxicity
from firnlake.llm.common import hashed, hashes_of
from firnlake.llm.components import components
from firnlake.llm.lookup import Table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns with names that operators use for their own.
CLASH = ("n_words", "kept", "score", "size", "label", "_id", "key", "n_tokens", "low", "target", "th", "_row", "mix_size")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}") for i, t in rows], SCHEMA)


def odd(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "x", None, "a"), (4, "x", None, "a"), (4, "another text of the same id", "fr", None), (None, "no id at all", "en", "b"), (5, "long " * 30_000, "de", "b"), (6, "é😀" * 5_000, "xx", "b"), (7, "a b c d e f g h", "en", "a"), (8, "a b c d e f g h", "en", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *(F.lit(1).alias(c) for c in CLASH))


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


OPERATORS = {
    "jaccard": lambda s, d: join.jaccard_components(d),
    "pii": lambda s, d: pii.find_pii(d),
    "licenses": lambda s, d: licenses.license_scan(d.withColumn("path", F.concat_ws("/", "source", F.col("doc_id").cast("string")))),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s, [(4, 1, 0), (4, 1, 1), (None, 1, 1), (7, None, None), (8, 0, 1), (99, 1, 1)])),
    "quality_rules": lambda s, d: quality_rules.quality_rules(d),
    "brown": lambda s, d: brown.brown_scores(d),
    "decontam": lambda s, d: decontam.verdicts(d, benchmark(s, [(1, None), (2, "a b c"), (None, "long " * 40), (4, "")])),
    "token_ids": lambda s, d: simple8b.token_ids(d, tokenizer()),
    "kn_quality": lambda s, d: kn_quality.quality(d.select("doc_id", "text", "lang"), labels(s, [(4, 1, 0), (7, 1, 0), (8, 0, 1), (None, 1, 0)])),
    "mixing": lambda s, d: mixing.mix(d.select("doc_id", "text", "source")),
}


WORDS = {1: 0, 2: 0, 3: 0, 5: 30_000, 6: 1, 7: 8, 8: 8}
#: Columns and types of each result, and what it says of the odd rows.
TYPES = {
    "jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "pii": "doc_id bigint, base array<struct<s:int,kind:int,e:int>>, spans array<struct<s:int,kind:int,e:int>>",
    "licenses": "path string, license string, cosine double, license_file boolean, effective_license string, inherited_from string",
    "toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, host_verdict string",
    "brown": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "decontam": "doc_id bigint, contaminated boolean, n_items bigint, n_hits bigint, item_ids array<bigint>",
    "token_ids": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "kn_quality": "doc_id bigint, n_tokens bigint, log_ppl double, low double, high double, kept boolean",
    "mixing": "doc_id bigint, mix_size bigint, mix_source_size bigint, mix_target double, mix_times int",
}


def by_id(rows):
    return {r.doc_id: r for r in rows if r.doc_id != 4}


def odd_jaccard(rows):
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=key) == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (4, 3, 4), (5, 1, 5), (6, 1, 6), (7, 5, 7), (8, 5, 7), (None, 1, None)], key=key)


def odd_pii(rows):
    assert all(r.base == [] and r.spans == [] for r in rows)


def odd_licenses(rows):
    assert all((r.license, r.cosine, r.license_file, r.effective_license, r.inherited_from) == (None, 0.0, False, None, None) for r in rows)


def odd_toxicity(rows):
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def odd_quality_rules(rows):
    got = by_id(rows)
    assert {i: got[i].n_words for i in WORDS} == WORDS and all(got[i].base_failed and not got[i].kept for i in WORDS)
    assert got[5].n_repeat_words == 30_000 and got[6].word_chars == 10_000 and got[None].n_words == 4


def odd_brown(rows):
    got = by_id(rows)
    assert {i: got[i].n_tokens - 1 for i in WORDS} == WORDS and not got[None].held_out
    learned = sum(r.n_tokens for r in rows if not r.held_out)
    assert all(r.train_tokens == learned and r.n_known <= r.n_tokens and r.score < 0 and r.base_score < 0 for r in rows)
    assert got[1].score == got[2].score == got[3].score and got[1].base_score == got[3].base_score


def odd_decontam(rows):
    got = by_id(rows)
    assert {i for i, r in got.items() if r.contaminated} == {5, 7, 8} and not any(r.contaminated for r in rows if r.doc_id == 4)
    assert (got[7].n_items, got[7].n_hits, got[7].item_ids) == (1, 1, [2]) and (got[5].n_items, got[5].item_ids) == (1, [])
    assert got[5].n_hits == (30_000 - 11) * 29 and (got[1].n_items, got[1].n_hits, got[1].item_ids) == (0, 0, [])


def odd_token_ids(rows):
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 4, 5, 6, 7, 8]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    empty = zlib.crc32(np.array([1], dtype="<u4").tobytes())
    assert [(r.n_tokens, r.ids_crc32) for r in rows if r.doc_id in (1, 2)] == [(1, empty)] * 2 and by_id(rows)[7].ids_crc32 == by_id(rows)[8].ids_crc32


def odd_kn_quality(rows):
    got = by_id(rows)
    assert {i: got[i].n_tokens for i in WORDS} == WORDS and all(got[i].log_ppl is None and not got[i].kept for i in (1, 2, 3))
    assert got[6].kept and got[None].kept and got[7].log_ppl == got[8].log_ppl and all(r.log_ppl is None or r.log_ppl > 0 for r in rows)


def odd_mixing(rows):
    got = by_id(rows)
    assert {i: got[i].mix_size for i in WORDS} == WORDS and all(0 <= r.mix_times <= 3 for r in rows)
    for source in (None, "a", "b"):
        own = [r for r in rows if r.source == source]
        assert {r.mix_source_size for r in own} == {sum(r.mix_size for r in own)} and len({r.mix_target for r in own}) == 1


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_each_get_an_answer(spark, name):
    df = odd(spark)
    out = OPERATORS[name](spark, df)
    rows = out.collect()
    assert len(rows) == df.count()
    globals()[f"odd_{name}"](rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_result(spark, name):
    out = OPERATORS[name](spark, odd(spark).limit(0))
    assert out.count() == 0
    assert set(TYPES[name].split(", ")) <= {f"{n} {t}" for n, t in out.dtypes}, out.dtypes


def test_stages_keep_columns_of_any_name(spark):
    df = odd(spark)
    for stage in (lambda d: kn_quality.keep_good(d, labels(spark, [(7, 1, 0), (8, 1, 0)])), join.one_of_each, lambda d: decontam.decontaminate(d, benchmark(spark, [(1, "a b c")])), mixing.repeat_documents):
        out = stage(df)
        assert out.columns == df.columns
        out.collect()


# ---- words


def test_hashed_words_are_those_of_each_text(monkeypatch):
    import pyarrow as pa

    import firnlake.llm.common as common

    monkeypatch.setattr(common, "HASHED_BYTES", 64)
    rng = random.Random(10)
    texts = ["".join(rng.choice("aBcdé😀 \n\x0b\x1c\xa0") for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "x" * 1000, "y" * 300 + " " + "y" * 300 + "z", "ABCDEFGH abcdefgh", " "]
    for lower in (True, False):
        seen, at = {}, 0
        column = pa.array(["skipped", *texts]).slice(1)
        for bounds, h in hashed(column, lower):
            for a, b in zip(bounds[:-1], bounds[1:]):
                words = (texts[at] or "").encode().split()
                assert b - a == len(words)
                for w, x in zip(words, h[a:b].tolist()):
                    assert seen.setdefault(w.lower() if lower else w, x) == x
                at += 1
        assert at == len(texts) and len(set(seen.values())) == len(seen)
    assert next(iter(hashed(pa.array([], pa.string()))), None) is None
    shape = hashes_of([b"abc", b"abcdefghijklmnopqrst"], shaped=True) & np.uint64(31)
    assert shape.tolist() == [ord("c") % 8, 24 + ord("t") % 8]


# ---- 1: similarity join


def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = [x.decode() for x in (t or "").encode().lower().split()]
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for a in names:
        for b in names:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in names)


@pytest.mark.parametrize(("k", "percent", "block"), [(4, 85, 50_000), (2, 60, 15)])
def test_join_finds_every_link(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(join, "HOT_ROWS", block)
    monkeypatch.setattr(join, "DEALT", 20)
    monkeypatch.setattr(join, "TILE", 40 * block)
    rng = random.Random(7)
    base = [[f"{rng.choice('abcdefgh')}{rng.randint(0, 20)}" for _ in range(rng.choice([2, 4, 9, 30, 80]))] for _ in range(40)]
    rows = []
    for i in range(700):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 300)}"
        rows.append((i, " ".join(w)))
    got = sorted(tuple(r) for r in join.jaccard_components(frame(spark, rows), k, percent).collect())
    assert got == brute_components(rows, k, percent)


def test_join_counts_in_bounded_memory(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(join, "COUNTED", 1 << 16, raising=False)
    monkeypatch.setattr(common, "HASHED_BYTES", 1 << 16)
    tasks = []

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, count, schema):  # noqa: N802
            tasks.append(count)
            raise StopIteration

    with pytest.raises(StopIteration):
        join.frequent_shingles(Docs(), 4)
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(map(str, rng.integers(0, 1000, 300))) for _ in range(4000)])
    tracemalloc.start()
    for b in tasks[0](iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
        assert b.num_columns == 3
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20  # 4,000 x 297 shingles are 9.5 MB, and were held several times


def test_join_counts_are_those_of_many_batches(spark, monkeypatch):
    monkeypatch.setitem(common.TIDY, "spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    monkeypatch.setattr(join, "HOT_ROWS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        docs = frame(spark, [(i, f"w{i % 10} and x{i}") for i in range(60)]).coalesce(1)
        assert join.frequent_shingles(docs, 4)[2].get(hashes_of([b"w7", b"and", b"x3"])).tolist() == [6, 60, 0]
        rows = spark.createDataFrame([(bytearray(np.array([5, 100 + i], dtype=np.uint64).tobytes()),) for i in range(60)], "prefix binary").coalesce(1)
        hot, blocks = join.hot_keys(rows)
        assert (hot.tolist(), blocks.tolist()) == ([5], [4])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_join_gives_its_tasks_few_rows_at_a_time(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(join, "materialize", lambda df, what, **kw: seen.setdefault(what, []).append(kw.get("tidy", False)) or common.materialize(df, what, **kw))
    join.jaccard_components(frame(spark, [(i, f"a b c d e f g h x{i // 2}") for i in range(30)]))
    for what in ("frequent", "members", "keys", "meetings", "candidates", "links"):
        assert seen[what] == [True], what


def test_bounds_never_drop_a_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 1500))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 63, int(rng.integers(0, 20)), dtype=np.uint64)]))
        if join.links(a, b, 85):
            bound = join.Points([join.point(x).tobytes() for x in (a, b)]).bound(np.array([0]), np.array([1]))[0]
            assert bound >= len(np.intersect1d(a, b)) and 185 * bound >= 85 * (len(a) + len(b))
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (10, 3000, 20, 700)]
    points = join.Points([join.point(x).tobytes() for x in sets])
    for rows in ([0, 2], [1, 3], [3, 0, 1], []):
        assert points.coarse(np.array(rows, dtype=np.int64)).sum(1).tolist() == [len(sets[r]) for r in rows]
    same = np.arange(1000, dtype=np.uint64) << np.uint64(20)  # all in one group, beyond what a byte counts
    assert join.Points([join.point(same).tobytes()] * 2).bound(np.array([0]), np.array([1]))[0] >= 1000


def test_tree_pairs_are_those_of_all_rows():
    rng = np.random.default_rng(5)
    n = rng.integers(20, 60, 500)
    pts = rng.multinomial(40, np.ones(join.GROUPS) / join.GROUPS, 500)
    label = np.where(rng.random(500) < 0.5, 7, np.arange(500) + 100)
    i, j = (np.concatenate(x) for x in zip(*join.tree_pairs(n, pts, label, 60), strict=True))
    lo, hi = np.minimum.outer(n, n), np.maximum.outer(n, n)
    bound = np.minimum(pts[:, None], pts[None]).sum(2)
    full = np.triu((100 * lo >= 60 * hi) & (160 * bound >= 60 * (lo + hi)) & (label[:, None] != label[None, :]), 1)
    assert {tuple(sorted(x)) for x in zip(i, j, strict=True)} == set(zip(*np.nonzero(full), strict=True))


def test_labels_of_a_block_are_joined_as_by_all_pairs():
    rng = np.random.default_rng(11)
    bases = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.06], rng.integers(0, 1 << 63, 3, dtype=np.uint64)])) for b in bases for _ in range(40)]
    label = np.where(rng.random(240) < 0.3, 5, 100 + np.arange(240))
    for part in (np.zeros(240, np.int64), np.arange(240) % 2):
        got, want = join.Labels(label), join.Labels(label)
        place = {x: i for i, x in enumerate(label.tolist())}
        for a, b in join.linked_labels(label, part, sets, 80):
            got.join(place[a], place[b])
        for a in range(240):
            for b in range(a):
                if join.links(sets[a], sets[b], 80) and (part[a] != part[b] or not part.any()):
                    want.join(a, b)
        assert (got.root == want.root).all() and len(np.unique(got.root)) < 200


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 0 for i in range(1, 30)}, 201: 200}


# ---- 2: personal data

BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    out = []
    for kind, regex in enumerate(BASE):
        for m in re.finditer(regex, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = (True, all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0, 10 <= len(digits) <= 15)[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(2)
    alphabet = "ab1 .@-+()9é😀_%:\n0255"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 100)))) for i in range(400)]
    rows += [(1000, "1.2.3.4.5.6.7.8 a@b.cc_d@e.ff 4111 1111 1111 1111 +1 (212) 555-0199"), (1001, "a@" + "b." * 2000 + "c"), (1002, "1" * 2000)]
    got = {r.doc_id: [tuple(x) for x in r.base] for r in pii.find_pii(frame(spark, rows)).collect()}
    assert got == {i: brute_spans(t) for i, t in rows}


def test_more_spans_are_added_and_base_ones_stay(spark):
    text = 'Dr. Anna Smith, ssn 123-45-6789, api key = "a9f8e7d6c5b4a3928170ffee00", mail x@y.org'
    row = pii.find_pii(frame(spark, [(1, text), (2, "nothing at all here")])).orderBy("doc_id").first()
    kinds = {pii.KINDS[x.kind] for x in row.spans}
    assert {"email", "secret", "national_id"} <= kinds and set(row.base) <= set(row.spans)
    assert "x@y.org" not in pii.redact(frame(spark, [(1, text)])).first().text


def brute_votes(t):
    """Candidates (kind, start, end), votes in the order of VOTERS, and buckets, of a text."""
    import regex

    found = [(k, m.start(), m.end(), m[0]) for k, r in enumerate(pii.BASE.values()) for m in regex.finditer(r, t)]
    for m in regex.finditer("|".join(f"(?:{b}{x}{a})" for b, x, a in pii.MORE.values()), t):
        kind = next(i for i, (_, x, _) in enumerate(pii.MORE.values()) if regex.fullmatch(x, m[0]))
        found.append((4 + kind, m.start(), m.end(), m[0]))
    valid_base, out = brute_spans(t), []
    for k, s, e, m in found:
        digits = re.sub("[^0-9]", "", m)
        year = re.search("[12][0-9]{3}", m)
        valid = [None] * 4 + [not re.match("000|666|9", m) and not re.search("-00-|-0000$", m), 15 <= len(m.replace(" ", "")) <= 34, digits[:1] not in "01", bool(year) and "1900" <= year[0] <= "2030", bool(re.search("[0-9]", m)) and bool(re.search("[A-Za-z]", m)) and len(set(m)) >= 8, True]
        shape = (s, k, e) in valid_base if k < 4 else valid[k]
        known = {0: int(bool(re.search(r"[.](com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|ch|at|us)$", m.lower()))), 1: -int(bool(re.match(r"(0|127|255)[.]", m))), 2: 1 if re.match("4|5[1-5]|2[2-7]|3[47]|6", m) else -1}
        known[3] = 1 if re.match(r"[+](1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])", m) else -1
        known[5] = 1 if re.match("DE|FR|ES|IT|GB|NL|BE|AT|CH|PT|IE|PL|SE|DK|FI|NO|LU", m) else -1
        known[8] = int(bool(re.match("AKIA|ghp_|sk-|xox|eyJ", m)))
        cue = re.search(pii.CUES[pii.KINDS[k]], t[max(0, s - 32) : s].lower()) is not None
        fake = re.search(r"(?i)x{4}|0{6}|123456|(.)\1{6}", m) is not None
        free = not (s and t[s - 1].isalnum()) and not (e < len(t) and t[e].isalnum())
        bucket = sum(e - s >= n for n in (12, 17, 30))
        out.append(((k, s, e), (1 if shape else -1, known.get(k, 0), int(cue), -int(fake), 1 if free else -1), (bucket, min(3, 4 * len(digits) // (e - s)))))
    return out


def test_added_spans_equal_brute_force(spark):
    rng = random.Random(21)
    pieces = ["ssn 123-45-6789", "000-12-3456", "iban DE89370400440532013000", "XX00 1234 5678 9012 3456", "call (212) 555-0199", "111-222-3333", "born 12/05/1980", "99/99/2999", "token a9f8e7d6c5b4a3928170ffee00", "aaaaaaaaaaaaaaaaaaaaaaa1", "sk-1234567890abcdefghij", "Dr. Anna Smith", "name Mr. Bob Stone", "mail x@y.org", "a@b.zz", "10.0.0.1", "999.1.1.1", "card 4111 1111 1111 1111", "1234 5678 9012 3456 7", "+1 (212) 555-0199", "+999 1", "plain words", "x1980-02-30y"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(150)]
    cands = [brute_votes(t) for t in texts]
    counts = collections.Counter((c[0], v, b) for found in cands for c, v, b in found)
    kinds, votes, n = [p[0] for p in counts], np.array([p[1] for p in counts]), np.array(list(counts.values()), dtype=float)
    post = 1 / (1 + np.exp(-1.5 * votes.sum(1)))
    for _ in range(40):
        weight = np.stack([(1 - post) * n, post * n])
        prior = np.ones((10, 2))
        np.add.at(prior, kinds, weight.T)
        like = np.log(prior[kinds, 1] / prior[kinds, 0])
        for v in range(5):
            seen = 1 + np.array([[weight[z][votes[:, v] == x].sum() for x in (-1, 0, 1)] for z in (0, 1)])
            seen /= seen.sum(1, keepdims=True)
            like += np.log(seen[1] / seen[0])[votes[:, v] + 1]
        post = 1 / (1 + np.exp(-np.clip(like, -30, 30)))
    names = sorted({f for k, v, b in counts for f in enumerate((k, *b, *v))})
    x = np.array([[f in set(enumerate((k, *b, *v))) for f in names] for k, v, b in counts], dtype=float)
    w = np.zeros(len(names))
    for _ in range(300):
        w = w + 0.5 * 4 * (x.T @ ((post - 1 / (1 + np.exp(-x @ w))) * n / n.sum()) - 1e-3 * w)
    chosen = dict(zip(counts, x @ w))
    # a threshold between the two log odds that are farthest apart
    odds = sorted({round(v, 9) for (k, _, _), v in chosen.items() if k >= 4})
    gap, cut = max((y - x, (x + y) / 2) for x, y in zip(odds, odds[1:]))
    assert gap > 1e-3
    found = pii.find_pii(frame(spark, list(enumerate(texts))), threshold=1 / (1 + math.exp(-cut)))
    got = {r.doc_id: [tuple(y) for y in r.spans] for r in found.collect()}
    for i, t in enumerate(texts):
        base = brute_spans(t)
        more = [(s, k, e) for (k, s, e), v, b in cands[i] if k >= 4 and chosen[k, v, b] >= cut and not any(bs < e and s < be for bs, _, be in base)]
        assert got[i] == sorted(base + more), t


# ---- 3: licences


def brute_license(texts):
    """Licence and cosine of each text: every unit, written out by hand, against every template, with the df of all words."""
    word = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
    df = collections.Counter(w for t in texts for w in set(word.findall(t.lower())))
    templates = [(n, t) for table in (licenses.TEMPLATES, licenses.TEXTS) for n, ts in table.items() for t in ts]

    def vector(t):
        return {w: c * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, c in collections.Counter(word.findall(t.lower())).items()}

    def cosine(x, y):
        return sum(a * y.get(w, 0) for w, a in x.items()) / (math.sqrt(sum(a * a for a in x.values()) * sum(a * a for a in y.values())) or 1)

    vectors, out = [(n, vector(t)) for n, t in templates], []
    for text in texts:
        lines, groups = text.split("\n"), [[]]
        for line in lines:
            bare = line.strip(" \t\r#*/;%-")
            if bare or line is lines[0] or line is lines[-1]:
                groups[-1].append(line.strip().strip("#*/%").strip() if not line.startswith(";") else line.strip("; "))
            else:
                groups.append([])
        paragraphs = [" ".join(g) for g in groups]
        found = [s for x in lines for s in re.split(r"(?<=[.!?;])\W*\s+", x)] + [s for p in paragraphs for s in re.split(r"(?<=[.!?])\W*\s+", p)] + paragraphs + [" ".join(paragraphs)]
        out.append(min((-round(cosine(vector(u), v), 7), n) for u in found for n, v in vectors))
    return [(n, -c) if c <= -0.6 else (None, 0.0) for c, n in out]


def test_license_cosine_equals_brute_force(spark):
    notices = [t for table in (licenses.TEMPLATES, licenses.TEXTS) for ts in table.values() for t in ts]
    texts = [f"Some words. {t}\nlast line of it" for t in notices] + ["the of and license", "plain prose", ""]
    texts += ["# " + "\n# ".join(" ".join(t.split()[i : i + 9]) for i in range(0, len(t.split()), 9)) + "\n#\n# other words about it" for t in notices]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    got = {int(r.path): r for r in licenses.scan(files).collect()}
    for i, (name, cosine) in enumerate(brute_license(texts)):
        assert got[i].license == name and abs(got[i].cosine - cosine) < 1e-6, texts[i]


def test_wrapped_notices_and_licence_files_are_found(spark):
    header = "/* This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n * as published by the Free Software Foundation; either version 2\n * of the License, or (at your option) any later version.\n */\nint main() { return 0; }"
    mit = licenses.TEXTS["MIT"][0].split()
    whole = "Copyright (c) 2020 Some Body\n\n" + "\n".join(" ".join(mit[i : i + 10]) for i in range(0, len(mit), 10))
    rows = [("a/main.c", header), ("a/other.c", "Licensed under the GNU General Public\nLicense, version 3"), ("b/terms.txt", whole), ("b/x/y.c", "code"), ("c/z.c", "code"), *((f"d/{i}", "everyday words of the public and a general work") for i in range(60))]
    got = {r.path: r for r in licenses.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/main.c"].license == "GPL-2.0" and got["a/other.c"].license == "GPL-3.0"
    assert got["b/terms.txt"].license == "MIT" and got["b/terms.txt"].license_file and got["b/x/y.c"].effective_license == "MIT"
    assert got["c/z.c"].effective_license is None and got["d/1"].license is None


def test_license_cosine_uses_the_df_of_all_words(spark):
    texts = ["The everyday useful work is licensed under CC BY 4.0", "everyday useful all rights reserved", *["the everyday useful work is by under"] * 300]
    files = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r.path: r for r in licenses.scan(files).collect()}
    assert len(got) == len(texts) and got["f0"].license == "CC-BY-4.0" and got["f1"].license == "Proprietary" and got["f9"].license is None
    for i, (_, cosine) in enumerate(brute_license(texts[:3] + texts[3:])[:2]):
        assert math.isclose(got[f"f{i}"].cosine, cosine, abs_tol=1e-6)


def test_ties_of_licences_take_the_first_name(spark):
    rows = [("d/LICENSE", "All rights reserved"), ("d/COPYING", "Released under the MIT License"), ("d/x", "code"), ("e/COPYING", "Released under the MIT License"), ("e/LICENSE", "All rights reserved"), ("e/x", "code")]
    got = {r.path: r for r in licenses.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["d/LICENSE"].cosine == got["d/COPYING"].cosine == 1.0
    assert got["d/x"].effective_license == got["e/x"].effective_license == "MIT" and got["d/x"].inherited_from == "d"


def test_license_is_inherited_from_the_nearest_directory(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code"), ("a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("a/b/c/d/e.py", None), ("a/q.py", "code"), ("top.py", "x"), ("ab/z.py", "x")]
    got = {r.path: (r.effective_license, r.inherited_from) for r in licenses.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/b/c/d/e.py"] == ("GPL-3.0", "a/b/c") == got["a/b/c/x.py"]
    assert got["a/q.py"] == ("MIT", "a") and got["top.py"] == got["ab/z.py"] == (None, None)


# ---- 4: toxicity


def test_toxicity_on_held_out_rows(spark):
    docs, marks = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    got = toxicity.toxicity(docs, marks).join(marks, "doc_id").filter("held_out").toPandas()
    bad, good = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    assert (bad[:, None] > good[None, :]).mean() + 0.5 * (bad[:, None] == good[None, :]).mean() > 0.85
    assert (got[got.toxic == 0].predicted == 0).mean() > 0.97


def test_label_model_equals_a_plain_one():
    rng = random.Random(3)
    votes = [[rng.choice((-1, 0, 1, 1 if y else -1)) for _ in range(4)] for y in (0, 1) * 20]
    labels_ = [y if rng.random() < 0.9 else 1 - y for y in (0, 1) * 20]
    table, corr, post = toxicity.label_model(np.array(votes), np.array(labels_), rounds=7, trust=0.9)

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    prior = [math.log(9) if y else -math.log(9) for y in labels_]
    p = [sigmoid(o + sum(max(0, v) for v in row) - 1) for o, row in zip(prior, votes)]
    for _ in range(7):
        chance = {}
        for z in (0, 1):
            weight = [x if z else 1 - x for x in p]
            for v in range(4):
                seen = {k: 0.5 + sum(w for w, row in zip(weight, votes) if row[v] == k) for k in (-1, 0, 1)}
                chance |= {(z, v, k): n / sum(seen.values()) for k, n in seen.items()}
        base = min(max(sum(p) / len(p), 0.005), 0.5)
        mean = {(z, v): chance[z, v, 1] - chance[z, v, -1] for z in (0, 1) for v in range(4)}
        rest = [[row[v] - (x * mean[1, v] + (1 - x) * mean[0, v]) for v in range(4)] for x, row in zip(p, votes)]
        cov = [[sum(r[a] * r[b] for r in rest) / len(rest) for b in range(4)] for a in range(4)]
        c = [[1.0 if a == b else cov[a][b] / math.sqrt(max(cov[a][a], 1e-6) * max(cov[b][b], 1e-6)) for b in range(4)] for a in range(4)]
        share = [1 / max(1, sum(min(1, max(0, x)) for x in c[v])) for v in range(4)]
        p = [sigmoid(math.log(base / (1 - base)) + sum(share[v] * math.log(chance[1, v, row[v]] / chance[0, v, row[v]]) for v in range(4)) + o) for o, row in zip(prior, votes)]
    assert np.allclose(post, p) and np.allclose(corr, c)
    assert all(math.isclose(table[z][v][k + 1], chance[z, v, k]) for z in (0, 1) for v in range(4) for k in (-1, 0, 1))


def test_linear_classifier_is_at_its_optimum():
    rng = np.random.default_rng(2)
    x, y = np.column_stack([rng.normal(size=(80, 3)), np.ones(80)]), rng.random(80)
    w = toxicity.linear_classifier(x, y)
    gradient = [sum((y[i] - 1 / (1 + math.exp(-sum(x[i] * w)))) * x[i][j] for i in range(80)) - w[j] for j in range(4)]
    assert max(map(abs, gradient)) < 1e-6


def test_mined_words_are_counted_by_groups(spark):
    def own(mark, i):
        return " ".join(f"{mark}{chr(97 + i % 26)}{chr(97 + j)}{chr(97 + i // 26)}" for j in range(12))

    rows = [(f"{own('f', i)} common vile{'s' if i % 2 else ''}", 1) for i in range(40)] + [(f"{own('g', i)} common", 0) for i in range(100)] + [("copied rare words", 1)] * 20
    mined = toxicity.mine_words(spark.createDataFrame(rows, "text string, toxic int"), 100)
    assert {"vile", "viles"} <= set(mined) and not {"common", "copied", "rare", "faaa"} & set(mined)


# ---- 5: rules


def brute_rules(text):
    words = WORD.findall(text or "")
    places = collections.defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {x for v in places.values() if len(v) > 1 for i in v for x in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rules_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a", "b", "c#", "d\n"]) for _ in range(rng.randint(0, 60)))) for i in range(150)] + [(900, None), (901, "x\ny\nx\n\n"), (902, "é 😀|")]
    rows += [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for r in quality_rules.quality_rules(frame(spark, rows)).collect():
        n, chars, symbols, dup, rep = brute_rules(dict(rows)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n) and not (r.kept and r.base_failed)


def test_hosts_are_shrunk_and_a_bad_host_goes(spark):
    good, junk = " ".join(f"word{i}" for i in range(40)), "a # # #"
    rows = [(i, good, "en", "fine") for i in range(300)] + [(1000 + i, junk, "en", "bad") for i in range(300)] + [(2000, good, "en", "bad"), (3000, good, "en", "tiny")]
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[0].kept and out[3000].kept and not out[2000].kept and out[2000].host_verdict == "bad"
    assert 0 < out[0].failure_rate < 0.1 < out[3000].failure_rate < 0.9 < out[1000].failure_rate < 1


# ---- 6: class model


def test_class_model_counts_and_scores(spark, monkeypatch):
    monkeypatch.setattr(brown, "HELD", 40)  # most words take the joined path
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in brown.brown_scores(frame(spark, rows), classes=16).collect()}
    tokens = {i: [*t.encode().lower().split(), None] for i, t in rows}
    counts = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ws), sum(w in counts for w in ws), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)


def test_class_model_beats_the_base_on_held_out_rows(spark):
    got = brown.brown_scores(spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_class_model_sums_to_one(spark):
    rows = frame(spark, [(1, "a b a c"), (2, "a b b a"), (3, "c a b dd")])
    model, _ = brown.fit(rows.filter("doc_id > 0"), classes=2)
    steps = 10 ** model.steps
    assert np.allclose(steps[:, :].sum(1)[steps.sum(1) > 0], 1, atol=1e-6)
    for c in set(model.of[: len(model.core)].tolist()):
        assert math.isclose((10 ** model.core_share[model.of[: len(model.core)] == c]).sum(), 1, rel_tol=1e-9)


def test_words_outside_the_core_are_clustered_and_scored(spark, monkeypatch):
    monkeypatch.setattr(brown, "CORE", 6)
    monkeypatch.setattr(brown, "HELD", 8)  # most words take the joined path
    rng = random.Random(8)
    left, right = [f"l{i}" for i in range(12)], [f"r{i}" for i in range(12)]  # the two always alternate
    rows = [(i, " ".join(rng.choices(x, range(13, 1, -1))[0] for _ in range(15) for x in (left, right))) for i in range(200)] + [(500, "l1 once l2 unseen")]
    model, words = brown.fit(frame(spark, rows), classes=2)
    of = {r.h: r.cls for r in words.collect()}
    got = [[of[h] for h in hashes_of([w.encode() for w in x], shaped=True).view(np.int64).tolist()] for x in (left, right)]
    assert len(words.filter("c > 1 AND cls >= 2").collect()) == 0
    assert len(set(got[0])) == 1 and len(set(got[1])) == 1 and got[0][0] != got[1][0]
    out = {r.doc_id: r for r in brown.brown_scores(frame(spark, rows), classes=2).collect()}
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    model, words = brown.fit(frame(spark, train), classes=2)
    of = {r.h: (r.c, r.cls) for r in words.collect()}
    k = len(model.steps)

    def classes(t):
        h = np.append(hashes_of(t.encode().split(), shaped=True), brown.END)
        return [of.get(int(x), (0, 2 + int(x) % 32)) for x in h.view(np.int64)]

    joint = np.zeros((k, k))
    for _, t in train:
        c = [k - 1, *(x for _, x in classes(t))]
        np.add.at(joint, (c[:-1], c[1:]), 1)
    steps = brown.transitions(joint, 5.0)
    for i, t in rows:
        seq, total, before = classes(t), 0.0, k - 1
        for c, cls in seq:
            size, types = model.class_total[cls], model.class_types[cls]
            share = (c - (model.discount if cls >= 2 else 0)) / size if c else model.discount * types / size / (types + 1) if size else 1 / (model.v + 1)
            total += steps[before, cls] + math.log10(share)
            before = cls
        assert math.isclose(out[i].score, total, rel_tol=1e-9)


def test_exchange_finds_the_classes_of_a_toy_language():
    rng = np.random.default_rng(1)
    size, counts = 12, np.zeros((13, 13))
    for w in rng.integers(0, size, 4000):  # words 0-5 are always followed by 6-11 and these by 0-5
        counts[w, (rng.integers(6, 12) if w < 6 else rng.integers(0, 6))] += 1
    of = brown.exchange(counts, size, 2)
    assert len(set(of[:6])) == 1 and len(set(of[6:12])) == 1 and of[0] != of[6]


# ---- 7: decontamination


def test_passages_are_found_with_substitutions(spark):
    rng = random.Random(9)
    item = [f"w{rng.randint(0, 500)}" for _ in range(40)]
    changed = [w if i % 9 else "other" for i, w in enumerate(item)]
    noise = " ".join(f"n{rng.randint(0, 500)}" for _ in range(60))
    rows = [(1, f"{noise} {' '.join(item).upper()}, {noise}"), (2, f"{noise} {' '.join(changed)} {noise}"), (3, noise), (4, " ".join(item[:8]) + " " + noise), (5, " ".join(item[5:35])), (6, f"{noise} tiny exact item {noise}"), (7, "tiny other item")]
    got = {r.doc_id: r for r in decontam.verdicts(frame(spark, rows), benchmark(spark, [(10, " ".join(item)), (11, "Tiny exact item!"), (12, " ".join(item))])).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {1, 2, 5, 6} and got[1].item_ids == [10] and got[6].item_ids == [11]


def test_every_occurrence_in_an_item_is_a_hit(spark):
    def words(mark, n):
        return [f"{mark}{i}" for i in range(n)]

    w, b, c = words("w", 12), words("b", 6), words("c", 6)
    item = [*words("u", 20), *w, *words("v", 20), *b, *w, *c, *words("t", 20)]
    doc = [*words("z", 10), *b[:4], "x", "x", *w, "y", "y", *c[2:], *words("q", 10)]  # around the second occurrence
    got = decontam.find_contaminated(frame(spark, [(1, " ".join(doc))]), benchmark(spark, [(5, " ".join(item))])).collect()
    assert [(r.doc_id, r.item_id, r.matched) for r in got] == [(1, 5, 20)]


def test_a_run_of_equal_tokens_and_an_item_without_an_id(spark):
    item = [f"i{x}" for x in range(60)]
    noise = [f"n{x}" for x in range(40)]
    rows = [(1, " ".join(noise + item[20:33] + noise)), (2, " ".join(noise + item[20:32] + noise)), (3, " ".join(noise)), (4, None), (None, " ".join(item))]
    got = {r.doc_id: r for r in decontam.verdicts(frame(spark, rows), benchmark(spark, [(None, " ".join(item)), (None, None), (7, "")])).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {1, None} and got[1].n_items == 1 and got[1].item_ids == []


def test_hits_equal_brute_force(spark):
    rng = random.Random(12)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    some = [" ".join(f"r{rng.randint(0, 2)}" for _ in range(n)) for n in (3, 11, 12, 40, 70)]  # repetitive ones, and short ones
    items += [(90_000 + i, t) for i, t in enumerate(some)]
    docs += [(90_000 + i, f"{' '.join(f'r{rng.randint(0, 2)}' for _ in range(30))} {some[i % 5]} end") for i in range(20)]

    def tokens(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    found = decontam.find_contaminated(frame(spark, docs), benchmark(spark, items))
    got = sorted((r.doc_id, r.item_id, r.n_hits, r.matched, round(r.best_share, 9)) for r in found.collect())
    expected = []
    for i, t in docs:
        th = tokens(t)
        for j, u in items:
            b, hits = tokens(u), []
            starts = collections.defaultdict(list)
            masks = [(m, decontam.SPAN) for m in decontam.MASKS] if len(b) >= 12 else [(tuple(range(len(b))), len(b))]
            for m, span in masks:
                for y in range(len(b) - span + 1):
                    starts[m, tuple(b[y + k] for k in m)].append(y)
            places = {(x, y) for m, span in masks for x in range(len(th) - span + 1) for y in starts.get((m, tuple(th[x + k] for k in m)), ())}
            for x, y in places:
                low, high = max(0, y - x, y - 6), min(len(b), len(th) + y - x, y + 18)
                same = "".join("01"[b[z] == th[z + x - y]] for z in range(low, high))
                if same.count("1") >= 0.75 * len(same) or "1" * 13 in same:
                    hits.append((same.count("1"), same.count("1") / len(same)))
            if hits:
                expected.append((i, j, len(hits), max(x for x, _ in hits), round(max(x for _, x in hits), 9)))
    assert got == sorted(expected)


# ---- 8: token ids


@pytest.mark.parametrize("n", [0, 1, 2, 59, 60, 61, 3000])
@pytest.mark.parametrize("top", [1, 2, 50, 49_408, 1 << 33, (1 << 64) - 1])
def test_simple8b_round_trip(n, top):
    rng = np.random.default_rng(n + top % 1000)
    ids = rng.integers(0, top, n, dtype=np.uint64)
    ids[: n // 3] = rng.integers(0, 2, n // 3)
    words, escaped = simple8b.pack(ids)
    assert (simple8b.unpack(words, escaped, n) == ids).all()


def test_blocks_keep_documents_apart():
    docs = [np.array(x, dtype=np.uint64) for x in ([5, 6], [], [1 << 62, 3])]
    offsets, ids = simple8b.read_block(simple8b.write_block(docs))
    assert offsets.tolist() == [0, 2, 2, 4] and ids.tolist() == [5, 6, 1 << 62, 3]
    with pytest.raises(ValueError, match="whole"):
        simple8b.read_block(simple8b.write_block(docs)[:-1])


def test_ids_are_those_of_the_tokenizer(spark):
    encoder = simple8b._encoder(tokenizer())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(9000, "it's \x1c\x85\xa0 ok <|endoftext|>x <|ENDOFTEXT|> İΣΑΣ ß é 漢字12²'S don't"), (9001, "\t\n "), (9002, None), (9003, "½x_y--z… é")]
    at = 0
    for r, (i, t) in zip(simple8b.token_ids(frame(spark, rows), tokenizer(), with_ids=True).orderBy("start").collect(), sorted(rows), strict=True):
        ids = [*encoder.tok.encode(t or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)


def test_words_whose_lower_case_has_marks():
    encoder = simple8b._encoder(tokenizer())
    for text in ("İstanbul", "İ", "xİy İ. aİ1 plain"):
        assert np.frombuffer(encoder(text), dtype=np.uint32).tolist() == encoder.tok.encode(text, add_special_tokens=False).ids


def test_pack_takes_the_most_ids_that_fit():
    rng = random.Random(3)
    for _ in range(60):
        n, top = rng.randint(0, 200), rng.choice([1, 4, 9, 17, 31, 33, 60, 61, 64])
        ids = [rng.getrandbits(rng.randint(1, top)) for _ in range(n)]
        words, escaped = simple8b.pack(np.array(ids, dtype=np.uint64))
        sels, at = [], 0
        while at < n:
            of = [s for s in range(1, 15) if at + simple8b.COUNTS[s] <= n and all(x >> simple8b.WIDTHS[s] == 0 for x in ids[at : at + simple8b.COUNTS[s]])]
            sels.append(max(of, default=0))
            at += simple8b.COUNTS[sels[-1]]
        assert (words >> np.uint64(60)).tolist() == sels
        assert simple8b.unpack(words, escaped, n).tolist() == ids


# ---- 9: quality classifier


def test_kneser_ney_sums_to_one(spark):
    model = kn_quality.train(spark.createDataFrame([("a b a c",), ("a b b a",), ("c a b",)], "text string"))
    words = [*hashes_of([b"a", b"b", b"c", b"zz"], lower=False), kn_quality.END]
    for u in words[:3]:
        for v in words[:3]:
            p = 10 ** model.log10(*(np.array(x, dtype=np.uint64) for x in ([u] * 5, [v] * 5, words)))
            assert math.isclose(p.sum(), 1, rel_tol=1e-5)


def test_all_trusted_rows_are_counted(spark, monkeypatch):
    monkeypatch.setattr(kn_quality, "HELD", 50)  # most n-grams take the joined path
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(40)], k=rng.randint(1, 6)) + [f"own{i}"])) for i in range(1800)] + [(1, "new words w1"), (5000, None)]
    marks = [(i, int(i < 1700), 0) for i in range(1800)]
    seqs = [["<", "<", *t.split(), ">"] for i, t in rows if t and i < 1700 and zlib.crc32(str(i).encode()) % 5]
    assert len(seqs) > 1300
    tri = collections.Counter(x for s in seqs for x in zip(s, s[1:], s[2:]))
    bi = collections.Counter(x[1:] for x in tri)
    uni = collections.Counter(x[1:] for x in bi)

    def order(counts):
        n = [0, *(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0
        d = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 1.5, 0.05), k - 0.05) for k in (1, 2, 3)] if y else [0.5, 0.75, 0.9]
        total, freed = collections.Counter(), collections.Counter()
        for x, c in counts.items():
            total[x[:-1]] += c
            freed[x[:-1]] += d[min(c, 3) - 1]
        return lambda x, below: max(0, counts[x] - d[min(max(counts[x], 1), 3) - 1]) / total[x[:-1]] + freed[x[:-1]] / total[x[:-1]] * below if total[x[:-1]] else below

    orders = [order(x) for x in (uni, bi, tri)]
    got = kn_quality.quality(frame(spark, rows).select("doc_id", "text", "lang"), labels(spark, marks)).collect()
    assert len(got) == len(rows)
    for r in got:
        s, total = ["<", "<", *(r.text or "").split(), ">"], 0.0
        for x in zip(s, s[1:], s[2:]):
            p = 1 / (len(uni) + 1)
            for k, o in enumerate(orders):
                p = o(x[2 - k :], p)
            total -= math.log10(p)
        assert r.n_tokens == len(s) - 3 and (r.log_ppl is None if len(s) == 3 else math.isclose(r.log_ppl, total / (len(s) - 2), rel_tol=1e-6))
    held = sorted(r.log_ppl for r in got if r.doc_id < 1700 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.n_tokens >= 5)
    low, mid, high = (held[max(0, math.ceil(q * len(held)) - 1)] for q in (0.01, 0.5, 0.98))
    low, high = low - 0.5 * (mid - low), high + 0.5 * (high - mid)
    for r in got:
        assert math.isclose(r.low, low) and math.isclose(r.high, high)
        assert r.kept == (r.log_ppl is not None and (r.n_tokens < 5 or low <= r.log_ppl <= high))
    assert {r.kept for r in got if r.n_tokens >= 5} == {True, False}


def test_training_and_scoring_leave_little_on_disk(spark, monkeypatch):
    # tables and blocks of shuffles stay under twice the text, where hashes of every n-gram took several times as much
    rng, seen = random.Random(8), []
    vocab = [f"word{int(rng.paretovariate(0.7))}" for _ in range(20_000)]
    rows = [(i, " ".join(rng.choices(vocab, k=400))) for i in range(2000)]
    text = sum(len(t) for _, t in rows)
    monkeypatch.setattr(kn_quality, "materialize", lambda df, what, **kw: seen.append((what, common.materialize(df, what, **kw))) or seen[-1][1])
    sizes, gone = [], kn_quality.discard

    def size(path):
        return sum(f.stat().st_size for f in Path(path.removeprefix("file://")).rglob("*.parquet"))

    def discard(*tables):
        sizes.append(sum(size(df.scratch) for _, df in seen))
        gone(*tables)

    monkeypatch.setattr(kn_quality, "discard", discard)
    got = kn_quality.quality(frame(spark, rows).select("doc_id", "text", "lang"), labels(spark, [(i, 1, 0) for i in range(2000)]))
    assert got.count() == 2000 and max(sizes) < text
    blocks = kn_quality.squeeze(*(np.sort(np.array(rng.choices(range(5000), k=5000), dtype=np.uint64)) for _ in range(4)))
    assert len(blocks) < 4 * 5000 * 2


def test_blocks_give_back_what_they_took():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 5000):
        columns = [rng.integers(0, 1 << bits, n, dtype=np.uint64) for bits in (1, 20, 63, 9)]
        assert all((a == b).all() for a, b in zip(columns, kn_quality.spread(kn_quality.squeeze(*columns), 4), strict=True))


def test_languages_have_thresholds_of_their_own(spark):
    rng = random.Random(16)
    rows = [(i, " ".join(rng.choices([f"{lang}{j}" for j in range(30)], k=10)), lang) for i, lang in ((i, "ab"[i % 2]) for i in range(800))] + [(900 + i, "a1 a2 a3 a4 b1 b2", "c") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = kn_quality.quality(docs, labels(spark, [(i, 1, 0) for i in range(905)])).collect()
    cuts = {lang: {(r.low, r.high) for r in got if r.lang == lang} for lang in "abc"}
    assert all(len(x) == 1 for x in cuts.values()) and len(set.union(*cuts.values())) == 3
    for lang, own in (("a", "a"), ("b", "b"), ("c", "abc")):  # c has too few of its own
        held = sorted(r.log_ppl for r in got if r.lang in own and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.n_tokens >= 5)
        low, mid, high = (held[max(0, math.ceil(q * len(held)) - 1)] for q in (0.01, 0.5, 0.98))
        assert np.allclose(sorted(cuts[lang])[0], (low - 0.5 * (mid - low), high + 0.5 * (high - mid)))


def test_clean_text_stays_and_junk_goes(spark):
    docs, marks = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    got = kn_quality.quality(docs.select("doc_id", "text", "lang"), marks).join(marks, "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.98 and got[got.quality == 0].kept.mean() < 0.25


def test_table_finds_what_it_holds():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64))
    t = Table(keys, np.arange(len(keys)))
    assert (t.get(keys) == np.arange(len(keys))).all() and (t.find(keys + np.uint64(1)) == -1).sum() > 4990
    assert Table(keys[:0], keys[:0]).get(keys, 0, 7.0).tolist() == [7.0] * len(keys)


# ---- 10: mixing


def test_fit_is_as_near_as_sums_allow():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 5) for _ in range(rng.randint(1, 10))}
        budget = rng.randint(0, sum(n * c for n, c in counts.items()))
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        taken = mixing.fit(counts, budget)
        assert all(k <= counts[n] for n, k in taken.items())
        assert sum(n * k for n, k in taken.items()) == max(s for s in sums if s <= budget)


def test_fit_of_a_large_budget():
    counts = {n: 1000 for n in range(1, 400)}
    taken = mixing.fit(counts, 30_000_001)
    assert sum(n * k for n, k in taken.items()) == 30_000_001


def test_targets_stop_at_the_cap():
    assert mixing.water_fill([10, 100, 100], [1, 2, 3], 3) == [30.0, 72.0, 108.0]
    assert mixing.water_fill([0, 0], [1, 2], 3) == [0.0, 0.0]


def test_mixture_meets_its_targets_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    out = mixing.mix(docs).toPandas()
    assert out.equals(mixing.mix(docs.repartition(7)).toPandas().set_index("doc_id").loc[out.doc_id].reset_index()[out.columns])
    assert out.mix_times.max() <= 3 and (out.mix_size == [len(WORD.findall(t)) for t in out.text]).all()
    for _, g in out.groupby("source"):
        assert g.mix_size.sum() == g.mix_source_size.iloc[0]
        assert abs((g.mix_size * g.mix_times).sum() - g.mix_target.iloc[0]) <= max(2, 0.02 * g.mix_target.iloc[0])


def test_texts_that_repeat_a_doc_id_are_documents_of_their_own(spark):
    rows = [(i % 7, " ".join([f"t{i}"] * 3), "en", "ab"[i % 2]) for i in range(500)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "source")).collect()
    for source in "ab":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.mix_size * r.mix_times for r in own) - own[0].mix_target) < 3


def test_which_documents_a_mixture_takes(spark):
    rng = random.Random(14)
    rows = [(i, " ".join("w" * rng.choice([0, 1, 2, 3, 5, 8, 13])) or None, "en", rng.choice(["a", "b", "c", "d", None, "e"])) for i in range(400)]
    rows += [(900, "x " * 300, "en", "big")]
    docs = spark.createDataFrame(rows, SCHEMA)
    h = {r.doc_id: r.h % (1 << 64) for r in docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id", "text").alias("h")).collect()}
    got = mixing.mix(docs.select("doc_id", "text", "source")).collect()
    sources = sorted({r.source for r in got}, key=lambda x: (x is None, x or ""))
    total = {x: sum(r.mix_size for r in got if r.source == x) for x in sources}
    weight = {x: 1 + i % 3 for i, x in enumerate(sources)}
    target, rest = {}, sum(total.values())
    while True:  # sources above their cap stop there, the others share what is left
        open_ = [x for x in sources if x not in target]
        share = {x: rest * weight[x] / sum(weight[y] for y in open_) for x in open_}
        full = [x for x in open_ if share[x] > 3 * total[x]]
        if not full:
            target |= share
            break
        for x in full:
            target[x] = 3.0 * total[x]
            rest -= target[x]
    for x in sources:
        own = [r for r in got if r.source == x]
        assert {r.mix_source_size for r in own} == {total[x]} and math.isclose(own[0].mix_target, target[x])
        passes = min(3, int(target[x] // total[x]))
        budget = 0 if passes == 3 else round(target[x] - passes * total[x])
        sums = {0}
        for r in own:
            sums |= {y + r.mix_size for y in sums if y + r.mix_size <= budget}
        assert sum(r.mix_size * (r.mix_times - passes) for r in own) == max(sums)
        for size in {r.mix_size for r in own if r.mix_size}:
            same = sorted((r for r in own if r.mix_size == size), key=lambda r: (h[r.doc_id], r.doc_id))
            more = [r.mix_times - passes for r in same]
            assert more == sorted(more, reverse=True) and set(more) <= {0, 1}


def test_digest_of_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
