"""DuckDB SQL for the queries that SQL can express over the whole tables.

The others have none: classifiers, EM and language models (2, 4, 6, 9), TF-IDF templates and path inheritance over their
floating-point ties (3), a tokenizer (8) and the knapsack program (10) are tested against brute force in tests/llm.
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = w.doc_id
"""

QUALITY_RULES = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, ws[i:i + 7] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, range(0, 8) AS r(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CASE WHEN n_words = 0 THEN 0 ELSE
  CAST(100 * n_symbols > 10 * n_words AS INT) + CAST(100 * n_dup_lines > 30 * n_lines AS INT) + CAST(word_chars < 2 * n_words OR word_chars > 15 * n_words AS INT) END AS n_soft FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR n_soft > 0) AS bad FROM f GROUP BY source),
o AS (SELECT least(greatest(avg(bad / n), 1e-6), 1 - 1e-6) AS mean, var_pop(bad / n) AS var, avg(1 / n) AS inv FROM h),
k AS (SELECT mean, least(greatest(mean * (1 - mean) / greatest(var - mean * (1 - mean) * inv, 1e-9) - 1, 1.0), 10000.0) AS strength FROM o),
v AS (SELECT source, (bad + mean * strength) / (n + strength) AS rate FROM h, k),
c AS (SELECT source, CASE WHEN rate >= 0.9 THEN 'bad' WHEN rate >= 0.5 THEN 'watch' ELSE 'good' END AS host_verdict FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_verdict <> 'bad' AND NOT (host_verdict = 'watch' AND n_soft > 0) AND n_soft < 2 AS kept, host_verdict
FROM f JOIN c ON f.source IS NOT DISTINCT FROM c.source
"""

DECONTAMINATION = r"""
WITH b AS (SELECT th, min(item_id) AS item_id FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS th FROM benchmark) WHERE len(th) > 0 GROUP BY th),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS th FROM documents),
k AS (SELECT 0 AS mask, [2, 3, 5, 6, 8, 9, 11, 12] AS pos UNION ALL SELECT 1, [1, 3, 4, 6, 7, 9, 10, 12] UNION ALL SELECT 2, [1, 2, 4, 5, 7, 8, 10, 11]),
bw AS (SELECT item_id, i AS bi, mask, list_transform(pos, lambda x: th[i + x]) AS key FROM (SELECT item_id, th, unnest(range(0, len(th) - 11)) AS i FROM b WHERE len(th) >= 12), k
  UNION ALL SELECT item_id, 0, 100 + len(th), th FROM b WHERE len(th) < 12),
dw AS (SELECT doc_id, i AS di, mask, list_transform(pos, lambda x: th[i + x]) AS key FROM (SELECT doc_id, th, unnest(range(0, len(th) - 11)) AS i FROM d WHERE len(th) >= 12), k
  UNION ALL SELECT doc_id, i, 100 + n, th[i + 1:i + n] FROM (SELECT doc_id, th, n, unnest(range(0, len(th) - n + 1)) AS i FROM d, (SELECT DISTINCT len(th) AS n FROM b WHERE len(th) < 12) WHERE len(th) >= n)),
hit AS (SELECT DISTINCT dw.doc_id, bw.item_id, di, bi FROM dw JOIN bw ON dw.mask = bw.mask AND dw.key = bw.key),
al AS (SELECT hit.*, d.th AS dt, b.th AS bt, greatest(0, bi - di, bi - 6) AS lo, least(len(b.th), len(d.th) + bi - di, bi + 18) AS hi FROM hit JOIN d ON d.doc_id = hit.doc_id JOIN b ON b.item_id = hit.item_id),
eq AS (SELECT doc_id, item_id, hi - lo AS n, array_to_string(list_transform(range(lo, hi), lambda j: CASE WHEN bt[j + 1] = dt[j + di - bi + 1] THEN '1' ELSE '0' END), '') AS same FROM al),
ok AS (SELECT doc_id, item_id FROM eq WHERE len(replace(same, '0', '')) >= 0.75 * n OR contains(same, '1111111111111')),
s AS (SELECT doc_id, item_id, count(*) AS n FROM ok GROUP BY ALL),
t AS (SELECT doc_id, count(*) AS n_items, CAST(sum(n) AS BIGINT) AS n_hits, list_sort(list(item_id)) AS item_ids FROM s GROUP BY doc_id)
SELECT d.doc_id, t.doc_id IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(n_hits, 0) AS n_hits, array_to_string(coalesce(item_ids, []), ',') AS item_ids
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""
