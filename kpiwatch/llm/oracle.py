"""The training-data queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

_WORDS9 = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Every pair that shares a shingle, so this one is for small tables only.
OP9 = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS9} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN low USING (doc_id)
"""


_WORDS6 = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP6 = rf"""
WITH dw AS (SELECT doc_id, {_WORDS6} AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS6} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[i : i + 9], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM dw, (SELECT DISTINCT l FROM win) WHERE len(w) >= l
),
hit AS (
  SELECT doc_id, i, p.l, item FROM places p JOIN win ON win.l = p.l AND win.t = array_to_string(w[i : i + p.l - 1], ' ')
),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


OP3 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
s AS (
  SELECT q.k AS qk, q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.k <> v.k WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY qk ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


#: CRC-32 is told byte by byte: its table of 256 by the polynomial's rule, then one look-up for each byte of a distinct feature.
OP12 = rf"""
WITH dw AS (SELECT doc_id, {_WORDS6} AS w FROM documents),
bw AS (SELECT {_WORDS6} AS w FROM benchmark),
df AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM dw),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM bw),
tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab
),
spelt AS (
  SELECT f, list_transform(range(1, octet_length(encode(f)) + 1), lambda i:
    CAST((instr('0123456789ABCDEF', substr(h, 2 * i - 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i, 1)) - 1 AS BIGINT)) AS bytes
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf))
),
code AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM spelt, tab
),
s AS (SELECT bucket, count(*) AS s FROM df JOIN code USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN code USING (f) GROUP BY bucket),
total AS (SELECT (SELECT count(*) FROM df) AS sa, (SELECT count(*) FROM bf) AS ta),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (sa + 10000) / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (ta + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket), total
),
sums AS (SELECT doc_id, count(*) AS n, sum(gain) AS g FROM df JOIN code USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
scores AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
    CAST(coalesce((g - ((g % n) + n) % n) // n, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM dw LEFT JOIN sums USING (doc_id)
),
gumbel AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scores),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM gumbel WHERE n_words >= 20)
SELECT g.doc_id, n_features, weight, score, CASE WHEN rank <= 25 * total // 100 THEN rank END AS rank FROM gumbel g LEFT JOIN r USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_uniform_threshold_topk": OP3, "op6_benchmark_decontamination": OP6, "op9_minhash_near_dedup": OP9, "op12_importance_resampling": OP12}
