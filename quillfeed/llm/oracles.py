"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: All pairs that share a shingle are counted, and links are followed to the smallest reachable id.
NEARDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON r.node = e.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id, d.doc_id = min(r.root) AS kept
FROM documents d JOIN r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""

#: CRC-32 of a text, bit by bit: of its bytes, each followed by seven zeros, every step shifts the remainder by one bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(CAST(octet_length(encode({0})) AS BIGINT)),
  lambda i: [CAST('0x' || substr(hex({0}), 2 * i + 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"""

#: Every pair of equal words of a document at a distance that four periods leave room for; islands of pairs are runs.
REPEATS = (
    r"""
WITH d0 AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w0,
  """
    + _CRC.format("CAST(doc_id AS VARCHAR)")
    + r""" AS h FROM documents),
d1 AS (SELECT *, len(w0) AS n, h // 10 AS g FROM d0),
d2 AS (SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM d1),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w0[i + 1] ELSE w0[a + (i - a) % p + 1] END) ELSE w0 END AS ws FROM d2),
w AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(ws) AS word FROM d),
m AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM w a JOIN w b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND b.i - a.i <= a.n // 4),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
r AS (SELECT doc_id, q AS period, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM r x WHERE x.doc_id = r.doc_id AND x.period < r.period AND r.period % x.period = 0
  AND x.start <= r.start AND x.start + x.length >= r.start + r.length)),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
lines AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(coalesce(lines.n_runs, 0) AS BIGINT) AS n_runs, best.start, best.length, best.period, 1000 * best.length // best.period AS exponent_milli,
  sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)"""
)

#: Every feature of every text is counted by itself; checksums are made once for each distinct feature.
IMPORTANCE = (
    r"""
WITH t AS (SELECT 0 AS target, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
w AS (SELECT target, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM t),
f AS (SELECT target, doc_id, unnest(list_concat(ws, list_transform(range(1, greatest(len(ws), 1)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS feature FROM w),
k AS (SELECT feature, """
    + _CRC.format("feature")
    + r""" % 10000 AS bucket FROM (SELECT DISTINCT feature FROM f)),
b AS (SELECT target, doc_id, bucket, count(*) AS n FROM f JOIN k USING (feature) GROUP BY ALL),
c AS (SELECT bucket, CAST(sum(CASE WHEN target = 0 THEN n ELSE 0 END) AS BIGINT) AS s, CAST(sum(CASE WHEN target = 1 THEN n ELSE 0 END) AS BIGINT) AS t FROM b GROUP BY bucket),
z AS (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM c),
g AS (SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM c, z),
m AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total FROM b JOIN g USING (bucket) WHERE target = 0 GROUP BY doc_id),
x AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
  CAST('0x' || substr(sha256('7:' || w.doc_id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN m USING (doc_id) WHERE target = 0),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM x),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM y LEFT JOIN o USING (doc_id)"""
)
