"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

#: Words of a text, A-Z lower-cased, as a list.
WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[\x20\x09-\x0D]+'), lambda x: x <> '')")

REPEATS = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - 199)) AS i,
        unnest(list_transform(range(0, n - 199), lambda i: md5(substr(h, 2 * i + 1, 400)))) AS m FROM t WHERE n >= 200),
hit AS (SELECT doc_id, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
b AS (SELECT doc_id, unnest(range(0, n)) AS i, unnest(list_transform(range(0, n), lambda i: substr(h, 2 * i + 1, 2))) AS c FROM t),
s AS (SELECT b.doc_id, b.i, b.c, coalesce(max(hit.i) OVER (PARTITION BY b.doc_id ORDER BY b.i) >= b.i - 199, false) AS gone
      FROM b LEFT JOIN hit ON hit.doc_id = b.doc_id AND hit.i = b.i),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM s),
r AS (SELECT doc_id, CAST(sum(CAST(gone AS BIGINT)) AS BIGINT) AS n_removed, CAST(sum(CAST(starts AS BIGINT)) AS BIGINT) AS n_spans,
        coalesce(string_agg(c, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS k FROM e GROUP BY doc_id)
SELECT t.doc_id, CAST(t.n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM t LEFT JOIN r USING (doc_id)"""

LEAKS = f"""
WITH iw AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
ish AS (SELECT item_id, least(5, len(ws)) AS wd, unnest(list_transform(range(1, len(ws) - least(5, len(ws)) + 2),
          lambda i: array_to_string(list_slice(ws, i, i + least(5, len(ws)) - 1), ' '))) AS g FROM iw WHERE len(ws) > 0),
ic AS (SELECT item_id, wd, g, count(*) AS c FROM ish GROUP BY ALL),
im AS (SELECT item_id, wd, count(*) AS m FROM ish GROUP BY ALL),
dw AS (SELECT doc_id, {WORDS} AS ws FROM documents),
dsh AS (SELECT doc_id, wd, unnest(range(0, len(ws) - wd + 1)) AS pos,
          unnest(list_transform(range(1, len(ws) - wd + 2), lambda i: array_to_string(list_slice(ws, i, i + wd - 1), ' '))) AS g
        FROM dw JOIN (SELECT DISTINCT wd FROM im) ON len(ws) >= wd),
dn AS (SELECT doc_id, wd, count(*) AS n FROM dsh GROUP BY ALL),
cand AS (SELECT DISTINCT doc_id, item_id, wd FROM dsh JOIN ic USING (wd, g)),
win AS (SELECT doc_id, item_id, wd, m, least(m, n) AS n, unnest(range(0, n - least(m, n) + 1)) AS a
        FROM cand JOIN im USING (item_id, wd) JOIN dn USING (doc_id, wd)),
bag AS (SELECT win.doc_id, item_id, win.wd, m, n, a, g, count(*) AS c
        FROM win JOIN dsh ON dsh.doc_id = win.doc_id AND dsh.wd = win.wd AND pos >= a AND pos < a + n GROUP BY ALL),
sim AS (SELECT doc_id, item_id, a, sum(least(bag.c, ic.c)) / (any_value(n) + any_value(m) - sum(least(bag.c, ic.c))) AS s
        FROM bag JOIN ic USING (item_id, wd, g) GROUP BY ALL),
best AS (SELECT doc_id, item_id, max(s) AS s FROM sim WHERE s >= 0.8 GROUP BY ALL),
per_doc AS (SELECT doc_id, count(*) AS k, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS ids, max(s) AS s FROM best GROUP BY doc_id)
SELECT d.doc_id, coalesce(k, 0) AS n_items, coalesce(ids, '') AS item_ids, CAST(s AS DOUBLE) AS similarity, k IS NOT NULL AS contaminated
FROM documents d LEFT JOIN per_doc USING (doc_id)"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
        ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.c + ny.c - k)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
c AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(c.m, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""

ARCHIVES = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
big AS (SELECT d, max(page_id) AS m FROM p WHERE n >= 1000 GROUP BY d HAVING count(*) > 1)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN m <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN m <> p.page_id THEN m END AS refers_to
FROM p LEFT JOIN big ON p.d = big.d"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Product codebooks, round after round."""
    far = "list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT rid, j, p, min({{'d': {far}, 'e': e}}) AS m FROM parts JOIN b{k} USING (j) GROUP BY rid, j, p)")
        if k < rounds:
            steps.append(
                f"s{k} AS (SELECT j, e, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (SELECT j, e, i, CAST(sum(x) AS BIGINT) AS t, "
                f"CAST(count(*) AS BIGINT) AS n FROM (SELECT j, m.e AS e, unnest(p) AS x, unnest(range(len(p))) AS i FROM a{k}) GROUP BY ALL) GROUP BY ALL)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT j, e, coalesce(s{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN s{k} USING (j, e))")
    joined = ",\n".join(steps)
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS rid, len(v) // {parts} AS w FROM kept),
parts AS MATERIALIZED (SELECT rid, j, v[j * w + 1:j * w + w] AS p FROM (SELECT *, unnest(range({parts})) AS j FROM r)),
b0 AS (SELECT j, rid AS e, p AS c FROM parts WHERE rid < {entries}),
{joined},
own AS (SELECT rid, string_agg(printf('%02x', m.e), '' ORDER BY j) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j, e, i)) AS sha FROM (
  SELECT j, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM r JOIN own USING (rid) CROSS JOIN books"""


DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS MATERIALIZED (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(x.n, 0) AS n FROM g JOIN kept k USING (lang)
      LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT c.lang, c.source, c.term, c.n,
        CAST(1 + (1000000000 * CAST(c.n + 5 AS HUGEINT)) // CAST(s.total + 5 * v.v AS HUGEINT) AS BIGINT) AS p,
        CAST(1 + (1000000000 * CAST(c.lang_n + 5 AS HUGEINT)) // CAST(v.total + 5 * v.v AS HUGEINT) AS BIGINT) AS q
      FROM c JOIN s USING (lang, source) JOIN v ON v.lang = c.lang),
far AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
term AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM pair
UNION ALL SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM term)
WHERE rank <= 50"""

ORACLE = {"op5_suffixes": REPEATS, "op6_decontam": LEAKS, "op7_neardup": NEAR, "op8_warc": ARCHIVES, "op11_codes": _codes(),
          "op13_divergence": DIVERGENCE}
