"""DuckDB SQL for the operators that SQL can express, written on its own."""

LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, i, line, trim(line, ' ') AS key
  FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents)
), totals AS (
  SELECT coalesce('=' || source, '') AS host, count(*) AS total FROM documents GROUP BY 1
), over_ratio AS (
  SELECT host, key FROM lines JOIN totals USING (host)
  WHERE key <> ''
  GROUP BY host, key, total
  HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) > 0.1::DOUBLE * total
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.key IS NULL), '') AS text
  FROM lines LEFT JOIN over_ratio o USING (host, key)
  GROUP BY doc_id
)
SELECT d.doc_id, d.source, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, i, item FROM doc_windows JOIN item_windows USING (n, gram)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT o.a, o.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) o
  JOIN n m ON m.doc_id = o.a JOIN n k ON k.doc_id = o.b
  WHERE 100 * common >= 90 * (m.n + k.n - common)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r USING (doc_id) LEFT JOIN n USING (doc_id)
GROUP BY d.doc_id
"""

SUFFIX_DEDUP = """
WITH t AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM t WHERE len(h) >= 400)
), often AS (SELECT m FROM windows GROUP BY m HAVING count(*) > 1),
hits AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM windows JOIN often USING (m)),
numbered AS (SELECT doc_id, i, sum(CASE WHEN gap <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM hits),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, k),
ends AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM spans GROUP BY doc_id),
pieces AS (
  SELECT doc_id, a, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS x
  FROM spans JOIN t USING (doc_id)
), front AS (SELECT doc_id, string_agg(x, '' ORDER BY a) AS x FROM pieces GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(front.x, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN ends USING (doc_id) LEFT JOIN front USING (doc_id)
"""



def _vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    near = """near{k} AS MATERIALIZED (
  SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT x.vec_id, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM part x JOIN book{k} b USING (p))
  GROUP BY vec_id, p)"""
    better = """sums{n} AS (
  SELECT p, e, i, sum(x) AS s, count(*) AS n
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM part JOIN near{k} USING (vec_id, p)) GROUP BY p, e, i
), means{n} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums{n} GROUP BY p, e),
book{n} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{n} m USING (p, e))"""
    steps = [near.format(k=0)]
    for k in range(rounds):
        steps += [better.format(k=k, n=k + 1), near.format(k=k + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (SELECT vec_id, p, q[p * (len(q) // {parts}) + 1 : (p + 1) * (len(q) // {parts})] AS v FROM kept, range({parts}) r(p)),
book0 AS MATERIALIZED (
  SELECT p, e, v FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) JOIN part USING (vec_id)
), {", ".join(steps)},
codes AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(x, ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM book{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM books) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id)
"""


ORACLE_SQL = {
    "op12_vector_codes": _vector_codes(),
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op8_jaccard": JACCARD,
    "op9_line_dedup": LINE_DEDUP,
    "op10_decontamination": DECONTAMINATION,
}
