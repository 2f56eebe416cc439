"""The queries' results in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  TRUE AS has_request
FROM g
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(w[i + 1 : i + 20], ' ') AS win
  FROM d, unnest(range(0, greatest(len(w) - 19, 0))) AS t(i)
), r AS (
  SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, k FROM r, unnest(range(i, i + 20)) AS t(k)
), per AS (
  SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(len(ks), 0) AS n_removed,
    CASE WHEN ks IS NULL THEN array_to_string(w, ' ') END AS whole
  FROM d LEFT JOIN per USING (doc_id)
), cut AS (
  SELECT d.doc_id, string_agg(w[k + 1], ' ' ORDER BY k) AS some_text
  FROM d JOIN per USING (doc_id), unnest(range(0, len(w))) AS t(k)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = d.doc_id AND g.k = t.k)
  GROUP BY d.doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(coalesce(whole, some_text, '')) AS kept_sha256
FROM kept LEFT JOIN cut USING (doc_id)
"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS win
  FROM d, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS t(i)
), r AS (
  SELECT doc_id, i FROM s QUALIFY doc_id > min(doc_id) OVER (PARTITION BY win)
), m AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
    SELECT doc_id, i, CASE WHEN i <= lag(i, 1, -99) OVER (PARTITION BY doc_id ORDER BY i) + 50
      THEN 0 ELSE 1 END AS new FROM r)
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM m GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
), per AS (
  SELECT g.doc_id, sum(b - a) AS n, count(*) AS spans, max(b) AS stop,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || substr(h, 2 * stop + 1) END)) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS ls
  FROM documents
), l AS (
  SELECT doc_id, i AS line, ls[i + 1] AS t FROM d, unnest(range(0, len(ls))) AS u(i)
), full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS n FROM l
  WHERE regexp_matches(t, '[^ \t\r\x0b\x0c]')
), pairs AS (
  SELECT *, lead(t) OVER w AS t2, lead(line) OVER w AS line2 FROM full_lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY n)
), single AS (
  SELECT doc_id, line AS k FROM full_lines
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, n) > 1 AND length(t) >= 50
), run AS (
  SELECT doc_id, line, line2 FROM pairs WHERE t2 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY t, t2 ORDER BY doc_id, n) > 1
), gone AS (
  SELECT doc_id, k FROM single UNION SELECT doc_id, k FROM run, unnest(range(line, line2 + 1)) AS u(k)
), per AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), cut AS (
  SELECT l.doc_id, string_agg(t, chr(10) ORDER BY line) AS some_text
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.k = l.line
  WHERE gone.k IS NULL GROUP BY l.doc_id
)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(some_text, '')) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN cut USING (doc_id)
"""

OP12 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 4], ' ') AS g
  FROM d, unnest(range(0, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END))) AS t(i)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id
  WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION SELECT r.doc_id, e.y FROM reached r JOIN edges e ON r.other = e.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reached USING (doc_id) GROUP BY d.doc_id
"""

ORACLE: dict[str, str] = {
    "op3_warc_transactions": OP3, "op4_word_windows": OP4, "op8_bwt_byte_dedup": OP8, "op9_top_k": OP9,
    "op10_line_runs": OP10, "op12_ngram_join": OP12,
}
