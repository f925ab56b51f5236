"""SQL for the queries that it can express, over the same tables."""

from __future__ import annotations

OP5 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
    row_number() OVER (PARTITION BY page_id, coalesce(html, '')) AS copy FROM pages
), d AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS original,
    list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda b:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> b) & 31 AS BIGINT) + 1, 1)),
      'string_agg', '')), 'string_agg', '') AS digest
  FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id > original OR (page_id = original AND copy > 1) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > original OR (page_id = original AND copy > 1) THEN original END AS refers_to
FROM d
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.e, v.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * v.e[i])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 20 = 0) AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
      lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), t AS (
  SELECT doc, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), grps AS (
  SELECT lang, source FROM d GROUP BY lang, source
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), n AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), c AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n
  FROM grps AS g JOIN kept AS k USING (lang) LEFT JOIN n USING (lang, source, term)
), p AS (
  SELECT c.lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY c.lang, source) + 5 * v) AS p
  FROM c JOIN v USING (lang)
), l AS (
  SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term
), q AS (
  SELECT l.lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY l.lang) + 5 * v) AS q
  FROM l JOIN v USING (lang)
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), r AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM grps AS g JOIN grps AS h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT p.lang, source, 'term', p.term, p - q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
), o AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM r
)
SELECT * FROM o WHERE part = 'pair' OR rank <= 50
"""

OP12 = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""

OP13 = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t
), l AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    CAST(len(words) < 200 AS INT)
    + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(w.doc_id > first_id, false) AS INT) AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), h AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, failed
), c AS (
  SELECT part, s, sum(n) AS docs, sum(CASE WHEN failed & s <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failed & s <> 0 THEN good ELSE 0 END) AS good, sum(CASE WHEN failed & s <> 0 THEN toxic ELSE 0 END) AS toxic
  FROM h, (SELECT unnest(range(0, 32)) AS s) GROUP BY part, s
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f AS a, f AS b, f AS c, f AS d, f AS e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f
), k AS (
  SELECT filter_order, step, 1 << (ascii(substr(filter_order, CAST(step AS BIGINT), 1)) - 65) AS own,
    list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, CAST(i AS BIGINT), 1)) - 65))) AS earlier
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), j AS (
  SELECT x.part, filter_order, step, own, y.docs - y.removed AS kept, y.removed - x.removed AS removed,
    z.removed - (y.removed - x.removed) AS redundant, a.removed - u.removed AS unique_fails,
    y.good - x.good AS good_lost, y.toxic - x.toxic AS toxic_lost
  FROM k
  JOIN c AS x ON x.s = coalesce(earlier, 0)
  JOIN c AS y ON y.part = x.part AND y.s = coalesce(earlier, 0) + own
  JOIN c AS z ON z.part = x.part AND z.s = own
  JOIN c AS a ON a.part = x.part AND a.s = 31
  JOIN c AS u ON u.part = x.part AND u.s = 31 - own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM j
"""

ORACLE = {
    "op5_warc_round_trip": OP5,
    "op10_exact_top_k": OP10,
    "op11_source_divergence": OP11,
    "op12_stream_dedup": OP12,
    "op13_filter_audit": OP13,
}
