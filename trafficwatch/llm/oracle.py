"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from trafficwatch.llm import line_windows

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


PHRASES = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_low("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
iw AS (
  SELECT item_id, regexp_extract_all({_low("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
items AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[p + 1 : p + least(len(w), 10)], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS p FROM iw WHERE len(w) > 0)
),
texts AS (
  SELECT doc_id, n, p, array_to_string(w[p + 1 : p + n], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(len(w) - n + 1)) AS p FROM dw, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)
),
hits AS (
  SELECT DISTINCT t.doc_id, t.p, t.n, i.item_id FROM texts t JOIN items i ON t.s = i.s AND t.n = i.n
),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p
),
f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100
"""

NEAR = rf"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all({_low("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[p + 1 : p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 3, 1))) AS p FROM dw WHERE len(w) > 0)
),
sizes AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
),
least AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, l.component_id, l.component_id = d.doc_id AS kept
FROM documents d JOIN least l ON l.u = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 50 = 0
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM r WHERE place <= 5
"""

URLS = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
),
p AS (
  SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
),
rules AS (
  SELECT * FROM (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'), ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')) t(rule, verdict, rule_host, rule_path)
),
fits AS (
  SELECT p.page_id, r.rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC) AS place
  FROM p JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
"""


NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.w, c.w)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.w) = len(c.w) WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 5
"""

FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id::VARCHAR) AS x FROM documents
),
h AS (
  SELECT doc_id, t, n, ('0x' || substr(x, 1, 8))::UBIGINT % (n + 1)::UBIGINT AS a, ('0x' || substr(x, 9, 8))::UBIGINT % (n + 1)::UBIGINT AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(x, 17, 8))::UBIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(x, 25, 8))::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
c AS (
  SELECT doc_id, t, n, form, least(a, b)::BIGINT AS one, greatest(a, b)::BIGINT AS two FROM h
),
p AS (
  SELECT *, substr(t, 1, one) AS prefix, substr(t, one + 1, two - one) AS middle, substr(t, two + 1) AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN one END AS prefix_chars, CASE WHEN form <> 'plain' THEN two - one END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def registry() -> dict[str, str]:
    return {
        "op3_phrase_index": PHRASES,
        "op4_warc_bundles": WARC,
        "op5_minhash_join": NEAR,
        "op6_norm_topk": TOP_K,
        "op7_line_windows": line_windows.ORACLE,
        "op8_url_automaton": URLS,
        "op12_hilbert_negatives": NEGATIVES,
        "op13_fill_middle": FILL_MIDDLE,
    }
