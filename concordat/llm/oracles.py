"""SQL twins, for DuckDB, of those queries of this subpackage that SQL can express."""

RULES = "(VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS r(rh, rp, rv)"

# Pages are judged by the longest rule; block decisions then walk over canonical and refresh links.
URLS = rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, html,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 2) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3) AS query
  FROM pages
), ruled AS (
  SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS node,
         (SELECT max_by({{'rule': rh || rp, 'verdict': rv}}, length(rh || rp)) FROM {RULES}
          WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS won
  FROM parts
), links AS (
  SELECT node AS a, regexp_replace(t, '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS b
  FROM (SELECT node, regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                                    '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS t
        FROM ruled WHERE node IS NOT NULL AND html IS NOT NULL)
  WHERE t LIKE '%://%'
), reach(a, b) AS (
  SELECT node, node FROM ruled WHERE won.verdict = 'block'
  UNION
  SELECT r.a, CASE WHEN l.a = r.b THEN l.b ELSE l.a END FROM reach r JOIN links l ON r.b = l.a OR r.b = l.b
)
SELECT page_id, host, path, won.rule AS rule,
       coalesce(won.verdict, CASE WHEN node IN (SELECT b FROM reach) THEN 'block' END, 'allow') AS verdict
FROM ruled
"""

TOP_K = """
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), met AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum([x[1] * x[2] FOR x IN list_zip(q.v, c.v)]), 0)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.n <> q.n AND len(c.v) = len(q.v)
)
SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM met
QUALIFY rank <= 5
"""

CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), told AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
          + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + 17 AS size
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(size))::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""

ORACLES = {"op3_urls": URLS, "op5_topk": TOP_K, "op6_chat": CHAT}
