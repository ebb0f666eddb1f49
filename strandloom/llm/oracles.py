"""SQL of the registered corpus queries that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op2_exact_radix_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n
    """,
    "op4_warc_chunks": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             f AS (SELECT page_id, body, min(page_id) OVER (PARTITION BY body) AS first FROM p)
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
               CASE WHEN strlen(body) >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(body) >= 100 AND first < page_id THEN first END AS refers_to
        FROM f
    """,
    "op10_url_rules": r"""
        WITH RECURSIVE
        parts AS (
            SELECT page_id, url, html,
                   CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                   CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
                   CASE WHEN contains(url, '://') THEN regexp_replace(url, '(?s)#.*$', '') END AS node
            FROM pages),
        targets AS (
            SELECT node, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS base, regexp_extract(url, '(?s)^(.*?:)//', 1) AS scheme,
                   replace(unnest([regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
                                   regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)]), '&amp;', '&') AS target
            FROM parts WHERE node IS NOT NULL),
        links AS (
            SELECT node AS a, regexp_replace(CASE WHEN starts_with(target, '//') THEN scheme || target WHEN starts_with(target, '/') THEN base || target
                                                  WHEN contains(target, '://') THEN target END, '(?s)#.*$', '') AS b
            FROM targets WHERE target <> ''),
        edges AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
        reach AS (SELECT a AS node, b AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
        rules(verdict, rule_host, rule_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        others AS (
            SELECT DISTINCT other, translate(regexp_extract(other, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(other, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM reach),
        ruled AS (
            SELECT other, arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM others JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY other),
        alias AS (SELECT node, min(verdict) AS verdict FROM reach JOIN ruled USING (other) GROUP BY node),
        own AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
        SELECT p.page_id, p.host, p.path, o.rule, coalesce(o.verdict, a.verdict, 'allow') AS verdict
        FROM parts p LEFT JOIN own o USING (page_id) LEFT JOIN alias a USING (node)
    """,
}
