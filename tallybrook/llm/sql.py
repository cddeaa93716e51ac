"""DuckDB SQL that checks the corpus queries."""

# Base 32 of a hex digest: 8 groups of 5 hex digits give 8 groups of 4 characters.
_BASE32 = """array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST((CAST('0x' || substr(digest, 1 + i // 20 * 5, 5) AS BIGINT) >> (15 - i % 20)) & 31 AS INT), 1)), '')"""

OP4 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
r AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS digest,
             row_number() OVER same AS place, first_value(page_id) OVER same AS response
      FROM p WINDOW same AS (PARTITION BY payload ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN response END AS refers_to
FROM r
"""

_HOST = "translate(regexp_extract({0}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_REST = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"
_PAGE_HOST = _HOST.format("rest")

OP5 = rf"""
WITH RECURSIVE u AS (SELECT page_id, html, {_REST.format("coalesce(url, '')")} AS rest FROM pages),
j AS (SELECT page_id, html, {_PAGE_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             arg_max(verdict, length(rule_host || rule_path)) AS rule_verdict
      FROM j LEFT JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY ALL),
l AS (SELECT host AS source, unnest(regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) AS link
      FROM j WHERE host <> ''),
t AS (SELECT source, CASE WHEN starts_with(link, '//') THEN 'http:' || link
                          WHEN regexp_matches(link, '(?i)^https?://') THEN link
                          WHEN NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'http://' || source END AS target_url FROM l),
h AS (SELECT source, {_REST.format("target_url")} AS rest FROM t WHERE target_url IS NOT NULL),
g AS (SELECT source, {_PAGE_HOST} AS target, coalesce(nullif(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), ''), '/') AS path, count(*) AS links
      FROM h WHERE rest <> '' GROUP BY ALL),
gr AS (SELECT target, path, arg_max(verdict, length(rule_host || rule_path)) AS verdict
       FROM (SELECT DISTINCT target, path FROM g) LEFT JOIN rules
         ON (target = rule_host OR ends_with(target, '.' || rule_host)) AND starts_with(path, rule_path)
       GROUP BY ALL),
e AS (SELECT source, target, sum(links) AS links, sum(CASE WHEN verdict = 'allow' THEN links ELSE 0 END) AS allowed,
             sum(CASE WHEN verdict = 'block' THEN links ELSE 0 END) AS blocked
      FROM g JOIN gr USING (target, path) WHERE target <> '' GROUP BY source, target),
s AS (SELECT host, avg(CASE WHEN rule_verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
             avg(CASE WHEN rule_verdict = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
      FROM f WHERE host <> '' GROUP BY host
      UNION ALL
      SELECT target, sum(allowed) / sum(links), sum(blocked) / sum(links) FROM e WHERE target NOT IN (SELECT host FROM f) GROUP BY target),
w AS (SELECT 'trust' AS kind, host, trust AS weight FROM s UNION ALL SELECT 'distrust', host, distrust FROM s),
share AS (SELECT source, target, links / sum(links) OVER (PARTITION BY source) AS share FROM e WHERE source <> target),
d AS (SELECT 'trust' AS kind, source, target, share FROM share UNION ALL SELECT 'distrust', target, source, share FROM share),
base AS (SELECT kind, host, round(sum(weight), 9) AS weight
         FROM (SELECT * FROM w UNION ALL SELECT kind, source, 0.0 FROM d UNION ALL SELECT kind, target, 0.0 FROM d) GROUP BY ALL),
scores AS (
  SELECT 0 AS n, kind, host, CAST(weight AS DOUBLE) AS score FROM base
  UNION ALL
  SELECT n + 1, kind, host, round(sum(weight) + CASE WHEN kind = 'distrust' THEN 1 - sum(weight) ELSE 1 END * 0.85 * sum(part), 9)
  FROM (SELECT scores.n, d.kind, d.target AS host, scores.score * d.share AS part, 0.0 AS weight
        FROM scores JOIN d ON d.kind = scores.kind AND d.source = scores.host WHERE scores.n < 32
        UNION ALL
        SELECT m.n, b.kind, b.host, 0.0, CAST(b.weight AS DOUBLE) FROM base b, (SELECT DISTINCT n FROM scores) m WHERE m.n < 32)
  GROUP BY n, kind, host),
v AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN score END) AS trust, sum(CASE WHEN kind = 'distrust' THEN score END) AS distrust
      FROM scores WHERE n = 32 GROUP BY host)
SELECT page_id, f.host, path, rule,
       coalesce(rule_verdict, CASE WHEN distrust >= 0.5 AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN v USING (host)
"""

OP7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

# CRC-32 byte by byte; its table of 256 entries follows from the polynomial.
OP3 = """
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
b AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
             list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
      FROM documents),
k AS (SELECT doc_id, size,
             xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS text_crc32
      FROM b, crc_table),
s AS (SELECT *, CAST(sum(size) OVER (ORDER BY text_crc32, size, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
             CAST(sum(size) OVER () AS BIGINT) AS total FROM k),
d AS (SELECT *, CAST(least(23, (2 * upto - size) * 24 // (2 * total)) AS INTEGER) AS shard FROM s)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY text_crc32, size, doc_id NULLS FIRST) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM d
"""

# Holds for pages whose one article ends with its tag or the page and is made of headings and paragraphs.
OP12 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1) AS article FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(article, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(
        replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))) AS blocks
      FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, CASE WHEN text = '' THEN CAST([] AS VARCHAR[]) ELSE regexp_extract_all(text, '[^\n]*\n|[^\n]+') END AS units,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n, h1 % (len(units) + 1) AS a, h2 % (len(units) + 1) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
             array_to_string(units[greatest(a, b) + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
