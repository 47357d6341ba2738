"""DuckDB SQL of the document queries that SQL can express on whole tables."""

SQL: dict[str, str] = {}

SQL["op3_exact_dedup"] = r"""
WITH digests AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *,
           min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS n
    FROM digests
)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, text_sha256 FROM ranked
"""

SQL["op4_source_mixing"] = r"""
WITH base AS (
    SELECT doc_id, source,
           md5('42|' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS skey,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM base GROUP BY source
), capped AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
           source_size * 2.0::DOUBLE AS cap,
           CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS budget
    FROM sizes
), levels AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (
                   ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (
                   ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM capped
), targets AS (
    SELECT source, rank, source_size, budget, least(cap, weight * max(level) OVER ()) AS target
    FROM levels
), placed AS (
    SELECT b.doc_id, b.size, b.skey, t.source_size, t.target, t.rank, t.budget,
           CAST(sum(b.size) OVER (PARTITION BY t.rank ORDER BY b.skey) AS BIGINT) AS cum
    FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT p.*, e.epoch,
           CASE WHEN target > 0 THEN (cum + source_size * e.epoch) / target ELSE 0 END AS finish
    FROM placed p CROSS JOIN (VALUES (0), (1)) e(epoch)
), listed AS (
    SELECT *, sum(size) OVER (ORDER BY finish, rank, epoch, skey) AS upto FROM copies
)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN upto <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM listed GROUP BY doc_id, skey, size, source_size, target
"""

SQL["op10_url_filter"] = r"""
WITH captures AS (
    SELECT page_id, url,
           1577836800 + (page_id * 7919 + length(url) * 104729) % 126230400 AS fetched_second,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
           regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1),
                          '/+', '/', 'g') AS path
    FROM pages
), hosts AS (
    SELECT host, length(host) * 31 + ascii(host) * 17 + ascii(substr(host, 3, 1)) * 7 AS v,
           regexp_extract(host, '([^.]*\.)?[^.]*$') AS domain
    FROM (SELECT DISTINCT host FROM captures WHERE host <> '')
), entries AS (
    SELECT 'spam' AS list, host AS pattern, 'add' AS action, v % 300 AS day FROM hosts WHERE v % 5 = 0
    UNION ALL SELECT 'spam', host, 'remove', v % 300 + 200 + v % 150 FROM hosts WHERE v % 5 = 0
    UNION ALL SELECT 'spam', host, 'add', v % 300 + 300 + v % 150 FROM hosts WHERE v % 5 = 0 AND v % 2 = 0
    UNION ALL SELECT 'tracking', host || '/en', 'add', v % 900 FROM hosts WHERE v % 4 = 1
    UNION ALL SELECT 'allow', host, 'add', 100 FROM hosts WHERE v % 7 = 0
    UNION ALL SELECT 'allow', host, 'remove', 400 + v % 500 FROM hosts WHERE v % 7 = 0
    UNION ALL SELECT 'parked', domain, 'add', 700 FROM hosts WHERE ascii(right(domain, 1)) % 2 = 0
    UNION ALL SELECT 'parked', domain, 'remove', 760 FROM hosts WHERE ascii(right(domain, 1)) % 2 = 0
), changes AS (
    SELECT list, pattern, 1577836800 + day * 86400 AS since, max(action) AS action
    FROM entries GROUP BY list, pattern, day
), intervals AS (
    SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS ended FROM changes
), active AS (
    SELECT list, pattern, since, ended FROM intervals WHERE action = 'add'
), found AS (
    SELECT DISTINCT c.page_id, c.url, a.list
    FROM captures c JOIN active a
      ON c.fetched_second >= a.since AND (a.ended IS NULL OR c.fetched_second < a.ended)
     AND (c.host = a.pattern OR ends_with(c.host, '.' || a.pattern)
          OR (contains(a.pattern, '/') AND starts_with(c.host || c.path || '/', a.pattern || '/')))
), listed AS (
    SELECT page_id, url, string_agg(list, ',' ORDER BY list) AS lists, bool_or(list = 'allow') AS allowed
    FROM found GROUP BY page_id, url
)
SELECT c.page_id, c.fetched_second, coalesce(l.lists, '') AS lists,
       l.lists IS NOT NULL AND NOT l.allowed AS blocked
FROM captures c LEFT JOIN listed l ON c.page_id = l.page_id AND c.url = l.url
"""

SQL["op11_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), placed AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM listed
), counts AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM placed, (VALUES (1), (2), (3), (4)) sizes(k)
    WHERE i + k - 1 <= len(ws)
    GROUP BY lang, k, phrase HAVING count(*) >= 30
), totals AS (
    SELECT lang, count(*) AS n FROM placed GROUP BY lang
), parts AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM counts
), cuts AS (
    SELECT lang, k, phrase, f, cut, array_to_string(ws[1:cut], ' ') AS head,
           array_to_string(ws[cut + 1:], ' ') AS tail
    FROM parts, (VALUES (1), (2), (3)) places(cut) WHERE cut < k
), scored AS (
    SELECT c.lang, c.k, c.phrase, c.f AS a, c.cut, h.f AS l, t.f AS r,
           2000000::HUGEINT * c.f // (h.f::HUGEINT + t.f) AS score
    FROM cuts c
    JOIN counts h ON h.lang = c.lang AND h.phrase = c.head AND h.k = c.cut
    JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail AND t.k = c.k - c.cut
), lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_parts AS (
    SELECT lang, f, array_to_string(ws[i:i + size - 1], ' ') AS phrase
    FROM parts, (VALUES (2), (3)) sizes(size), (VALUES (1), (2), (3)) starts(i)
    WHERE size < k AND i + size - 1 <= k
), longest AS (
    SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY lang, phrase
), kept AS (
    SELECT s.* FROM lowest s LEFT JOIN longest g ON g.lang = s.lang AND g.phrase = s.phrase
    WHERE g.f IS NULL OR 100 * g.f::HUGEINT < 80 * s.a::HUGEINT
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
