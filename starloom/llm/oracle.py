"""SQL for DuckDB that returns the same rows as the queries, where SQL can say it."""

from __future__ import annotations

_SQL: dict[str, str] = {}


def all_sql() -> dict[str, str]:
    return dict(_SQL)


_SQL["op1_url_filter"] = """
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), cut AS (
    SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END, '') AS rest
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), judged AS (
    SELECT p.*, (
        SELECT max_by({'rule': r.host || r.path, 'verdict': r.verdict}, length(r.host) * 1000 + length(r.path))
        FROM rules r
        WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    ) AS best
    FROM parts p
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

_SQL["op2_exact_topk"] = """
WITH fine AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM fine q JOIN fine c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY row ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

_SQL["op6_quotation"] = r"""
WITH RECURSIVE messages AS (
    SELECT conv_id, turn, role, text, count(*) AS n_copies, row_number() OVER () AS message
    FROM conversations GROUP BY conv_id, turn, role, text
), raw AS (
    SELECT message, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM messages WHERE regexp_matches(text, '(^|\n)[ \t]*>')
), marked AS (
    SELECT *, regexp_extract(raw, '^[ \t>]*') AS marks FROM raw
), leveled AS (
    SELECT message, pos, raw, marks, length(regexp_replace(marks, '[^>]', '', 'g')) AS level FROM marked
), numbered AS (
    SELECT message, pos, level, CASE WHEN level > 0 THEN substr(raw, length(marks) + 1) ELSE raw END AS line,
           pos - row_number() OVER (PARTITION BY message, level ORDER BY pos) AS island
    FROM leveled
), passages AS (
    SELECT message, level, trim(regexp_replace(lower(string_agg(line, chr(10) ORDER BY pos)), '[ \t\r\n]+', ' ', 'g'), ' ') AS words
    FROM numbered WHERE level > 0 GROUP BY message, level, island
), own AS (
    SELECT m.*, CASE WHEN q.message IS NULL THEN m.text ELSE q.own END AS own
    FROM messages m LEFT JOIN (
        SELECT message, regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), ''), '^\n+|\n+$', '', 'g') AS own
        FROM numbered GROUP BY message
    ) q USING (message)
), units AS (
    SELECT conv_id, turn, message,
           unnest([own] || regexp_split_to_array(own, '\n[ \t\r]*\n') || string_split(own, chr(10))) AS unit
    FROM own WHERE own IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL
), firsts AS (
    SELECT conv_id, words, min({'turn': turn, 'message': message}) AS first
    FROM (SELECT *, trim(regexp_replace(lower(unit), '[ \t\r\n]+', ' ', 'g'), ' ') AS words FROM units)
    WHERE words <> '' GROUP BY conv_id, words
), linked AS (
    SELECT p.message, count(*) AS n_linked, max(CASE WHEN p.level = 1 THEN f.first END) AS parent
    FROM passages p JOIN messages m USING (message) JOIN firsts f ON f.conv_id = m.conv_id AND f.words = p.words
    WHERE f.first.turn < m.turn GROUP BY p.message
), chain AS (
    SELECT message, message AS root, 0 AS depth FROM messages
    UNION ALL
    SELECT c.message, l.parent.message, c.depth + 1
    FROM chain c JOIN linked l ON l.message = c.root AND l.parent IS NOT NULL
), ends AS (
    SELECT message, max(depth) AS depth, max_by(root, depth) AS root FROM chain GROUP BY message
)
SELECT o.conv_id, r.turn AS thread, e.depth::INTEGER AS depth, o.turn, o.role, l.parent.turn AS reply_to,
       coalesce((SELECT count(*) FROM passages p WHERE p.message = o.message), 0)::BIGINT AS n_quotes,
       coalesce(l.n_linked, 0)::BIGINT AS n_linked, o.n_copies::BIGINT AS n_copies, o.own AS text,
       '<|' || coalesce(o.role, 'unknown') || '|>' || chr(10) || coalesce(o.own, '') || chr(10) AS formatted
FROM own o JOIN ends e USING (message) JOIN messages r ON r.message = e.root LEFT JOIN linked l ON l.message = o.message
"""


def _template_values() -> str:
    from starloom.llm.licenses import _template_words

    return ", ".join(f"('{name}', {n}, {words!r})" for name, n, words in _template_words())


_SQL["op8_license_scan"] = rf"""
WITH templates(licence, n, words) AS (VALUES {_template_values()}
), vocabulary AS (
    SELECT DISTINCT unnest(words) AS word FROM templates
), files AS (
    SELECT regexp_extract(url, '://([^?#]*)', 1) AS path, coalesce(regexp_replace(html, '<[^>]*>', chr(10), 'g'), '') AS text
    FROM pages WHERE url IS NOT NULL
), named AS (
    SELECT row_number() OVER () AS file, *,
           regexp_matches(regexp_extract(path, '[^/]*$'), '(?i)^(un)?licen[cs]e|^copying|^notice') OR ends_with(path, '/') AS is_licence
    FROM files
), units AS (
    SELECT row_number() OVER () AS unit, path, is_licence,
           list_distinct(regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')) AS words
    FROM (SELECT path, is_licence, unnest(list_distinct(string_split(text, chr(10)) || CASE WHEN is_licence THEN [text] ELSE [] END)) AS unit FROM named)
), total AS (
    SELECT count(*) AS n FROM units
), in_units AS (
    SELECT unit, path, is_licence, len(words) AS size, unnest(words) AS word FROM units
), weights AS (
    SELECT word, (ln((1 + (SELECT n FROM total)) / (1 + count(unit))) + 1) ** 2 AS square
    FROM vocabulary LEFT JOIN in_units USING (word) GROUP BY word
), lengths AS (
    SELECT unit, any_value(path) AS path, any_value(is_licence) AS is_licence,
           sum(square) + (any_value(size) - count(*)) * (ln(1 + (SELECT n FROM total)) / 2 + 1) ** 2 AS length
    FROM in_units JOIN weights USING (word) GROUP BY unit
), postings AS (
    SELECT licence, n, unnest(words) AS word FROM templates
), template_lengths AS (
    SELECT n, sum(square) AS length FROM postings JOIN weights USING (word) GROUP BY n
), scored AS (
    SELECT u.unit, p.licence, p.n, sum(w.square) AS dot
    FROM in_units u JOIN postings p USING (word) JOIN weights w USING (word) GROUP BY u.unit, p.licence, p.n
), best AS (
    SELECT l.path, l.is_licence, min({{'minus': -score, 'licence': licence}}) AS best
    FROM (
        SELECT s.unit, s.licence, round(s.dot / sqrt(l.length * t.length), 6) AS score
        FROM scored s JOIN lengths l USING (unit) JOIN template_lengths t USING (n)
    ) JOIN lengths l USING (unit)
    WHERE score >= 0.75 GROUP BY l.path, l.is_licence
), paths AS (
    SELECT DISTINCT path, CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*)/[^/]*$', 1) ELSE '' END AS directory FROM files
), holders AS (
    SELECT p.directory AS above, min(b.best) AS given FROM best b JOIN paths p USING (path) WHERE is_licence GROUP BY p.directory
), inherited AS (
    SELECT p.path, max_by({{'above': h.above, 'given': h.given}}, length(h.above)) AS nearest
    FROM paths p JOIN holders h ON h.above = '' OR p.directory = h.above OR starts_with(p.directory, h.above || '/')
    GROUP BY p.path
), own AS (
    SELECT path, min(best) AS best FROM best GROUP BY path
)
SELECT p.path, coalesce(o.best, i.nearest.given).licence AS licence,
       CASE WHEN o.best IS NOT NULL THEN 'own' WHEN i.nearest IS NOT NULL THEN 'inherited' END AS basis,
       -(coalesce(o.best, i.nearest.given).minus) AS score,
       CASE WHEN o.best IS NULL THEN i.nearest.above END AS directory
FROM paths p LEFT JOIN own o USING (path) LEFT JOIN inherited i USING (path)
"""

_SQL["op11_filter_audit"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang::VARCHAR, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first
    FROM texts
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           len(words) < 200 AS a,
           100 * len(list_distinct(words)) < 50 * len(words) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           first IS NOT NULL AND (doc_id IS NULL OR doc_id > first) AS e
    FROM split LEFT JOIN marks USING (doc_id)
), counts AS (
    SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
                 || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
           count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM failing GROUP BY part, failed
), letters(l) AS (
    VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), gone_at AS (
    SELECT part, filter_order, failed, n, good, toxic,
           list_min(list_transform(string_split(failed, ''), lambda x: instr(filter_order, x))) AS gone
    FROM counts, orders
), steps AS (
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter,
           sum(n) FILTER (failed = '' OR gone > step) AS kept,
           sum(n) FILTER (failed <> '' AND gone = step) AS removed,
           sum(n) FILTER (contains(failed, filter) AND gone < step) AS redundant,
           sum(n) FILTER (failed = filter) AS unique_fails,
           sum(good) FILTER (failed <> '' AND gone = step) AS good_lost,
           sum(toxic) FILTER (failed <> '' AND gone = step) AS toxic_lost
    FROM gone_at, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
    GROUP BY part, filter_order, step
)
SELECT part, filter_order, step::INTEGER AS step,
       coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley
FROM steps
"""
