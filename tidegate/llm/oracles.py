"""SQL for DuckDB that gives the rows of those queries of this folder that SQL can express."""

from __future__ import annotations

SEARCH = r"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text,
           row_number() OVER () AS k FROM documents),
terms AS (
    SELECT k, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered),
sizes AS (SELECT k, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY k),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT k, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY k, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, whole GROUP BY term),
scores AS (
    SELECT item_id, doc_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (k), whole GROUP BY item_id, doc_id, k),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

TRIE = r"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) - 1 AS nth
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
           xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
               lambda c: [ascii(c) - 1000, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, x: CASE WHEN x < -1 THEN xor(a, x + 1000) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END),
               4294967295) % 9 AS h
    FROM own GROUP BY conv_id),
lengths AS (
    SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
    SELECT l.conv_id, o.nth + 1 AS depth, o.role, o.text FROM lengths l JOIN own o ON o.conv_id = l.base AND o.nth < l.h
    UNION ALL
    SELECT l.conv_id, l.taken + o.nth - l.h + 1, o.role, o.text FROM lengths l JOIN own o ON o.conv_id = l.conv_id AND o.nth >= l.h),
places AS (
    SELECT conv_id, depth, octet_length(encode(text)) AS n_bytes, sha256(string_agg(length(role)::VARCHAR || ':' || role || ':'
        || length(text)::VARCHAR || ':' || text, ';') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
labelled AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS label, max(depth) OVER (PARTITION BY conv_id) AS last FROM places),
nodes AS (
    SELECT label, depth, count(*) AS n_convs, (count(*) - 1) * any_value(n_bytes) AS own,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
    FROM labelled GROUP BY label, depth),
-- The nodes above a node are those of its smallest conversation.
above AS (SELECT n.label, n.depth, l.label AS top_label, l.depth AS top_depth
          FROM nodes n JOIN labelled l ON l.conv_id = n.label AND l.depth <= n.depth),
children AS (SELECT top_label AS label, top_depth AS depth, count(*) AS n FROM above WHERE top_depth = above.depth - 1 GROUP BY ALL),
sums AS (
    SELECT a.top_label AS label, a.top_depth AS depth, sum(n.own)::BIGINT AS saved_tokens, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves
    FROM above a JOIN nodes n ON n.label = a.label AND n.depth = a.depth LEFT JOIN children c ON c.label = n.label AND c.depth = n.depth
    GROUP BY ALL),
tree AS (
    SELECT n.label AS conv_id, n.depth, p.top_label AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
           s.saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s USING (label, depth) LEFT JOIN children c USING (label, depth)
    LEFT JOIN above p ON p.label = n.label AND p.depth = n.depth AND p.top_depth = n.depth - 1)
SELECT conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs,
       n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens, ends_sha256
FROM tree
"""

MIXING = r"""
WITH rows AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS draw FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
    FROM rows GROUP BY source),
-- Filling from the source that is clamped first: the level is right where the next source is not above its cap.
filling AS (
    SELECT *, (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER before, 0))::DOUBLE AS rest,
           sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared,
           row_number() OVER before AS place
    FROM sources WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, shared FROM filling WHERE weight * (rest / shared) <= 3 * source_size ORDER BY place LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN weight * (l.rest / l.shared) > 3 * source_size THEN (3 * source_size)::DOUBLE
           ELSE l.rest * weight / l.shared END AS target
    FROM sources, level l),
rooms AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole FROM targets),
drawn AS (
    SELECT r.*, t.source_size, t.target, t.whole, floor(t.target)::BIGINT - t.whole * t.source_size AS room,
           sum(size) OVER (PARTITION BY r.source ORDER BY draw, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM rows r JOIN rooms t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * repetitions)::BIGINT AS taken, repetitions::BIGINT AS repetitions, source
FROM (SELECT *, whole + CASE WHEN room > 0 AND 2 * upto - size <= 2 * room THEN 1 ELSE 0 END AS repetitions FROM drawn)
"""

ORACLES = {"op11_bag_search": SEARCH, "op12_prefix_trie": TRIE, "op13_mixing": MIXING}
