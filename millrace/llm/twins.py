"""DuckDB SQL of corpus queries, written from their definitions."""

from __future__ import annotations

CRC_TABLE = """crc_table AS MATERIALIZED (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS steps
)"""


def crc(expr: str) -> str:
    """Unsigned crc32 of a value written as text; the table `steps` must be in reach."""
    return f"xor(list_reduce(list_transform(string_split(CAST({expr} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)), lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295), 4294967295)"


def _field(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
WITH RECURSIVE {CRC_TABLE}, shown AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
        CASE WHEN {crc('doc_id')} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
    FROM documents, crc_table
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS total
    FROM shown
), nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS node, total FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (total + 15) // 16 FROM nodes WHERE total > 1 GROUP BY tree, level, pos // 16, total
), subroots AS (
    SELECT tree, node AS subroot, count(*) OVER () AS total FROM nodes WHERE total = 1
), upper AS (
    SELECT 0 AS level, tree AS pos, subroot AS node, total FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (total + 15) // 16 FROM upper WHERE total > 1 GROUP BY level, pos // 16, total
), around AS (
    SELECT a.tree, a.pos, 0 AS stage, n.level, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (WHERE n.pos < (a.pos >> CAST(4 * n.level AS BIGINT))), '') AS before, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (WHERE n.pos > (a.pos >> CAST(4 * n.level AS BIGINT))), '') AS after
    FROM leaves a JOIN nodes n ON a.tree = n.tree AND n.total > 1 AND n.pos // 16 = (a.pos >> CAST(4 * n.level + 4 AS BIGINT))
    GROUP BY ALL
    UNION ALL
    SELECT a.tree, a.pos, 1, n.level, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (WHERE n.pos < (a.tree >> CAST(4 * n.level AS BIGINT))), ''), coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (WHERE n.pos > (a.tree >> CAST(4 * n.level AS BIGINT))), '')
    FROM leaves a JOIN upper n ON n.total > 1 AND n.pos // 16 = (a.tree >> CAST(4 * n.level + 4 AS BIGINT))
    GROUP BY ALL
), proofs AS (
    SELECT tree, pos, list(before || '|' || after ORDER BY stage, level) AS proof FROM around GROUP BY tree, pos
), folded AS (
    SELECT l.*, coalesce(proof, []) AS proof, list_reduce(coalesce(proof, []), lambda node, x: sha256(split_part(x, '|', 1) || node || split_part(x, '|', 2)), coalesce(changed, leaf)) AS folded_root
    FROM leaves l LEFT JOIN proofs p ON l.tree = p.tree AND l.pos = p.pos
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(proof, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded JOIN subroots USING (tree), (SELECT node AS root FROM upper WHERE total = 1)
"""


OP12 = f"""
WITH {CRC_TABLE}, turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS own FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT l.conv_id, list_concat(coalesce(b.own[1:h], []), l.own[h + 1:]) AS path
    FROM (SELECT *, {crc('conv_id')} % 9 AS h FROM lists, crc_table) l LEFT JOIN lists b ON b.conv_id = l.conv_id - l.conv_id % 5
), members AS (
    SELECT conv_id, d AS depth, len(path) AS ends_at, sha256(CAST(path[1:d] AS VARCHAR)) AS node, CASE WHEN d > 0 THEN sha256(CAST(path[1:d - 1] AS VARCHAR)) END AS up, CASE WHEN d > 0 THEN strlen(path[d].text) ELSE 0 END AS size
    FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends_at = depth), '')) AS ends_sha256
    FROM members GROUP BY depth, node
), children AS (
    SELECT up AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY ALL
), below AS (
    SELECT DISTINCT a.depth, a.node, b.depth AS below_depth, b.node AS below_node FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
    SELECT w.depth, w.node, count_if(c.n IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM below w JOIN nodes n ON n.depth = below_depth AND n.node = below_node LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
    GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.node = n.node
LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.up
"""

OP13 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), frequent AS (
    SELECT g, count(*) AS docs FROM shingles GROUP BY g
), ranked AS (
    SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY docs, g) AS place FROM shingles JOIN frequent USING (g)
), rare AS (  -- sets of a Jaccard of 0.85 share one of the rarest n - ceil(0.85 n) + 1 shingles of either
    SELECT doc_id, n, g FROM ranked WHERE place <= n - (85 * n + 99) // 100 + 1
), candidates AS (
    SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), shared AS (
    SELECT a, b, x.n AS a_n, y.n AS b_n, count(*) AS common FROM candidates JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b AND y.g = x.g GROUP BY ALL
), links AS (
    SELECT a, b FROM shared WHERE 100 * common >= 85 * (a_n + b_n - common) UNION ALL SELECT b, a FROM shared WHERE 100 * common >= 85 * (a_n + b_n - common)
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""
