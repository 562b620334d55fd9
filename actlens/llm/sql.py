"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from actlens.llm.line_dedup import RATIO, Z, test_slope
from actlens.llm.vector_codes import ENTRIES, PARTS, ROUNDS
from actlens.llm.warc import MIN_REVISIT

#: Line dedup: documents with ``lines``, ``kept`` and ``dropped`` (number).
LINES_CTE = f"""
pages AS (SELECT *, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT source, text, unnest(list_distinct(list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line
         FROM pages),
freq AS (SELECT source, line, count(DISTINCT text) AS n FROM line WHERE line != '' GROUP BY ALL),
host AS (SELECT source, count(DISTINCT text) AS total FROM pages GROUP BY ALL),
gone AS (SELECT f.source, list(f.line) AS gone FROM freq f JOIN host h ON f.source IS NOT DISTINCT FROM h.source
         WHERE f.n - {RATIO}::DOUBLE * h.total > 0 AND
               (f.n - {RATIO}::DOUBLE * h.total) * (f.n - {RATIO}::DOUBLE * h.total) > {test_slope(RATIO, Z)!r}::DOUBLE * h.total
         GROUP BY ALL),
kept AS (SELECT p.*, list_filter(lines, lambda x: gone IS NULL OR NOT list_contains(gone, trim(x, ' ' || chr(9) || chr(13)))) AS kept
        FROM pages p LEFT JOIN gone g ON p.source IS NOT DISTINCT FROM g.source)
"""

def _codes_sql() -> str:
    """Vector codes by comparing each part with every entry, round after round."""
    steps = [f"""
kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v
         FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT r, vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
         FROM kept, range({PARTS}) t(p)),
book0 AS MATERIALIZED (SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id, x) - 1 AS e FROM part)
         WHERE e < {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (SELECT p, r, min({{'d': d, 'e': e}}) AS n FROM (SELECT a.p, r, e,
         list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
         FROM part a JOIN book{i} b ON a.p = b.p) GROUP BY p, r)""")
        if i < ROUNDS:
            steps.append(f"""
mean{i} AS (SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY j) AS x FROM (
         SELECT p, e, j, sum(x) AS s, count(*) AS n FROM (SELECT a.p, n.n.e AS e, unnest(a.x) AS x, generate_subscripts(a.x, 1) AS j
         FROM part a JOIN near{i} n ON a.p = n.p AND a.r = n.r) GROUP BY p, e, j) GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x)::BIGINT[] AS x FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.e = m.e)""")
    steps.append(f"""
coded AS MATERIALIZED (SELECT r, string_agg(printf('%02x', n.e), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r),
summed AS (SELECT label, sum(error)::BIGINT AS label_error FROM kept JOIN coded USING (r) GROUP BY label)""")
    return f"""WITH {','.join(steps)}
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (r) JOIN summed ON kept.label IS NOT DISTINCT FROM summed.label"""


ORACLE: dict[str, str] = {
    "op3_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT html, max(page_id) AS original FROM p WHERE n >= {MIN_REVISIT} GROUP BY html)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN original != page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original != page_id THEN original END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html""",
    "op5_line_dedup": f"""
WITH {LINES_CTE}
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
       sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM kept""",
    "op11_vector_codes": _codes_sql(),
    "op13_prefix_trie": """
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
               {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY p) AS ts,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
            lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS h
        FROM turns GROUP BY conv_id),
anew AS (SELECT a.conv_id AS c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts
         FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefix AS (SELECT c, len(ts) AS n, d, ts[1:d] AS path FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM anew)),
node AS MATERIALIZED (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, list(c ORDER BY c) FILTER (n = d) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(path[d].x)) END AS b FROM prefix GROUP BY path, d),
child AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
below AS (SELECT path[1:k] AS path, k AS d, sum((n_convs - 1) * b) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
          FROM (SELECT node.*, n_children, unnest(range(node.d + 1)) AS k FROM node LEFT JOIN child USING (path, d)) GROUP BY ALL)
SELECT node.conv_id, node.d::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(array_to_string(node.ends, ','), '')) AS ends_sha256
FROM node JOIN below USING (path, d) LEFT JOIN child USING (path, d)
LEFT JOIN node up ON node.d > 0 AND up.d = node.d - 1 AND up.path = node.path[1:node.d - 1]""",
}
