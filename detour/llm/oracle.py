"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS span
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS span
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.r, dw.i, bw.n, bw.item FROM dw JOIN bw USING (n, span)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

_OP5 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_OP6 = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
v AS (SELECT p.conv_id, perspective, turn, role, text,
             CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' ELSE 'user' END AS rendered_role,
             '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
                               ELSE 'user name=' || translate(replace(role, '<|im_', '<| im_'), chr(13) || chr(10), '  ') END || chr(10) AS header
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (SELECT *, header || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS segment FROM v),
o AS (SELECT *, row_number() OVER w - 1 AS position,
             (coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
      FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, perspective, position, turn, role, rendered_role, segment, start,
       CASE WHEN rendered_role = 'assistant' AND role = perspective THEN start + length(header) END AS trained_start,
       CASE WHEN rendered_role = 'assistant' AND role = perspective THEN start + length(segment) - 1 END AS trained_end
FROM o
"""

ORACLE_SQL: dict[str, str] = {
    "op4_winnowing": _OP4,
    "op5_stream_dedup": _OP5,
    "op6_perspective_rotation": _OP6,
}
