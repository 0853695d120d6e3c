"""DuckDB formulations of the registered queries that SQL can express."""

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _FOLD + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = "regexp_extract_all(" + _FOLD + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_MARK = r"[<\[]\\*(/?s>|(/?INST|/?SYS|ANS|ROLE|/?TURN)\])"

ORACLE: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, list_aggregate(w[p : p + least(10, len(w)) - 1], 'string_agg', ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, sizes WHERE len(w) >= m),
hit AS (SELECT doc_id, item_id, p, dw.m FROM dw JOIN win ON dw.m = win.m AND win.s = list_aggregate(dw.w[p : p + dw.m - 1], 'string_agg', ' ')),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op2_substrings": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, p, md5(array_slice(b, p, p + 199)) AS k FROM (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS p FROM d)),
rep AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
hit AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM w SEMI JOIN rep USING (k)),
isle AS (SELECT r, p, sum(CASE WHEN q IS NULL OR p - q > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS i FROM hit),
span AS (SELECT r, i, min(p) AS a, max(p) + 200 AS z FROM isle GROUP BY r, i),
gone AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY r),
gap AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS a, a AS z FROM span
        UNION ALL SELECT r, max(z), 9223372036854775807 FROM span GROUP BY r),
kept AS (SELECT r, string_agg(hex(array_slice(b, a, least(z - 1, octet_length(b)))), '' ORDER BY a) AS h
         FROM gap JOIN d USING (r) WHERE a < z AND a <= octet_length(b) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(h, ''))) END AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)""",
    "op3_near_duplicates": rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_FOLD.format("text")}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT r, list_aggregate(w[p : p + least(5, len(w)) - 1], 'string_agg', ' ') AS x
      FROM (SELECT r, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pair AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.r < b.r GROUP BY 1, 2),
link AS (SELECT d1.doc_id AS a, d2.doc_id AS b FROM pair JOIN n x ON x.r = pair.a JOIN n y ON y.r = pair.b
         JOIN d d1 ON d1.r = pair.a JOIN d d2 ON d2.r = pair.b
         WHERE 100 * c >= 75 * (x.n + y.n - c) AND d1.doc_id <> d2.doc_id),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS x, a AS y FROM edge UNION SELECT reach.x, edge.b FROM reach JOIN edge ON reach.y = edge.a),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(coalesce(c, d.doc_id) = d.doc_id, true) AS kept
FROM d LEFT JOIN n USING (r) LEFT JOIN comp ON comp.x = d.doc_id""",
    "op11_chat_format": rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(k, r)),
m AS (SELECT *, len(text) + len(regexp_extract_all(text, '{_MARK}')) +
             CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 9
             ELSE 19 + len(role) + len(regexp_extract_all(role, '{_MARK}')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id""",
    "op13_ranked_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_TERMS.format("text")}, []) AS w FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS len FROM d WHERE len(w) > 0),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
g AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY term),
q AS (SELECT item_id, text, unnest({_TERMS.format("text")}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
p AS (SELECT item_id, text, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // len)))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN g USING (term), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM p WHERE score > 0)
WHERE rank <= 10""",
}
