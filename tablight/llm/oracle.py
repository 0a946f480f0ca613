"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations


_ESC = """replace(replace({0}, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')"""

SQL: dict[str, str] = {}

SQL["op2_pivot_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

SQL["op6_chat_format"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         CAST(sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + 8 + 8 + 7) AS BIGINT) AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""

_SHINGLES = """
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[ ' || chr(9) || '-' || chr(13) || ']+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM w
), sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
toks AS (SELECT doc_id, unnest(s) AS tok FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM toks a JOIN toks b ON a.tok = b.tok AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links)
"""

SQL["op9_jaccard_join"] = f"""
WITH RECURSIVE {_SHINGLES},
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT e.y, r.c FROM reach r JOIN edges e ON e.x = r.doc_id
)
SELECT s.doc_id, s.n AS n_shingles, min(r.c) AS component_id
FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""

_WHITE = "' ' || chr(9) || '-' || chr(13)"

SQL["op11_fim_boundaries"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[' || {_WHITE} || ']*[^' || {_WHITE} || ']+|[' || {_WHITE} || ']+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), x AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM x
), p AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a+1:b], '') AS middle,
         array_to_string(u[b+1:], '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

SQL["op13_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?' || chr(10) || '-' || chr(13) || ']')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ ' || chr(9) || ']+'), lambda x: x <> '') AS w FROM pieces
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang HAVING sum(len(w)) > 0
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i+k-1])) AS g
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, g, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), cand AS (SELECT * FROM f WHERE k > 1),
inner_ AS (
  SELECT c.lang, c.f, unnest(list_distinct(flatten(list_transform(range(2, c.k), lambda m: list_transform(range(1, c.k - m + 2), lambda i: c.g[i:i+m-1]))))) AS g
  FROM cand c WHERE c.k > 2
), covered AS (
  SELECT DISTINCT i.lang, i.g FROM inner_ i JOIN cand c ON c.lang = i.lang AND c.g = i.g WHERE 100 * i.f >= 100 * c.f
), cuts AS (
  SELECT c.lang, c.g, c.k, c.f AS a, unnest(range(1, c.k)) AS cut
  FROM cand c ANTI JOIN covered v ON v.lang = c.lang AND v.g = c.g
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, t.n, CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.cut+1:]
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM best
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= 2000
"""
