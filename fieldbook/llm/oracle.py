"""DuckDB SQL of the operators' queries, where SQL can express them."""

LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOW}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE [array_to_string(ws[i : i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS node, a AS other FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON r.other = e.a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least ON node = doc_id
"""

OP5 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest([array_to_string(w[j : j + least(len(w), 13) - 1], ' ') FOR j IN range(1, len(w) - least(len(w), 13) + 2)]) AS g
  FROM i WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM win),
at_ AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n),
run AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g FROM at_),
hit AS (SELECT doc_id, n, p, item_id FROM run JOIN win USING (n, g)),
place AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hit)),
counted AS (SELECT doc_id, count(*) AS n_hit FROM place GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents
), keyed AS (
  SELECT *, translate(trim(x, {BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line
), often AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (top IS NOT NULL AND top <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY p) FILTER (top IS NULL OR top = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (k) GROUP BY doc_id
"""

OP12 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
    CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS m,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), part AS (
  SELECT *, array_to_string(list_slice(u, 1, p), '') AS a, array_to_string(list_slice(u, p + 1, m), '') AS b,
    array_to_string(list_slice(u, m + 1, n), '') AS c FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part
"""

SQL = {"op3_ngram_jaccard": OP3, "op5_decontamination": OP5, "op10_line_dedup": OP10, "op12_fill_in_middle": OP12}
