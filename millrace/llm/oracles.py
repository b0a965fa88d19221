"""DuckDB SQL of queries whose operators have none beside them."""

from string import ascii_lowercase, ascii_uppercase

OP1_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), word AS (
  SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM doc
), win AS (
  SELECT r, w, i, string_agg(w, ' ') OVER f AS k, count(*) OVER f AS n FROM word
  WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), counted AS (
  SELECT r, w, i, n = 35 AND count(*) FILTER (n = 35) OVER (PARTITION BY k) > 1 AS again FROM win
), marked AS (
  SELECT r, w, i, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted
), kept AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM marked GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _windows(size: int) -> str:
    """Words with the window of ``size`` words that starts at each, and the word places it covers."""
    return f"""
  SELECT r, i, {size} AS size, string_agg(w, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING) AS k,
         count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING) AS n FROM word"""


OP2_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
), word AS (
  SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM doc
), item AS (
  SELECT item_id::VARCHAR AS item_id, {_WORDS} AS words, least(len({_WORDS}), 10) AS size FROM benchmark
), item_start AS (
  SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM item WHERE size > 0
), item_window AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS k FROM item_start
), win AS ({" UNION ALL ".join(map(_windows, range(1, 11)))}
), hit AS (
  SELECT r, i, win.size, item_id FROM win JOIN item_window ON win.size = item_window.size AND win.k = item_window.k WHERE n = win.size
), place AS (
  SELECT DISTINCT r, unnest(range(i, i + size)) AS place FROM hit
), places AS (
  SELECT r, count(*) AS n_hit FROM place GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS listed FROM hit GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""

OP5_SQL = rf"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), word AS (
  SELECT r, len(words) AS n, unnest(words) AS w, unnest(range(len(words))) AS i FROM doc
), win AS (
  SELECT r, n, string_agg(w, ' ') OVER f AS k, count(*) OVER f AS c, i FROM word
  WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)
), shingle AS (
  SELECT DISTINCT r, k FROM win WHERE c = 3 OR n < 3 AND i = 0
), size AS (
  SELECT r, count(*) AS n FROM shingle GROUP BY r
), both_ AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.k = b.k AND a.r < b.r GROUP BY a.r, b.r
), half AS (
  SELECT a, b FROM both_ JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), link AS (
  SELECT a, b FROM half UNION ALL SELECT b, a FROM half
), reach AS (
  SELECT r AS a, r AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), component AS (
  SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN doc ON doc.r = reach.b GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM doc JOIN component USING (r) LEFT JOIN size USING (r)
"""

OP8_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT lpad(conv_id::VARCHAR, 20, '0') || '/' || lpad(turn::VARCHAR, 20, '0') AS msg_id, text,
         lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS x0, lag(x0, 1) OVER w AS x1, lag(x0, 2) OVER w AS x2
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), known AS (
  SELECT msg_id AS parent_id, [x0] AS k FROM turns UNION ALL
  SELECT msg_id, [x0, x1] FROM turns WHERE x1 IS NOT NULL UNION ALL
  SELECT msg_id, [x0, x1, x2] FROM turns WHERE x2 IS NOT NULL
), linked AS (
  SELECT msg_id, text, max(parent_id) AS parent_id FROM turns
  LEFT JOIN known ON known.k = CASE WHEN x2 IS NOT NULL THEN [x1, x2] WHEN x1 IS NOT NULL THEN [x1] END AND parent_id < msg_id
  GROUP BY msg_id, text
), tree AS (
  SELECT msg_id, msg_id AS root, 0 AS depth FROM linked WHERE parent_id IS NULL UNION ALL
  SELECT linked.msg_id, tree.root, tree.depth + 1 FROM linked JOIN tree ON linked.parent_id = tree.msg_id
)
SELECT msg_id, root AS conversation_id, parent_id, depth::BIGINT AS depth,
       row_number() OVER (PARTITION BY root ORDER BY depth, msg_id) - 1 AS position,
       sha256(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS own_sha256
FROM tree JOIN linked USING (msg_id)
"""
