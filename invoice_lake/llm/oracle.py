"""SQL for the text queries whose results SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WINNOWING = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
places AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM places),
doc_places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
  FROM d JOIN (SELECT DISTINCT n FROM item_windows) ON len(w) >= n),
hits AS (SELECT doc_id, p, x.n, item_id FROM (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM doc_places) x
  JOIN item_windows y ON x.n = y.n AND x.win = y.win),
hit_words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

CHATS = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(length('<|turn|>' || '<|text|>' || '<|end|>' || chr(10)) + length(regexp_replace(role, '[<\[\\]', 'xx', 'g'))
    + length(regexp_replace(text, '[<\[\\]', 'xx', 'g'))) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

def _components(words: int, percent: int, kept: str) -> str:
    """Components of texts linked by shingles of so many words."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= {words}
  THEN list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda p: array_to_string(w[p:p + {words - 1}], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b
  ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= {percent} * (len(a.s) + len(b.s) - n)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN ways l ON r.other = l.x)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id{kept}
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


MINHASH, JACCARD = _components(5, 85, ", s.doc_id = component_id AS kept"), _components(3, 90, "")

#: crc32 of an ASCII text, bit by bit.
_CRC = """(list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b:
  list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x // 2, (x % 2) * 3988292384))))"""

TRIE = rf"""
WITH t AS (SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')), octet_length(encode(coalesce(text, '')))) AS k,
    md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS token
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS head, xor({_CRC.format("CAST(conv_id AS VARCHAR)")}, 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (SELECT c.conv_id, k, token, bytes FROM c JOIN t ON t.conv_id = c.head AND k <= h
  UNION ALL SELECT c.conv_id, k, token, bytes FROM c JOIN t ON t.conv_id = c.conv_id AND k > h),
s AS (SELECT c.conv_id, coalesce(list(token ORDER BY k) FILTER (k IS NOT NULL), []) AS seq, coalesce(list(bytes ORDER BY k) FILTER (k IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, array_to_string(seq[1:d], '') AS key, CASE WHEN d = 0 THEN NULL ELSE array_to_string(seq[1:d - 1], '') END AS above,
    coalesce(sizes[d], 0) AS bytes, d = len(seq) AS ended FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM s)),
n AS (SELECT key, any_value(above) AS above, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends FROM p GROUP BY key),
k AS (SELECT above AS key, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
sums AS (SELECT p.key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * f.bytes) AS saved
  FROM f JOIN p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.key)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN sums USING (key) LEFT JOIN n u ON u.key = f.above
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, totals GROUP BY term, n),
parts AS (SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * n) // l))) AS part
  FROM tf JOIN weights USING (term) JOIN d USING (r), totals),
scores AS (SELECT item_id, doc_id, r, CAST(sum(part) AS BIGINT) AS score FROM q JOIN parts USING (term) GROUP BY item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (
  PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0) WHERE rank <= 50
"""

STATEMENTS = {"op4_winnowing": WINNOWING, "op6_typed_chats": CHATS, "op8_minhash": MINHASH, "op11_peeled_trie": TRIE, "op12_shared_search": SEARCH,
              "op13_skipping_jaccard": JACCARD}
