"""SQL for DuckDB of the numbered queries that SQL can express."""

_SPACE = r"[\x20\x09-\x0D]+"

OP2 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') AS r, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS x FROM rows_)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(r) + 1 + length(x) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP3 = r"""
WITH RECURSIVE
w AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS k FROM s GROUP BY 1),
c AS (SELECT p.doc_id AS x, q.doc_id AS y, count(*) AS both_ FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * both_ >= 85 * (p.k + q.k - both_)),
r(doc_id, to_) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.to_ = l.x)
SELECT doc_id, coalesce(any_value(k), 0)::BIGINT AS n_shingles, min(to_) AS component_id, doc_id = min(to_) AS kept FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP4 = r"""
WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM bi)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY 1),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
f AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(r, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Za-z\x{{80}}-\x{{10FFFF}}]', '', 'g')) AS letters, coalesce(list_max(map_values(list_histogram(ws))), 0) AS commonest,
  len(list_filter(ls, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*\x{{2022}}]'))) AS bullets, len(list_filter(ls, lambda l: regexp_matches(l, '([.][.][.]|\x{{2026}})[\x20\x09-\x0D]*$'))) AS cut_off, length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(regexp_replace(t, '[^a-z]', '', 'g')) AS shouted FROM d JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  10 * n_symbols > 3 * n_words OR NOT (word_chars BETWEEN 2 * n_words AND 20 * n_words) OR shouted OR 10 * n_dup_lines > 5 * n_lines
   OR 2 * letters < word_chars OR 10 * commonest > 4 * n_words OR 10 * bullets > 9 * n_lines OR 10 * cut_off > 4 * n_lines AS rejected FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM j
"""

OP11 = r"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

OP12 = rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

OP13 = r"""
WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS ws FROM documents),
b AS (SELECT item_id, unnest(list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '')) AS term FROM benchmark),
t AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM b) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, t GROUP BY term, n_docs),
c AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS c FROM tf JOIN w USING (term), t),
s AS (SELECT item_id, doc_id, sum(c)::BIGINT AS score FROM b JOIN c USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10
"""
