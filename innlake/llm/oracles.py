"""DuckDB SQL for the queries that SQL can express; written against the raw tables."""

_GAP = r"[\x20\x09-\x0D]+"

_WORDS = f"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_GAP}'), lambda x: x <> '') AS w FROM documents)"""

SUFFIX_DEDUP = """
WITH bytes AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, octet_length(b) - 198)) AS p,
    unnest(list_transform(range(1, octet_length(b) - 198), lambda i: md5_number(b[i:i + 199]))) AS h
  FROM bytes WHERE octet_length(b) >= 200),
again AS (SELECT doc_id, p FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
jumps AS (SELECT *, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM again),
runs AS (SELECT doc_id, p, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM jumps),
spans AS (SELECT doc_id, run, min(p) AS first, max(p) + 199 AS last FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, last + 1 AS first, lead(first, 1, octet_length(b) + 1) OVER (PARTITION BY doc_id ORDER BY first) - 1 AS last
  FROM (SELECT doc_id, first, last FROM spans UNION ALL SELECT doc_id, 0, 0 FROM bytes) JOIN bytes USING (doc_id)),
rest AS (
  SELECT doc_id, string_agg(hex(b[first:last]), '' ORDER BY first) AS digits
  FROM gaps JOIN bytes USING (doc_id) WHERE last >= first GROUP BY doc_id),
gone AS (SELECT doc_id, sum(last - first + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(digits, ''))) AS kept_sha256
FROM bytes LEFT JOIN gone USING (doc_id) LEFT JOIN rest USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH {_WORDS},
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words),
windows AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS h FROM places WHERE p + 34 <= len(w)),
again AS (SELECT doc_id, p FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
latest AS (
  SELECT x.doc_id, x.p, x.w[x.p] AS word,
    coalesce(x.p - max(a.p) OVER (PARTITION BY x.doc_id ORDER BY x.p) < 35, false) AS gone
  FROM places x LEFT JOIN again a ON a.doc_id = x.doc_id AND a.p = x.p),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS rest
  FROM latest GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

_COMPONENTS = """
reach(node, other) AS (
  SELECT a, b FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node)"""

NEAR_DEDUP = f"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_GAP}'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM lowered WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * both_have >= 80 * (p.n + q.n - both_have)),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(other, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.node = d.doc_id"""

_SOUND = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

VECTOR_DEDUP = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE {_SOUND} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
{_COMPONENTS},
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(other, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(other, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degrees ON degrees.a = e.vec_id LEFT JOIN least ON least.node = e.vec_id"""

TOP_K = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_SOUND}),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10"""


_TERMS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

RANKED_SEARCH = f"""
WITH doc AS (SELECT doc_id, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS docs, sum(len(w)) AS terms FROM doc WHERE len(w) > 0),
asked AS (
  SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
held AS (
  SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM doc)
  WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), total),
sized AS (
  SELECT doc_id, CAST(75 + (25 * len(w) * docs) // terms AS BIGINT) AS m FROM doc, total WHERE len(w) > 0),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN sized USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20"""


HARD_NEGATIVES = f"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {_SOUND}),
scores AS (
  SELECT a.vec_id AS anchor_id, x.vec_id AS other, a.label = x.label AS same,
    CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM whole a JOIN whole x ON a.vec_id <> x.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM scores WHERE same)
  WHERE place <= 5),
negatives AS (
  SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS place
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 3"""
