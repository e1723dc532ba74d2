"""SQL for what SQL can express, run on the same tables."""

_URL = """
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM p
), r(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT page_id, host, path, r.h || r.p AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.h || r.p) DESC NULLS LAST) AS k
  FROM h LEFT JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_LEAKS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
b10 AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, 10 AS n FROM (
  SELECT item_id, w, unnest(generate_series(1, len(w) - 9)) AS i FROM b WHERE len(w) >= 10)),
bshort AS (SELECT item_id, array_to_string(w, ' ') AS g, len(w) AS n FROM b WHERE len(w) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT n FROM bshort UNION SELECT 10),
dg AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
  SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dg.n, item_id FROM dg JOIN (SELECT * FROM b10 UNION ALL SELECT * FROM bshort) USING (g, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), e AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS r, replace(replace(text, '\', '\\'), '<|', '<\|') AS t FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(r) + 1 + length(t) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_NEAR = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d
), n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s), e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, t.b FROM r JOIN t ON r.b = t.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""

_TOP = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM e q JOIN e x ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id AND len(x.v) = len(q.v)
), r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS nl FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
ng AS (SELECT lang, source, sum(n) AS n_own FROM c JOIN k USING (lang, term) GROUP BY ALL),
x AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (coalesce(n_own, 0) + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 5)) // (nl + 5 * v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN ng USING (lang, source) LEFT JOIN c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN far USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM x WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLES = {"op11_divergence": _DIVERGENCE, "op6_top_k": _TOP, "op5_near_duplicates": _NEAR, "op7_chat_format": _CHAT, "op1_url_filter": _URL, "op2_decontamination": _LEAKS}
