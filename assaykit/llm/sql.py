"""DuckDB statements with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from assaykit.llm import chat, clustering, contamination, divergence, urls, vectors


def _hits(terms: tuple[str, ...], weight: str) -> str:
    """`strict`: hits with boundaries, a term at a time; `soft`: terms that have one."""
    bound = "[^a-z0-9\\x{80}-\\x{10FFFF}]"
    # a doubled boundary lets neighbouring hits share the character between them
    padded = f"regexp_replace(' ' || low || ' ', '({bound})', '\\1\\1', 'g')"
    each = [f"len(regexp_extract_all({padded}, '{bound}{t}{bound}'))" for t in terms]
    return " + ".join(each if weight == "strict" else [f"({e} > 0)::INT" for e in each])


_PREFIX = " UNION ALL ".join(
    f"SELECT '{verdict}' AS v, '{rule}' AS r, '{rule.partition('/')[0]}' AS h, "
    f"'/{rule.partition('/')[2]}' AS p"
    for verdict, rule in urls.RULES
)

URL_FILTER = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
      '{urls.UPPER}', '{urls.UPPER.lower()}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    translate(coalesce(url, ''), '{urls.UPPER}', '{urls.UPPER.lower()}') AS low
  FROM pages
), rules AS ({_PREFIX}), counted AS (
  SELECT *, ({_hits(urls.STRICT, "strict")})::BIGINT AS n_strict,
    ({_hits(urls.SOFT, "soft")})::BIGINT AS n_soft,
    (SELECT arg_max({{'r': r, 'v': v}}, length(r)) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM parts
)
SELECT page_id, host, path, best.r AS rule, n_strict, n_soft,
  coalesce(best.v, CASE WHEN n_strict > 0 OR n_soft >= {urls.SOFT_LIMIT}
    THEN 'block' ELSE 'allow' END) AS verdict
FROM counted
"""

EXACT_TOP_K = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({vectors.SCALE} * x::DOUBLE)) AS e, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INT AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 5
"""

_ESC = "replace(replace({}, '&', '&amp;'), '<', '&lt;')"
_MARKS = len(chat.NEW + chat.ROLE + chat.ROLE_END + chat.END)

CHAT_FORMATTING = rf"""
WITH RECURSIVE probe AS (
  SELECT -7::BIGINT AS conv_id, t AS turn, r AS role, '\### Assistant: </turn> ok' AS text
  FROM (VALUES (0::BIGINT, 'user'), (1::BIGINT, 'assistant')) p(t, r)
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER w - 1 AS pos,
    CAST(ceil(length(coalesce(text, '')) / {chat.CHARS_PER_TOKEN}.0) AS BIGINT) + {chat.MARKS_PER_TURN} AS tokens,
    {_MARKS} + length({_ESC.format("coalesce(role, '')")}) + length({_ESC.format("coalesce(text, '')")}) AS chars
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM probe)
  WINDOW w AS (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), summed AS (
  SELECT *, sum(tokens) OVER c AS upto, sum(chars) OVER c AS chars_upto,
    sum(CASE WHEN pos = 0 AND role = '{chat.SYSTEM}' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS system_tokens,
    sum(CASE WHEN pos = 0 AND role = '{chat.SYSTEM}' THEN chars ELSE 0 END) OVER (PARTITION BY conv_id) AS system_chars
  FROM turns
  WINDOW c AS (PARTITION BY conv_id ORDER BY pos)
), t AS (
  SELECT *, greatest({chat.BUDGET} - system_tokens, 0) AS free,
    least({chat.HISTORY}, greatest({chat.BUDGET} - system_tokens, 0) // 2) AS reach
  FROM summed
), cuts AS (
  SELECT conv_id, 0 AS start, {chat.BUDGET}::BIGINT AS room FROM t WHERE pos = 0
  UNION ALL
  SELECT conv_id, start, room FROM (
    SELECT c.conv_id, min(n.pos) AS start, any_value(n.free - n.reach)::BIGINT AS room
    FROM cuts c JOIN t s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.pos = c.start
      JOIN t n ON n.conv_id IS NOT DISTINCT FROM c.conv_id AND n.pos > c.start
        AND (n.upto - (s.upto - s.tokens) > c.room
          OR (n.upto - n.tokens) // {chat.BLOCK} > (s.upto - s.tokens) // {chat.BLOCK})
    GROUP BY c.conv_id
  )
), spans AS (
  SELECT *, lead(start) OVER (PARTITION BY conv_id ORDER BY start) AS stop FROM cuts
), owned AS (
  SELECT c.conv_id, c.start, sum(t.tokens) AS own
  FROM spans c JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id AND t.pos >= c.start
    AND (c.stop IS NULL OR t.pos < c.stop)
  GROUP BY c.conv_id, c.start
), repeated AS (
  SELECT c.conv_id, c.start, any_value(s.system_chars) AS system_chars,
    coalesce(sum(h.chars) FILTER ((s.upto - s.tokens) - (h.upto - h.tokens)
        <= least(s.reach, greatest(s.free - c.own, 0))
      AND NOT (h.pos = 0 AND h.role = '{chat.SYSTEM}')), 0) AS past
  FROM owned c JOIN t s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.pos = c.start
    LEFT JOIN t h ON h.conv_id IS NOT DISTINCT FROM c.conv_id AND h.pos < c.start
  WHERE c.start > 0 GROUP BY c.conv_id, c.start
), past AS (SELECT conv_id, sum(system_chars + past) AS chars FROM repeated GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{chat.TARGET}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = '{chat.TARGET}'), '')) AS loss_sha256,
  (sum(t.chars) + coalesce(any_value(past.chars), 0))::BIGINT AS formatted_chars
FROM t LEFT JOIN past ON past.conv_id IS NOT DISTINCT FROM t.conv_id
GROUP BY t.conv_id
"""

_WORDS = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
i AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, l, array_to_string(words[s : s + l - 1], ' ') AS w
  FROM (SELECT item_id, words, least(len(words), {contamination.WINDOW}) AS l,
    unnest(range(1, len(words) - least(len(words), {contamination.WINDOW}) + 2)) AS s
    FROM i WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, l, s, array_to_string(words[s : s + l - 1], ' ') AS w
  FROM (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS s
    FROM d, (SELECT DISTINCT l FROM iw) ls WHERE len(words) >= l)
), m AS (SELECT * FROM dw SEMI JOIN iw USING (l, w)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM m) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m JOIN iw USING (l, w)) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
  coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _lloyd_round(i: int) -> str:
    """Assignment to the centroids c{i} and the centroids that follow from it."""
    return f"""
a{i} AS MATERIALIZED (
  SELECT r, any_value(v.x) AS x, min({{'d': list_sum(list_transform(range(1, {clustering.DIMS + 1}),
    lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))::BIGINT, 'c': c.c}}) AS m
  FROM kept v, c{i} c GROUP BY r
), c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM (
      SELECT m.c AS c, j, sum(x[j])::HUGEINT AS s, count(*) AS n
      FROM a{i}, range(1, {clustering.DIMS + 1}) t(j) GROUP BY m.c, j) GROUP BY c) n USING (c)
)"""


CENTROID_CLUSTERING = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor({clustering.SCALE} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {clustering.DIMS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || vec_id), x) - 1 AS c, x
  FROM kept QUALIFY c < {clustering.CLUSTERS}
), {",".join(_lloyd_round(i) for i in range(clustering.ROUNDS + 1))}
SELECT vec_id, m.c::INT AS cluster, m.d AS distance,
  (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{clustering.ROUNDS} a JOIN kept USING (r) JOIN c{clustering.ROUNDS} c ON c.c = m.c
"""

SOURCE_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.UPPER.lower()}'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term
  HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}
), l AS (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({divergence.ONE}::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * l.v) AS p,
    1 + ({divergence.ONE}::HUGEINT * (k.lang_n + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN kept k USING (lang) JOIN l USING (lang)
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM f QUALIFY part = 'pair' OR rank <= {divergence.TERM_RANKS}
"""
