"""DuckDB SQL for the queries that SQL can express."""

from citystream.llm.license import HEADER, MARKS, TEMPLATES, WHOLE, Model

OP5 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10
"""

OP6 = r"""
WITH parts AS (
  SELECT page_id, lower(regexp_extract(split_tail, '^[^/?#]*')) AS host,
         regexp_extract(split_tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS split_tail
        FROM pages)),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, r.verdict, r.rule_host || r.rule_path AS rule
  FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host) DESC, length(r.rule_path) DESC) = 1)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, row_no, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
tf AS (SELECT row_no, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM d) GROUP BY row_no, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, total GROUP BY term),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN sized USING (row_no), total
  GROUP BY item_id, doc_id, row_no),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""

OP13 = r"""
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lent AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)))) % 6 AS h
  FROM own),
built AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM lent c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
paths AS (
  SELECT conv_id, len(turns) AS size, depth, list_slice(turns, 1, depth) AS node
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM built)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256
  FROM paths GROUP BY node, depth),
births AS (
  SELECT list_slice(node, 1, depth - 1) AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (
  SELECT n.*, coalesce(b.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN births b ON b.depth = n.depth AND b.node = n.node
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = list_slice(n.node, 1, n.depth - 1)),
sums AS (
  SELECT list_slice(node, 1, d) AS node, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(node[depth].text) ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM known) GROUP BY ALL)
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM known k JOIN sums s ON s.depth = k.depth AND s.node = k.node
"""


def _values(rows) -> str:
    quoted = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join(f"({', '.join(map(quoted, r))})" for r in rows)


def _scored(m: Model, lines: str, t: str) -> str:
    """CTEs up to scored_<t>(line, license, score): all of ``lines`` against the templates of ``m``."""
    return rf"""
weights_{t}(term, weight) AS (VALUES {_values(sorted(m.weights.items()))}),
postings_{t}(term, template, part) AS (VALUES {_values(m.postings)}),
norms_{t}(template, license, norm) AS (VALUES {_values(m.norms)}),
terms_{t} AS (
  SELECT line, term, count(*) AS tf
  FROM (SELECT line, trim(unnest(regexp_split_to_array(lower(line), '[^a-z0-9.]+')), '.') AS term
        FROM (SELECT DISTINCT line FROM {lines}))
  WHERE term <> '' GROUP BY line, term),
weighed_{t} AS (
  SELECT line, term, tf * coalesce(weight, {m.unseen}) AS part_a FROM terms_{t} LEFT JOIN weights_{t} USING (term)),
own_norms_{t} AS (SELECT line, CAST(sum(part_a * part_a) AS DOUBLE) AS norm_a FROM weighed_{t} GROUP BY line),
dots_{t} AS (
  SELECT line, template, CAST(sum(part_a * part) AS DOUBLE) AS dot
  FROM weighed_{t} JOIN postings_{t} USING (term) GROUP BY line, template),
scored_{t} AS (
  SELECT line, license, dot / sqrt(CAST(norm AS DOUBLE) * norm_a) AS score
  FROM dots_{t} JOIN norms_{t} USING (template) JOIN own_norms_{t} USING (line)
  WHERE dot / sqrt(CAST(norm AS DOUBLE) * norm_a) >= {m.threshold}),"""


def _op2() -> str:
    return rf"""
WITH files AS (
  SELECT CASE WHEN doc_id IS NOT NULL THEN concat_ws('/', source, lang, CAST(CAST(floor(doc_id / 100) AS BIGINT) AS VARCHAR),
                   CASE WHEN length(text) <= 400 THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END) END AS path,
         text, length(text) <= 400 AS named
  FROM documents),
plain AS (SELECT path, text, named, regexp_replace(text, '{MARKS}', '', 'g') AS bare FROM files),
lines AS (
  SELECT DISTINCT path, line FROM (
    SELECT path, unnest(string_split(text, chr(10))) AS line FROM files
    UNION ALL SELECT path, replace(unnest(regexp_split_to_array(bare, '\n\n+')), chr(10), ' ') FROM plain
    UNION ALL SELECT path, replace(regexp_replace(regexp_extract(text, '{HEADER}'), '{MARKS}', '', 'g'), chr(10), ' ') FROM files)),
wholes AS (SELECT DISTINCT path, replace(bare, chr(10), ' ') AS line FROM plain WHERE named),
{_scored(Model(), 'lines', 'part')}
{_scored(Model(TEMPLATES + WHOLE), 'wholes', 'whole')}
own AS (
  SELECT path, license, score
  FROM (SELECT path, license, score FROM lines JOIN scored_part USING (line)
        UNION ALL SELECT path, license, score FROM wholes JOIN scored_whole USING (line))
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
given AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS above, license, score FROM own WHERE regexp_matches(path, '/LICENSE-[0-9]+$')
  QUALIFY row_number() OVER (PARTITION BY above ORDER BY score DESC, license) = 1),
placed AS (SELECT path, regexp_replace(path, '/?[^/]*$', '') AS dir FROM files),
nearest AS (
  SELECT dir, above, license, score
  FROM (SELECT DISTINCT dir FROM placed) JOIN given ON dir = above OR starts_with(dir, above || '/') OR above = ''
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC) = 1)
SELECT p.path, coalesce(o.license, n.license) AS license, coalesce(o.score, n.score) AS score,
       CASE WHEN o.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN o.license IS NULL THEN n.above END AS inherited_from
FROM placed p LEFT JOIN own o USING (path) LEFT JOIN nearest n USING (dir)
"""


OP3 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, max(page_id) AS first_id FROM p GROUP BY html),
sha AS (SELECT html, first_id, sha1(html) AS hex FROM firsts),
bits AS (
  SELECT html, first_id, list_reduce(list_prepend('', list_transform(range(0, 20),
      lambda i: lpad(bin(CAST(concat('0x', substr(hex, CAST(2 * i + 1 AS INT), 2)) AS UTINYINT)), 8, '0'))), lambda a, b: a || b) AS b
  FROM sha),
coded AS (
  SELECT html, first_id, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + list_reduce(list_prepend(0, list_transform(range(0, 5), lambda j: CAST(substr(b, CAST(5 * i + j + 1 AS INT), 1) AS INT))),
                      lambda x, y: 2 * x + y), 1)), '') AS payload_digest
  FROM bits)
SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes, c.payload_digest,
       CASE WHEN p.page_id = c.first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> c.first_id THEN c.first_id END AS refers_to
FROM p JOIN coded c USING (html)
"""

OP8 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after,
         replace(replace(replace(text, '\', '\0'), '</turn>', '\1'), '### ', '\2') AS escaped
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(role) + 2 + length(escaped) + 8) AS BIGINT) AS formatted_chars,
       bool_and(CASE before WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
                            WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END
                AND (after IS NOT NULL OR role IN ('user', 'assistant'))) AS valid
FROM m GROUP BY conv_id
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spots AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS s FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS win FROM spots),
lens AS (SELECT DISTINCT n FROM wins),
places AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.s, p.n, x.item_id
  FROM (SELECT doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS win FROM places) p JOIN wins x ON p.win = x.win AND p.n = x.n),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

ORACLE = {"op2_license": _op2(), "op3_warc": OP3, "op5_top_k": OP5, "op6_url_filter": OP6, "op8_chat": OP8, "op10_decontaminate": OP10,
          "op11_ranked": OP11, "op13_prefix_trie": OP13}
