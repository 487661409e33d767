"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


OP1 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations),
views AS (
  SELECT t.conv_id, v.role AS perspective, t.place // 256 AS segment, t.place, t.role = v.role AS own,
    replace(t.text, '<|', '<\\|') AS body,
    CASE WHEN t.role = v.role THEN '<|im_start|>assistant' || chr(10)
      WHEN t.role = 'system' THEN '<|im_start|>system' || chr(10)
      ELSE '<|im_start|>user name=' || t.role || chr(10) END AS head
  FROM turns t JOIN (SELECT DISTINCT conv_id, role FROM turns WHERE role <> 'system') v
    ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 11) OVER (
      PARTITION BY conv_id, perspective, segment ORDER BY place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS pos
  FROM views)
SELECT conv_id, perspective, segment, min(place) AS first_place, count(*) AS n_messages,
  count(*) FILTER (own) AS n_own,
  string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CAST(pos AS BIGINT) || ':' || CAST(pos + length(body) + 10 AS BIGINT), ',' ORDER BY place)
    FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, perspective, segment
"""

OP2 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(max(z.n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r USING (doc_id) LEFT JOIN sizes z USING (doc_id) GROUP BY d.doc_id
"""

OP3 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP4 = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
rows AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM split),
keyed AS (SELECT *, {_lower(f"trim(line, {BLANKS})")} AS k FROM rows),
marked AS (
  SELECT *, length(k) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY k) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8 = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {WORDS}) AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, {WORDS}) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
      lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS s
  FROM items WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
spans AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM docs, lengths WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, i, spans.n AS n FROM spans JOIN windows ON spans.n = windows.n AND spans.s = windows.s),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS word FROM hits),
counted AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP9 = f"""
WITH rules(rule, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
    ('com/fr/', 'allow'), ('com/de/', 'block')),
rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests),
fitting AS (
  SELECT page_id, max(struct_pack(n := length(rule), rule := rule, verdict := verdict)) AS best
  FROM parts JOIN rules ON ends_with('.' || host, '.' || split_part(rule, '/', 1))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN fitting USING (page_id)
"""


#: The CRC-32 of a decimal number, bit by bit.
OP11 = """
WITH RECURSIVE numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS source, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, zero: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)),
heads AS (
  SELECT i.conv_id, i.h, n.place, n.role, n.text FROM ids i JOIN numbered n ON n.conv_id = i.source AND n.place < i.h),
lengths AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
turns AS (
  SELECT conv_id, place + 1 AS depth, role, text FROM heads
  UNION ALL
  SELECT i.conv_id, n.place - i.h + coalesce(l.n, 0) + 1, n.role, n.text
  FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.place >= i.h LEFT JOIN lengths l ON l.conv_id = i.conv_id),
paths AS (
  SELECT conv_id, depth, length(text) AS points,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (
      PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS node
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM paths GROUP BY conv_id) GROUP BY node),
nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(points) AS saved
  FROM paths GROUP BY node),
up AS (
  SELECT DISTINCT n.node, p.node AS parent FROM paths n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY parent),
above AS (
  SELECT DISTINCT n.node AS node, p.node AS top FROM paths n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
sums AS (
  SELECT top AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM above JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY top)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN children c USING (node) LEFT JOIN up u USING (node)
  LEFT JOIN nodes q ON q.node = u.parent LEFT JOIN ends e ON e.node = n.node
"""


OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    {_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS p
  FROM split, (VALUES (1), (2), (3)) AS lengths(n) WHERE len(w) >= n),
f AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p),
sizes AS (SELECT lang, sum(f) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 10),
places AS (
  SELECT lang, p, a, k, p[1:k] AS head, p[k + 1:] AS tail
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates)),
cuts AS (
  SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM places c JOIN f l ON l.lang = c.lang AND l.p = c.head JOIN f r ON r.lang = c.lang AND r.p = c.tail),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
parts AS (
  SELECT lang, p[1:2] AS p, a FROM candidates WHERE len(p) = 3
  UNION ALL SELECT lang, p[2:3], a FROM candidates WHERE len(p) = 3),
swallowed AS (
  SELECT DISTINCT c.lang, c.p FROM candidates c JOIN parts b ON b.lang = c.lang AND b.p = c.p AND 100 * b.a >= 50 * c.a),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM scored ANTI JOIN swallowed USING (lang, p)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ordered JOIN sizes USING (lang) WHERE rank <= 2000
"""

OP13 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS keep_id FROM payloads)
SELECT page_id, n AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < keep_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < keep_id THEN keep_id END AS refers_to
FROM kept
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_perspectives": OP1,
        "op2_jaccard": OP2,
        "op3_chunk_recipes": OP3,
        "op4_shared_lines": OP4,
        "op8_decontamination": OP8,
        "op9_url_rules": OP9,
        "op11_prefix_trie": OP11,
        "op12_collocations": OP12,
        "op13_warc": OP13,
    }
