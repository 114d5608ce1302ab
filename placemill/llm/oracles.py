"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " + (
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_QUERY = r"regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1)"
for _pattern, _by in ((r"([?&])utm_[^&]*", r"\1"), ("&+", "&"), (r"\?&", "?"), ("[?&]+$", "")):
    _QUERY = f"regexp_replace({_QUERY}, '{_pattern}', '{_by}', 'g')"
_SPACE, _WORD = r"[^ \t\n\r]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CLEAN = "regexp_replace(coalesce(text, ''), '[%*&$#!|]+', '', 'g')"
_COUNT = "len(regexp_extract_all({0}, '{1}'))"
# crc32 of a text, as DuckDB has none: a byte at a time, of each byte a bit at a time.
_BYTES = "list_transform(range(octet_length(encode({0}))), lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))"
_BIT = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"
_CRC32 = f"xor(list_reduce({_BYTES}, lambda crc, byte: {_BIT}, CAST(4294967295 AS BIGINT)), 4294967295)"

#: The versions of op6_token_counts that SQL can count.
OP6_BY_EXPRESSION = f"""
WITH mark AS (
  SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
counted AS (
  SELECT source, lang, coalesce(quality = 0, false) AS cleaned,
    {_COUNT.format("coalesce(text, '')", _SPACE)} AS space, {_COUNT.format(_CLEAN, _SPACE)} AS clean_space,
    {_COUNT.format("coalesce(text, '')", _WORD)} AS word, {_COUNT.format(_CLEAN, _WORD)} AS clean_word
  FROM documents LEFT JOIN mark USING (doc_id) WHERE coalesce(toxic, 0) <> 1),
each AS (
  SELECT source, lang, 'space-1' AS tokenizer, CASE WHEN cleaned THEN clean_space ELSE space END AS tokens FROM counted
  UNION ALL
  SELECT source, lang, 'word-1', CASE WHEN cleaned THEN clean_word ELSE word END FROM counted)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM each GROUP BY source, lang, tokenizer
"""

ORACLES: dict[str, str] = {
    "op3_url_filter": rf"""
WITH page AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, {_QUERY} AS query FROM page),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') || query END AS key FROM part),
rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM keyed k JOIN rules r ON (k.host = r.host OR suffix(k.host, '.' || r.host)) AND starts_with(k.path, r.path)
  GROUP BY page_id),
listed AS (
  SELECT DISTINCT key FROM keyed
  WHERE regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.'))
SELECT k.page_id, k.host, k.path, f.rule,
  coalesce(f.verdict, CASE WHEN k.key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed k LEFT JOIN fits f ON k.page_id = f.page_id
""",
    "op10_benchmark_decontamination": f"""
WITH item AS (
  SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS words
  FROM item, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS t(i) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
doc_window AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM doc, (SELECT DISTINCT size FROM item_window) AS sizes, unnest(generate_series(1, len(w) - size + 1)) AS t(i)
  WHERE len(w) >= size),
hit AS (
  SELECT doc_id, i, size, item_id FROM doc_window JOIN item_window USING (size, words)),
hit_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(generate_series(0, size - 1)) AS t(k) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",
    "op11_spelling_variants": f"""
WITH RECURSIVE run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]{{6,}}')) AS r FROM documents),
hashed AS (
  SELECT r, {_CRC32.format("id || ':' || r")} AS h FROM run),
vocabulary AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
without AS (
  SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM vocabulary, unnest(generate_series(1, length(word))) AS t(p)),
near AS (
  SELECT a.word, b.word AS other FROM without a JOIN without b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION
  SELECT w.word, v.word FROM without w JOIN vocabulary v ON v.word = w.rest
  UNION
  SELECT v.word, w.word FROM without w JOIN vocabulary v ON v.word = w.rest),
best AS (
  SELECT near.word, count(*) AS n_near, list(other ORDER BY n DESC, other)[1] AS top, max(n) AS top_n
  FROM near JOIN vocabulary v ON v.word = near.other GROUP BY near.word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top END AS form,
    CASE WHEN top_n >= 5 * n THEN top_n END AS form_n
  FROM vocabulary v LEFT JOIN best ON best.word = v.word),
climb(word, root, further) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT climb.word, f.word, f.form FROM climb JOIN formed f ON f.word = climb.further)
SELECT f.word, form, root, n, n_near, form_n
FROM formed f JOIN climb ON climb.word = f.word AND climb.further IS NULL
""",
    "op12_minhash_near_dedup": f"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[ \\t\\n\\x0B\\f\\r]+'),
    lambda w: w <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS s
  FROM word, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS t(i) WHERE len(w) > 0),
size AS (
  SELECT doc_id, count(s) AS n FROM word LEFT JOIN shingle USING (doc_id) GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS common
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT one, two FROM pair JOIN size x ON x.doc_id = one JOIN size y ON y.doc_id = two
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM size
  UNION
  SELECT reach.doc_id, link.two FROM reach JOIN link ON link.one = reach.other)
SELECT size.doc_id, n AS n_shingles, min(other) AS component_id, size.doc_id = min(other) AS kept
FROM size JOIN reach ON reach.doc_id = size.doc_id GROUP BY size.doc_id, n
""",
    "op13_conversation_prefix_trie": f"""
WITH turn AS (
  SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(said ORDER BY place) AS said, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h
  FROM turn GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.said, [])[:o.h], o.said[o.h + 1:]) AS said
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
node AS (
  SELECT d AS depth, said[:d] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(said) = d), '') AS ends
  FROM rebuilt, unnest(generate_series(0, len(said))) AS t(d) GROUP BY depth, path),
hung AS (
  SELECT n.*, p.conv_id AS parent_conv_id, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[-1][2]) END AS saved
  FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]),
child AS (
  SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM hung WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT hung.*, coalesce(n_children, 0) AS n_children FROM hung LEFT JOIN child USING (depth, conv_id)),
subtree AS (
  SELECT a.depth, a.path, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(b.saved) AS saved_tokens
  FROM counted a JOIN counted b ON b.depth >= a.depth AND b.path[:a.depth] = a.path GROUP BY a.depth, a.path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN subtree USING (depth, path)
""",
}
