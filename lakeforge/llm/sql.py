"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from .queries import URL_RULES

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


URLS = rf"""
WITH rules(rh, rp, rv) AS (VALUES {_RULES}),
parsed AS (
  SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS sep FROM pages),
split AS (
  SELECT page_id, CASE WHEN sep = 0 THEN '' ELSE substr(u, sep + 3) END AS rest FROM parsed),
hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM split),
parts AS (
  SELECT row_number() OVER () AS row, page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts)
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rh || rp, length(rh || rp)) AS rule,
       coalesce(arg_max(rv, length(rh || rp)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
GROUP BY row, page_id
"""

# Words with their place; texts without a word have no row.
_PLACED = r"""
placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents))"""

QUALITY = rf"""
WITH {_PLACED},
windows AS (
  SELECT doc_id, i, word || chr(32) || lead(word) OVER d || chr(32) || lead(word, 2) OVER d AS g FROM placed
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows WHERE g IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM counted CROSS JOIN (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY doc_id),
words AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars,
         count(*) FILTER (NOT regexp_matches(word, '\p{{L}}')) AS plain FROM placed GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(plain, 0) AS plain
  FROM documents d LEFT JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words
            OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)
            OR NOT word_chars BETWEEN 2 * n_words AND 20 * n_words OR 10 * plain > 4 * n_words) AS kept
FROM m
"""

DECONTAMINATION = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
folded AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM texts),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM folded WHERE kind = 'b' AND len(w) > 0),
grams AS (
  SELECT DISTINCT kind, id, g FROM (
    SELECT kind, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], chr(32)))) AS g
    FROM folded JOIN lengths ON kind = 'd' OR k = least(len(w), 5))),
sizes AS (SELECT id, count(*) AS n FROM grams WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_shared
FROM grams b JOIN grams d ON b.g = d.g AND b.kind = 'b' AND d.kind = 'd' JOIN sizes s ON s.id = b.id
GROUP BY d.id, b.id HAVING 10 * count(*) >= 8 * any_value(n)
"""


def _levels(length: int, count: int) -> str:
    """Windows of `length` words and their doublings; `again` has those that
    also start in another document."""
    key = " || chr(32) || ".join(["word"] + [f"lead(word, {k}) OVER d" for k in range(1, length)])
    steps = [f"level0 AS (SELECT doc_id, i, md5({key}) AS k FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i))"]
    for n in range(count):
        steps.append(f"""again{n} AS (
  SELECT doc_id, i, k, {length << n} AS n FROM level{n} JOIN (
    SELECT k FROM level{n} WHERE k IS NOT NULL GROUP BY k HAVING min(doc_id) < max(doc_id)) USING (k))""")
        if n + 1 < count:
            steps.append(f"""level{n + 1} AS (
  SELECT a.doc_id, a.i, md5(a.k || b.k) AS k FROM again{n} a JOIN again{n} b ON a.doc_id = b.doc_id AND b.i = a.i + {length << n})""")
    return ",\n".join(steps)


SUBSTRINGS = rf"""
WITH {_PLACED},
{_levels(13, 12)},
first AS (SELECT k, min(doc_id) AS least FROM level0 WHERE k IS NOT NULL GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, i + step AS i
  FROM (SELECT doc_id, i FROM level0 JOIN first USING (k) WHERE doc_id > least) CROSS JOIN range(13) AS r(step)),
kept AS (
  SELECT p.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
         coalesce(string_agg(word, chr(32) ORDER BY p.i) FILTER (g.i IS NULL), '') AS text
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id),
longest AS (SELECT doc_id, max(n) AS n FROM ({" UNION ALL ".join(f"SELECT doc_id, n FROM again{n}" for n in range(12))}) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256, coalesce(n, 0)::BIGINT AS longest_repeat
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS ln
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
trimmed AS (
  SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t FROM lines),
full_lines AS (
  SELECT doc_id, ln, t, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS i FROM trimmed WHERE t <> ''),
gone AS (
  SELECT doc_id, ln FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS copy FROM full_lines) WHERE copy > 1)
SELECT l.doc_id, count(*) FILTER (l.t <> '') AS n_lines, count(g.ln) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.ln) FILTER (g.ln IS NULL), '')) AS kept_sha256
FROM trimmed l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.ln = g.ln GROUP BY l.doc_id
"""

# CRC-32 bit by bit: a byte is xored in, each -1 shifts once.
_CRC32 = """
xor(4294967295, list_reduce(flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END, 4294967295::BIGINT))
"""

TRIE = rf"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS head FROM own GROUP BY conv_id),
convs AS (SELECT s.*, least(s.head, coalesce(b.n, 0)) AS taken FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base),
turns AS (
  SELECT c.conv_id, place AS depth, digest, chars FROM convs c JOIN own o ON o.conv_id = c.base WHERE place <= taken
  UNION ALL
  SELECT conv_id, taken + place - head, digest, chars FROM convs JOIN own USING (conv_id) WHERE place > head),
paths AS (
  SELECT conv_id, depth, chars, md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) || '/' || depth AS node FROM turns
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n, any_value(chars) AS chars FROM paths GROUP BY node),
linked AS (
  SELECT n.*, p.node AS parent, m.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN nodes m ON m.node = p.node),
children AS (SELECT parent AS node, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
totals AS (
  SELECT p.node, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((x.n - 1) * x.chars) AS saved_tokens
  FROM nodes x JOIN paths p ON p.conv_id = x.conv_id AND p.depth <= x.depth LEFT JOIN children c ON c.node = x.node GROUP BY p.node),
ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(node, depth) AS node FROM paths GROUP BY conv_id) GROUP BY node)
SELECT l.conv_id, l.depth, parent_conv_id, l.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM linked l JOIN totals t USING (node) LEFT JOIN children c USING (node) LEFT JOIN ends e USING (node)
"""

ORACLE_SQL = {"op1_substring_dedup": SUBSTRINGS, "op2_url_filter": URLS, "op5_quality_rules": QUALITY,
              "op7_line_dedup": LINES, "op8_decontamination": DECONTAMINATION,
              "op12_conversation_trie": TRIE}
