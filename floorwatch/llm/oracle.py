"""The same results in DuckDB SQL, for the operators that SQL can express."""

#: Ends of words of prose, and symbols, as in the quality rules.
_ODD_END = r"""[^\x20\x09-\x0D\p{L}\p{N}.,;:''")\]…-](?:[\x20\x09-\x0D]|$)"""

_PHRASES = "|".join(
    (
        "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
        "enable javascript", "lorem ipsum", "click here", "sign up for", "subscribe to our", "powered by",
        "skip to content", "log in to", "follow us on",
    )
)

_QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, u.w AS w, u.i AS i
  FROM d, LATERAL (SELECT unnest(ws) AS w, generate_subscripts(ws, 1) AS i
                   FROM (SELECT regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws)) u
), tri AS (
  SELECT r, i, w || ' ' || lead(w) OVER s || ' ' || lead(w, 2) OVER s AS g FROM w WINDOW s AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri WHERE g IS NOT NULL) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), l AS (
  SELECT r, unnest(string_split(t, chr(10))) AS x FROM d
), m AS (
  SELECT r, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
    len(regexp_extract_all(x, '{_ODD_END}')) AS odd, len(regexp_extract_all(x, '!(?:[\x20\x09-\x0D]|$)')) AS shouts,
    len(regexp_extract_all(x, '[|»›]')) AS bars, len(regexp_extract_all(x, 'https?://')) AS links,
    len(regexp_extract_all(x, '[#*$%&|<>]')) AS symbols, regexp_matches(lower(x), '{_PHRASES}') AS furniture
  FROM l
), f AS (
  SELECT *, furniture OR (n > 0 AND (odd * 10 >= n * 4 OR shouts * 2 >= n OR symbols * 100 > length(x) * 8
         OR (bars >= 2 AND bars * 10 >= n) OR links > 2)) AS fails FROM m
), q AS (
  SELECT r, count(*) FILTER (n > 0) - count(DISTINCT x) FILTER (n > 0) AS n_dup_lines,
    sum(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (fails) AS lost
  FROM f GROUP BY r
), b AS (
  SELECT r, doc_id, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols
  FROM d
), j AS (
  SELECT b.*, q.n_dup_lines, coalesce(rep.n_repeat_words, 0) AS n_repeat_words, coalesce(q.lost, 0) AS lost
  FROM b JOIN q USING (r) LEFT JOIN rep USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT lost * 100 > word_chars * 30 AS kept
FROM j
"""

#: crc32 of a decimal number, bit by bit; ids of conversations are few here.
_CRC = """xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda crc, byte:
  list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(crc, byte)),
  4294967295), 4294967295)"""

_TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role) AS turns FROM t GROUP BY c
), h AS (
  SELECT c, turns, {_CRC} % 9 AS h FROM o
), r AS (
  SELECT a.c AS c, list_concat(coalesce(b.turns[:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM h a LEFT JOIN h b ON b.c = a.c - a.c % 5
), m AS (
  SELECT c, d, turns[:d] AS path, len(turns) = d AS ends
  FROM (SELECT c, turns, unnest(generate_series(0, len(turns))) AS d FROM r)
), n AS (
  SELECT path, d, min(c) AS c, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ends,
    (count(*) - 1) * strlen(coalesce(path[d].text, '')) AS saved
  FROM m GROUP BY path, d
), k AS (
  SELECT p.path, count(x.path) AS children FROM n p LEFT JOIN n x ON x.d = p.d + 1 AND x.path[:p.d] = p.path GROUP BY p.path
), s AS (
  SELECT p.path, sum(x.saved) AS saved, count(*) FILTER (k.children = 0) AS leaves
  FROM n p JOIN n x ON x.d >= p.d AND x.path[:p.d] = p.path JOIN k ON k.path = x.path GROUP BY p.path
)
SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.n AS n_convs, k.children AS n_children, s.leaves AS n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN k ON k.path = n.path JOIN s ON s.path = n.path LEFT JOIN n up ON up.d = n.d - 1 AND up.path = n.path[:n.d - 1]
"""

ORACLE = {
    "op10_quality_rules": _QUALITY,
    "op13_conversation_prefix_trie": _TRIE,
}
