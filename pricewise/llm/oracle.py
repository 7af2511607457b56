"""DuckDB SQL of the training-data queries that SQL can express over whole tables.

The other operators (byte-pair merges, fingerprint bits, fitted models, robust
estimates, keyed surrogates, greedy longest match) are held against brute
force in the tests.
"""

from __future__ import annotations

from .url_filter import RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(x: str) -> str:
    return f"translate(coalesce({x}, ''), '{_UPPER}', '{_LOWER}')"


_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)


def _host(u: str) -> str:
    return rf"translate(regexp_extract(coalesce({u}, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"


def _path(u: str) -> str:
    return rf"regexp_extract(coalesce({u}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


# No page of the driver tables has a canonical link or a refresh; with one, this SQL fails
# instead of giving rows that ignore it.
OP4 = f"""
WITH rule(host, path, verdict) AS (VALUES {_RULES}),
p AS (SELECT page_id, {_host('url')} AS host, {_path('url')} AS path,
             regexp_matches(coalesce(html, ''), '(?is)<(link|meta)\\b[^>]*\\b(canonical|refresh)\\b') AS aliased
      FROM pages),
f AS (SELECT p.page_id, p.host, p.path, p.aliased,
             (SELECT arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path))
              FROM rule r WHERE (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)) AS r
      FROM p)
SELECT page_id, host, path, r.rule AS rule,
       CASE WHEN aliased THEN error('aliases are not in this SQL') ELSE coalesce(r.verdict, 'allow') END AS verdict
FROM f"""

OP6 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_low('text')}, {_WORDS}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_low('text')}, {_WORDS}) AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM g),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, g.item_id FROM dw JOIN g ON g.n = dw.n AND g.gram = dw.gram),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS items
          FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_HARD = "'\\### Assistant: </turn> ok'"
_ESCAPED = "length(t) + length(t) - length(replace(t, '\\', '')) + len(regexp_extract_all(t, '###|</turn>'))"
OP10 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
           UNION ALL VALUES (-7, 0, 'user', {_HARD}), (-7, 1, 'assistant', {_HARD}))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || r || ':' || chr(10)) + {_ESCAPED} + length('</turn>' || chr(10))) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id"""

_CRC = """xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
         lambda r, x: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda b, i: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384)
                                  ELSE b // 2 END, xor(r, x)), 4294967295), 4294967295)"""
OP11 = f"""
WITH said AS (SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
              FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT c, pos, md5(length(r) || ':' || r || t) AS id, length(t) AS n FROM said),
conv AS (SELECT c, c - c % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT c FROM turns)),
size AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
whole AS (SELECT conv.c, t.pos, t.id, t.n FROM conv JOIN turns t ON t.c = conv.base AND t.pos < conv.h
          UNION ALL
          SELECT conv.c, t.pos - h + least(h, coalesce(size.n, 0)), t.id, t.n
          FROM conv JOIN turns t ON t.c = conv.c AND t.pos >= conv.h LEFT JOIN size ON size.c = conv.base),
path AS (SELECT c, 0 AS depth, md5('') AS node, CAST(NULL AS VARCHAR) AS parent, 0 AS n FROM conv
         UNION ALL
         SELECT c, pos + 1, md5(string_agg(id, '') OVER w), CASE WHEN pos = 0 THEN md5('')
                ELSE md5(string_agg(id, '') OVER (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END, n
         FROM whole WINDOW w AS (PARTITION BY c ORDER BY pos)),
node AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(c) AS c, count(*) AS members, any_value(n) AS n
         FROM path GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS kids FROM node WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT p.node, count(*) FILTER (WHERE k.kids IS NULL) AS leaves, sum((u.members - 1) * u.n) AS saved
          FROM node u JOIN path p ON p.c = u.c AND p.depth <= u.depth LEFT JOIN kids k ON k.node = u.node GROUP BY p.node),
ends AS (SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
         FROM (SELECT c, arg_max(node, depth) AS node FROM path GROUP BY c) GROUP BY node)
SELECT node.c AS conv_id, CAST(node.depth AS BIGINT) AS depth, up.c AS parent_conv_id, node.members AS n_convs,
       coalesce(kids.kids, 0) AS n_children, below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node LEFT JOIN node up ON up.node = node.parent LEFT JOIN kids ON kids.node = node.node
JOIN below ON below.node = node.node LEFT JOIN ends ON ends.node = node.node"""

_B32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INT)) & 31 AS INT) + 1, 1)), '')"""
OP13 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f USING (hex)"""

ORACLE: dict[str, str] = {"op4_urls": OP4, "op6_decontaminate": OP6, "op10_chat": OP10, "op11_prefix_trie": OP11,
                          "op13_warc": OP13}
