"""DuckDB SQL for the queries that SQL can express.

The others are held to brute force, round trips or held-out accuracy in tests/llm.
"""

from __future__ import annotations

from tickwise.llm.queries import BAD_HOST_WORDS, SITE_RULES
from tickwise.llm.quality_rules import THRESHOLDS, _stop_list


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH words_of AS (
  SELECT 'd' AS kind, doc_id AS id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'b', item_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark),
items AS (
  SELECT id AS item, len(least_len) AS size, array_to_string(least_len, ' ') AS win FROM (
    SELECT id, w[i:least(i + 12, len(w))] AS least_len
    FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM words_of
          WHERE kind = 'b' AND len(w) > 0)) x),
sizes AS (SELECT DISTINCT size FROM items),
places AS (
  SELECT id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words_of, sizes
        WHERE kind = 'd' AND len(w) >= size) p),
hits AS (SELECT p.id, p.i, p.size, t.item FROM places p JOIN (SELECT DISTINCT item, win FROM items) t USING (win)),
covered AS (SELECT id, count(DISTINCT i + k) AS n_hit
            FROM (SELECT id, i, unnest(range(0, size)) AS k FROM hits) h GROUP BY id),
named AS (SELECT id, count(DISTINCT item) AS n_items,
                 sha256(array_to_string(list_sort(list_distinct(list(item::VARCHAR))), ',')) AS sha
          FROM hits GROUP BY id)
SELECT d.id AS doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM words_of d LEFT JOIN covered c ON c.id = d.id LEFT JOIN named n ON n.id = d.id
WHERE d.kind = 'd'
"""

_SITES = " UNION ALL ".join(
    f"SELECT {_text(s)} AS rule, {_text(s.partition('/')[0])} AS h, {_text('/' + s.partition('/')[2])} AS p, "
    f"{_text(v)} AS v" for s, v in SITE_RULES)

OP2 = rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rests),
rules AS ({_SITES}),
best AS (
  SELECT s.page_id, s.host, s.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.v, length(r.rule)) AS v
  FROM split s LEFT JOIN rules r
    ON (s.host = r.h OR ends_with(s.host, '.' || r.h)) AND starts_with(s.path, r.p)
  GROUP BY s.page_id, s.host, s.path)
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN regexp_matches(host, '(^|[^0-9A-Za-z%_])({"|".join(BAD_HOST_WORDS)})([^0-9A-Za-z%_]|$)')
                   THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""

OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length('<|turn|>') + length('<|text|>') + length('<|end|>') + length(role) + length(text)
    + (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '<|', ''))) // 2
    + (length(text) - length(replace(text, '</s>', ''))) // 4
    + (length(text) - length(replace(text, '<s>', ''))) // 3
    + (length(text) - length(replace(text, '[INST]', ''))) // 6
    + (length(text) - length(replace(text, '[/INST]', ''))) // 7
    + (length(text) - length(replace(text, '<<SYS>>', ''))) // 7
    + (length(text) - length(replace(text, '<</SYS>>', ''))) // 8 AS chars
  FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _holds() -> str:
    parts = []
    for t in THRESHOLDS:
        if t.lowest is not None:
            parts.append(f"{t.numerator} >= {t.lowest!r}::DOUBLE * {t.denominator}")
        if t.highest is not None:
            parts.append(f"{t.numerator} <= {t.highest!r}::DOUBLE * {t.denominator}")
    return " AND ".join(parts)


OP4 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8) x),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i, unnest(range(0, 8)) AS k
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) y WHERE c > 1) z
  GROUP BY r),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(w, lambda x: x IN ({", ".join(map(_text, _stop_list()))}))) AS n_stop_words
  FROM base LEFT JOIN repeated USING (r)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_holds()} AS kept
FROM failed
"""

OP5 = """
WITH bodies AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents),
places AS (
  SELECT r, i, md5(substr(body, 2 * i - 1, 800)) AS win
  FROM (SELECT r, body, unnest(range(1, length(body) // 2 - 398)) AS i FROM bodies WHERE length(body) >= 800) b),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY win) AS n FROM places) p WHERE n > 1),
runs AS (
  SELECT r, min(i) AS lo, max(i) + 399 AS hi FROM (
    SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS island FROM (
      SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh
      FROM repeated) f) g GROUP BY r, island),
gaps AS (
  SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) + 1 AS a, lo - 1 AS b FROM runs
  UNION ALL SELECT r, max(hi) + 1, NULL FROM runs GROUP BY r),
kept AS (
  SELECT r, string_agg(substr(body, 2 * a - 1, 2 * (coalesce(b, length(body) // 2) - a + 1)), '' ORDER BY a) AS body
  FROM gaps JOIN bodies USING (r) WHERE a <= coalesce(b, length(body) // 2) GROUP BY r),
sums AS (SELECT r, sum(hi - lo + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, (length(b.body) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN b.body ELSE coalesce(k.body, '') END)) AS kept_sha256
FROM bodies b LEFT JOIN sums USING (r) LEFT JOIN kept k USING (r)
"""

OP9 = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
pieces AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS piece
  FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0) x),
rows_of AS (SELECT r, md5(string_agg(piece, chr(10) ORDER BY piece)) AS s, count(*) AS n FROM pieces GROUP BY r),
sets AS (SELECT s, any_value(r) AS r, any_value(n) AS n, count(*) AS docs FROM rows_of GROUP BY s),
members AS (SELECT s, n, piece FROM sets JOIN pieces USING (r)),
links AS (
  SELECT a.s AS s, b.s AS t FROM members a JOIN members b ON a.piece = b.piece AND a.s <> b.s
  GROUP BY a.s, b.s HAVING 9 * count(*) >= 4 * (any_value(a.n) + any_value(b.n))),
reach AS (SELECT s, s AS t FROM sets UNION SELECT reach.s, links.t FROM reach JOIN links ON links.s = reach.t),
heads AS (SELECT reach.s, min(doc_id) AS class_id
          FROM reach JOIN rows_of ON rows_of.s = reach.t JOIN words USING (r) GROUP BY reach.s),
degree AS (SELECT s, count(*) AS n_links FROM links GROUP BY s)
SELECT doc_id, CASE WHEN o.s IS NULL THEN doc_id ELSE class_id END AS class_id,
       coalesce(n_links, 0)::BIGINT AS n_links, (coalesce(docs, 1) - 1)::BIGINT AS n_copies
FROM words LEFT JOIN rows_of o USING (r) LEFT JOIN sets ON sets.s = o.s LEFT JOIN heads ON heads.s = o.s
LEFT JOIN degree ON degree.s = o.s
"""

OP10 = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
places AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50) x),
repeated AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY win) AS least FROM places) p
  WHERE least < coalesce(doc_id, 9223372036854775807)),
runs AS (
  SELECT r, min(i) AS lo, max(i) + 49 AS hi FROM (
    SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS island FROM (
      SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh
      FROM repeated) f) g GROUP BY r, island),
gaps AS (
  SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) + 1 AS a, lo - 1 AS b FROM runs
  UNION ALL SELECT r, max(hi) + 1, NULL FROM runs GROUP BY r),
kept AS (
  SELECT r, string_agg(array_to_string(w[a:coalesce(b, len(w))], ' '), ' ' ORDER BY a) AS body
  FROM gaps JOIN words USING (r) WHERE a <= coalesce(b, len(w)) GROUP BY r),
sums AS (SELECT r, sum(hi - lo + 1) AS n_removed FROM runs GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n_removed IS NULL THEN array_to_string(w, ' ') ELSE coalesce(body, '') END) AS kept_sha256
FROM words LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
cut AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
totals AS (SELECT lang, count(*) AS n FROM spots GROUP BY ALL),
f1 AS (SELECT lang, w[i] AS a, count(*) AS f FROM spots GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM spots WHERE i + 1 <= len(w) GROUP BY ALL
       HAVING count(*) >= 10),
f3 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM spots WHERE i + 2 <= len(w)
       GROUP BY ALL HAVING count(*) >= 10),
two AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.a = f2.a JOIN f1 y ON y.lang = f2.lang AND y.a = f2.b
  WHERE 100 * greatest(
    coalesce((SELECT max(t.f) FROM f3 t WHERE t.lang = f2.lang AND t.a = f2.a AND t.b = f2.b), 0),
    coalesce((SELECT max(t.f) FROM f3 t WHERE t.lang = f2.lang AND t.b = f2.a AND t.c = f2.b), 0)) < 50 * f2.f),
three AS (
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.a = f3.a
  JOIN f2 y ON y.lang = f3.lang AND y.a = f3.b AND y.b = f3.c
  UNION ALL
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, x.f, y.f, 2
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.a = f3.a AND x.b = f3.b
  JOIN f1 y ON y.lang = f3.lang AND y.a = f3.c),
scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score
  FROM (SELECT * FROM two UNION ALL SELECT * FROM three)),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

# CRC-32 by its definition: eight shifts a byte, the reversed polynomial where a bit falls out
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT,
      list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::UBIGINT)),
    lambda crc, b: list_reduce(
      list_prepend(xor(crc, b), list_transform(range(8), lambda i: 0::UBIGINT)),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT + y))))"""

OP13 = f"""
WITH convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h,
         list(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')
              ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS v,
         list(strlen(coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
anew AS (
  SELECT c.conv_id, list_concat(coalesce(o.v, [])[1:c.h], c.v[c.h + 1:]) AS v,
         list_concat(coalesce(o.b, [])[1:c.h], c.b[c.h + 1:]) AS b
  FROM convs c LEFT JOIN convs o ON o.conv_id = c.base),
prefixes AS (
  SELECT conv_id, d, v[1:d] AS k, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS bytes, d = len(v) AS ends
  FROM (SELECT *, unnest(range(0, len(v) + 1)) AS d FROM anew)),
nodes AS (
  SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY k),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
weighed AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.k = nodes.k),
below AS (
  SELECT k[1:up] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM weighed) GROUP BY ALL)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs,
       w.n_children::BIGINT AS n_children, below.n_leaves::BIGINT AS n_leaves,
       below.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM weighed w JOIN below ON below.k = w.k LEFT JOIN nodes p ON w.depth > 0 AND p.k = w.k[1:w.depth - 1]
"""

ORACLE: dict[str, str] = {
    "op1_decontaminate": OP1, "op2_url_filter": OP2, "op3_chat_format": OP3, "op4_quality_rules": OP4,
    "op5_suffix_dedup": OP5, "op9_jaccard_join": OP9, "op10_phrase_dedup": OP10,
    "op12_collocations": OP12, "op13_prefix_trie": OP13}
