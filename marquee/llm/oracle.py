"""DuckDB SQL of the operators that SQL can express, from their contracts alone."""

from __future__ import annotations

BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# CRC-32 (reflected polynomial 0xEDB88320) of a list of bytes, by a table of 256 entries.
CRC_TABLE = """
crc AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8), lambda c, x:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab)"""


def crc(data: str) -> str:
    return (f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)")


def utf8(text: str) -> str:
    """Bytes of a text of code points below 0x800."""
    return (f"flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] "
            f"ELSE [(192 + ord(x) // 64)::BIGINT, (128 + ord(x) % 64)::BIGINT] END))")


LINES = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.doc_id, k.line, k.pos, coalesce(o.owner <> k.doc_id, FALSE) AS gone FROM k LEFT JOIN o ON o.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

SPELLING = "WITH RECURSIVE " + CRC_TABLE.strip() + f""",
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run
         FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
h AS (SELECT run, n, {crc(utf8("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS h FROM c CROSS JOIN crc),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                    ELSE run END AS word, n FROM h)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, k, left(word, k::INT) || substr(word, k::INT + 2) AS rest
         FROM (SELECT word, n, unnest(range(0, length(word))) AS k FROM w)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM less a JOIN less b ON a.rest = b.rest AND a.k = b.k WHERE a.word <> b.word
  UNION SELECT a.word, w.word FROM less a JOIN w ON w.word = a.rest
  UNION SELECT w.word, a.word FROM less a JOIN w ON w.word = a.rest),
near AS (SELECT p.x AS word, w.word AS best, w.n AS best_n, count(*) OVER (PARTITION BY p.x) AS n_near,
                row_number() OVER (PARTITION BY p.x ORDER BY w.n DESC, w.word) AS k FROM pairs p JOIN w ON w.word = p.y),
f AS (SELECT w.word, CASE WHEN near.best_n >= 2 * w.n THEN near.best END AS form, w.n, coalesce(near.n_near, 0) AS n_near,
             CASE WHEN near.best_n >= 2 * w.n THEN near.best_n END AS form_n
      FROM w LEFT JOIN near ON near.word = w.word AND near.k = 1),
chase AS (SELECT word, word AS at FROM f
          UNION ALL SELECT chase.word, f.form FROM chase JOIN f ON f.word = chase.at WHERE f.form IS NOT NULL),
roots AS (SELECT chase.word, chase.at AS root FROM chase JOIN f ON f.word = chase.at WHERE f.form IS NULL)
SELECT f.word, f.form, roots.root, f.n, f.n_near, f.form_n FROM f JOIN roots ON roots.word = f.word"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
o AS (SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM o"""

#: Insertions before a row, or after the last: from one last initial to another.
_INSERTED = """
inserted(last, next, cost, audit, said) AS (VALUES
  ('', '', 0, '', NULL), ('', 'u', 3, 'I', 'user:'), ('', 'a', 6, 'II', 'user:' || chr(10) || 'assistant:'),
  ('s', 's', 0, '', NULL), ('s', 'u', 3, 'I', 'user:'), ('s', 'a', 6, 'II', 'user:' || chr(10) || 'assistant:'),
  ('u', 'u', 0, '', NULL), ('u', 'a', 3, 'I', 'assistant:'), ('a', 'a', 0, '', NULL), ('a', 'u', 3, 'I', 'user:')),
legal(last, next) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u'))"""

REPAIR = "WITH RECURSIVE " + CRC_TABLE.strip() + "," + _INSERTED + f""",
t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc(utf8("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"))} % 20 AS kind
      FROM conversations CROSS JOIN crc),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM t WHERE kind <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
             left(role, 1) AS initial, rtrim(text, {BLANKS}) AS bare FROM d),
s AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
                     WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM r),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
             count(*) FILTER (WHERE fault = 't') AS truncated,
             count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM s GROUP BY conv_id),
parse AS (
  SELECT conv_id, 0::BIGINT AS k, '' AS last, 0::BIGINT AS cost, '' AS audit, NULL::VARCHAR AS said FROM n
  UNION ALL
  SELECT conv_id, k, last, cost, audit, said FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, k, last ORDER BY cost, audit) AS best FROM (
      SELECT p.conv_id, s.k, e.next AS last, p.cost + i.cost + e.cost + CASE WHEN s.fault = 't' AND e.edit <> 'D' THEN 3 ELSE 0 END AS cost,
             p.audit || i.audit || e.edit AS audit,
             nullif(concat_ws(chr(10), p.said, i.said,
                              CASE e.edit WHEN 'K' THEN s.role || ':' || s.text
                                          WHEN 'R' THEN CASE e.next WHEN 'u' THEN 'user:' ELSE 'assistant:' END || s.text END), '') AS said
      FROM parse p JOIN s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.k = p.k + 1
      JOIN inserted i ON i.last = p.last
      JOIN (SELECT last, next, 0 AS cost, 'K' AS edit FROM legal UNION ALL SELECT last, next, 3, 'R' FROM legal WHERE next <> 's'
            UNION ALL SELECT x, x, 4, 'D' FROM (VALUES (''), ('s'), ('u'), ('a')) AS v(x)) e
        ON e.last = i.next AND (e.edit = 'D' OR s.fault NOT IN ('b', 'd') AND (e.edit = 'R' OR e.next = s.initial))) q0) q1 WHERE best = 1),
ends AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM (
    SELECT p.conv_id, p.cost + i.cost AS cost, p.audit || i.audit AS audit, nullif(concat_ws(chr(10), p.said, i.said), '') AS said
    FROM parse p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.k
    JOIN inserted i ON i.last = p.last WHERE i.next IN ('', 'a')))
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
       coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(e.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.best = 1"""

#: Components of ``nodes(id)`` by ``links(a, b)`` (both directions): each node's smallest reachable id.
COMPONENTS = """
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""

EMBEDDINGS = """
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT id, len(v) AS dim, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM v),
links AS (SELECT x.id AS a, y.id AS b FROM u x JOIN u y ON x.dim = y.dim AND x.id <> y.id WHERE list_inner_product(x.u, y.u) >= 0.95),""" + COMPONENTS + """
SELECT n.id AS vec_id, (SELECT count(*) FROM links WHERE links.a = n.id) AS n_links, l.component AS component_id,
       n.id = l.component AS kept FROM nodes n JOIN least l ON l.id = n.id"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, k, w[k] AS a, w[k + 1] AS b, w[k + 2] AS c FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS k FROM d)),
m AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
        SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM m WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts
      FROM d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 10 * n_symbols <= n_words AND 5 * n_shouts <= n_words
         AND 10 * n_dup_lines <= 3 * n_lines AND word_chars BETWEEN 2 * n_words AND 20 * n_words AS kept
FROM f"""

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*(?:/?s>|/?(?:ROLE|INST)\]|TURN\]))', '\1\\\2', 'g')"

CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t),
b AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY k) <> role, TRUE) AS first FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_ESCAPED.format('text')}) + CASE WHEN first THEN length('<s>[ROLE][/ROLE]</s>') + length({_ESCAPED.format('role')})
                ELSE length('[TURN]') END) AS BIGINT) AS formatted_chars
FROM b GROUP BY conv_id"""

NEAR_DOCUMENTS = rf"""
WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, k, k + 3) AS g FROM (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 80 * (x.n + y.n - met)),""" + COMPONENTS + """
SELECT nodes.id AS doc_id, coalesce(n.n, 0) AS n_shingles, least.component AS component_id, nodes.id = least.component AS kept
FROM nodes JOIN least ON least.id = nodes.id LEFT JOIN n ON n.doc_id = nodes.id"""

SQL = {"op2_embeddings": EMBEDDINGS, "op3_quality": QUALITY, "op4_chat": CHAT, "op5_line_dedup": LINES,
       "op7_minhash": NEAR_DOCUMENTS, "op11_spelling": SPELLING, "op12_warc": WARC, "op13_repair": REPAIR}
