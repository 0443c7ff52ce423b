"""DuckDB statements that give the rows of registered queries from the same tables by other means."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string, byte by byte and bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {bits}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _record(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_record("n_chars")} AS leaf,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_record("n_chars::HUGEINT + 1")} END AS given
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
),
nodes AS (
  SELECT lang, 0 AS level, i, n, leaf AS d FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n
),
subroots AS (
  SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
tops AS (
  SELECT 0 AS level, i, n, subroot AS d FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n
),
low AS (
  SELECT l.lang, l.i, a.level, coalesce(s.d, '') AS other, (l.i >> a.level) & 1 AS turn
  FROM leaves l JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) a ON l.lang IS NOT DISTINCT FROM a.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = a.level AND s.i = xor(l.i >> a.level, 1)
),
high AS (
  SELECT r.lang, a.level, coalesce(s.d, '') AS other, (r.i >> a.level) & 1 AS turn
  FROM subroots r CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) a
  LEFT JOIN tops s ON s.level = a.level AND s.i = xor(r.i >> a.level, 1)
),
lows AS (SELECT lang, i, list(turn || other ORDER BY level) AS way FROM low GROUP BY lang, i),
highs AS (SELECT lang, list(turn || other ORDER BY level) AS way FROM high GROUP BY lang),
ways AS (
  SELECT l.doc_id, l.leaf, l.given, r.subroot, coalesce(a.way, []) || coalesce(b.way, []) AS way
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN lows a ON a.lang IS NOT DISTINCT FROM l.lang AND a.i = l.i
  LEFT JOIN highs b ON b.lang IS NOT DISTINCT FROM l.lang
),
folded AS (
  SELECT *, list_reduce([coalesce(given, leaf)] || way, lambda d, w:
           sha256(CASE WHEN w[1] = '1' THEN w[2:] || d ELSE d || w[2:] END)) AS folded_root,
         sha256(array_to_string(list_transform(way, lambda w: w[2:]), '')) AS proof_sha256
  FROM ways
)
SELECT doc_id, leaf, subroot, t.d AS root, proof_sha256, folded_root, folded_root = t.d AS verified
FROM folded CROSS JOIN (SELECT d FROM tops WHERE n = 1) t
"""

_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
]
_LUHN = """list_sum(list_transform(string_split(reverse(digits), ''), lambda c, k:
  CASE WHEN k % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END)) % 10 = 0"""
_MOD_97 = """list_reduce([0] || list_transform(string_split(array_to_string(list_transform(
  string_split(code[5:] || code[:4], ''), lambda c: CASE WHEN ascii(c) < 58 THEN c ELSE (ascii(c) - 55)::VARCHAR END), ''), ''),
  lambda c: c::INT), lambda a, d: (a * 10 + d) % 97) = 1"""

PERSONAL_DATA = f"""
WITH kinds(rank, kind) AS (VALUES {", ".join(f"({i}, '{k}')" for i, (k, _) in enumerate(_KINDS))}),
cut AS (
  SELECT doc_id, kind, rank, txt, CASE kind {" ".join(f"WHEN '{k}' THEN regexp_extract_all(txt, '{p}')" for k, p in _KINDS)} END AS m,
         CASE kind {" ".join(f"WHEN '{k}' THEN string_split_regex(txt, '{p}')" for k, p in _KINDS)} END AS g
  FROM (SELECT doc_id, coalesce(text, '') AS txt FROM documents) CROSS JOIN kinds
),
placed AS (
  SELECT doc_id, kind, rank, txt, unnest(m) AS span, unnest(range(1, len(m) + 1)) AS k, m, g FROM cut WHERE len(m) > 0
),
spans AS (
  SELECT doc_id, kind, rank, span, txt, regexp_replace(span, '[^0-9]', '', 'g') AS digits, replace(span, ' ', '') AS code,
         list_sum(list_transform(g[1:k], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: len(x))), 0) AS a,
         lower(right(g[k], 48) || ' ' || left(g[k + 1], 24)) AS around
  FROM placed
),
found AS (
  SELECT doc_id, kind, rank, a::BIGINT AS a, (a + len(span))::BIGINT AS b
  FROM spans WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(span, '.'), lambda x: len(ltrim(x, '0')) > 3 OR ('0' || right(x, 3))::INT > 255)) = 0
    WHEN 'card' THEN len(digits) BETWEEN 16 AND 19 AND {_LUHN}
    WHEN 'phone' THEN len(digits) BETWEEN 8 AND 15
    WHEN 'iban' THEN {_MOD_97}
    ELSE span[1] <> '9' AND span[1:3] NOT IN ('000', '666') AND span[5:6] <> '00' AND span[8:] <> '0000'
         AND regexp_matches(around, '(^|[^\\pL])(ssn|social|security|insurance|tax)')
         AND NOT regexp_matches(around, '(^|[^\\pL])(version|isbn|order|invoice|serial|bestell|commande|pedido)')
  END
),
listed AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, _ in _KINDS[:4])},
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY rank, a) AS spans,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY rank, a) FILTER (rank < 4) AS base
  FROM found GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k, _ in _KINDS[:4])},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

# states: 0 nothing kept yet, 1 system, 2 user, 3 assistant
CONVERSATIONS = rf"""
WITH RECURSIVE inserted(state, middle, cost, edits, more) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
         (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
         (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']),
         (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])
),
become(middle, state, role) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS harm
  FROM conversations
),
harmed AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE harm WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM filled WHERE harm <> 0
),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role)::VARCHAR || ':' || role || text), copy) AS k
  FROM harmed
),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
         coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed
),
ids AS (SELECT DISTINCT conv_id FROM conversations),
ways AS (
  SELECT conv_id, 0::BIGINT AS k, 0 AS state, {{'cost': 0, 'audit': '', 'left': []::VARCHAR[]}} AS best FROM ids
  UNION ALL
  SELECT conv_id, k, state, min(best) FROM (
    SELECT r.conv_id, r.k, i.middle AS state,
           {{'cost': w.best.cost + i.cost + 2, 'audit': w.best.audit || i.edits || 'D', 'left': w.best.left || i.more}} AS best
    FROM ways w JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.k = w.k + 1
    JOIN inserted i ON i.state = w.state
    UNION ALL
    SELECT r.conv_id, r.k, b.state,
           {{'cost': w.best.cost + i.cost + CASE WHEN b.role = r.role[1] THEN 0 ELSE 1 END + CASE r.fault WHEN 3 THEN 5 ELSE 0 END,
             'audit': w.best.audit || i.edits || CASE WHEN b.role = r.role[1] THEN 'K' ELSE 'R' END,
             'left': w.best.left || i.more
               || [CASE WHEN b.role = r.role[1] THEN r.role WHEN b.role = 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text]}}
    FROM ways w JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.k = w.k + 1
    JOIN inserted i ON i.state = w.state JOIN become b ON b.middle = i.middle
    WHERE r.fault IN (0, 3) AND (b.role <> 's' OR r.role[1] = 's')
  ) GROUP BY conv_id, k, state
),
counted AS (
  SELECT conv_id, max(k) AS k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faulty GROUP BY conv_id
),
ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.edits, 'left': w.best.left || i.more}}) AS best
  FROM ways w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.k = w.k
  JOIN inserted i ON i.state = w.state AND i.middle IN (0, 3)
  GROUP BY w.conv_id
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.left, chr(10)), '')) AS repaired_sha256
FROM ids d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""

# all pairs of documents with a shingle in common, and everything that a document reaches
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS place FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[place : place + 4], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, w.b FROM reached r JOIN ways w ON w.a = r.other
)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.other) AS component_id, min(r.other) = d.doc_id AS kept
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id
"""

# bytes are pairs of hexadecimal digits; every string of 100 bytes is looked at
REPEATED_BYTES = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
-- cut first, since finding a place in a string takes as long as it is far in it
bases AS (SELECT doc_id, h, n, unnest(range(0, n - 99, 400)) AS base FROM bytes WHERE n >= 100),
blocks AS (SELECT doc_id, base, least(400, n - 99 - base) AS many, substring(h, 2 * base + 1, 1000) AS block FROM bases),
starts AS (SELECT doc_id, base, block, unnest(range(0, many)) AS i FROM blocks),
strings AS (SELECT doc_id, base + i AS i, md5_number(substring(block, 2 * i + 1, 200)) AS string FROM starts),
covering AS (
  SELECT doc_id, i FROM strings
  QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, i) > 1
),
heads AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true)::INT AS head FROM covering
),
numbered AS (
  SELECT doc_id, i, sum(head) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM heads
),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
-- what is left before each run, and after the last one
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL
  SELECT doc_id, coalesce(max(b), 0), any_value(n) FROM bytes LEFT JOIN runs USING (doc_id) GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
),
totals AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM bytes JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""
