"""Reference SQL (DuckDB) for the queries of this subpackage that SQL can express."""

from __future__ import annotations

MARKS = ["[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>"]


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for m in MARKS:
        out = f"replace({out}, '{m}', '{m[0]}\\{m[1:]}')"
    return out


OP3 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), written AS (
  SELECT *, row_number() OVER same - 1 AS place,
    coalesce(lag(role) OVER same, '') || '>' || role NOT IN
      ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS wrong, length({_escaped("text")}) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13
    WHEN 'assistant' THEN 7 ELSE 26 + length({_escaped("role")}) END AS chars FROM turns
  WINDOW same AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, min(place) FILTER (wrong) AS first_wrong, NOT bool_or(wrong) AS valid, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

_ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _spans(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    whole = f"'(?s)(.*?)({pattern})'"
    return f"""
  SELECT doc_id, {place} AS place, '{kind}' AS kind,
    list_sum(list_transform(list_slice(gaps, 1, i), lambda x: length(x)))
      + coalesce(list_sum(list_transform(list_slice(hits, 1, i - 1), lambda x: length(x))), 0) AS start,
    length(hits[i]) AS size
  FROM (SELECT doc_id, gaps, hits, sizes, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, {whole}, 1) AS gaps,
      regexp_extract_all(text, {whole}, 2) AS hits, regexp_extract_all(text, {whole}, {group}) AS sizes
    FROM texts))
  WHERE length(sizes[i]) >= {least}"""


OP7 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({_spans("assign", 0, _ASSIGN, 4, 12)}
  UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", 2, 18)}
  UNION ALL {_spans("hex", 2, "[0-9a-f]+", 2, 16)}),
listed AS (
  SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
    count(*) FILTER (place = 2) AS n_hex,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ','
      ORDER BY start, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

_STRENGTH = """
  SELECT coalesce(mean, 0.5) AS mean, CASE WHEN room > 0 THEN
    greatest(1.0, least(10000.0, CASE WHEN spread > 0 THEN room / spread - 1 ELSE 10000.0 END))
    ELSE 10.0 END AS strength
  FROM (SELECT mean, b2 - n * mean * mean - mean * (1 - mean) * (g - 1) AS spread,
      mean * (1 - mean) * (n - n2 / n - (g - 1)) AS room
    FROM (SELECT sum(bad)::DOUBLE / sum(n) AS mean, sum(n)::DOUBLE AS n, sum(n::DOUBLE * n) AS n2,
        sum(bad::DOUBLE * bad / n) AS b2, count(*) AS g
      FROM {0} WHERE n > 0))"""

OP9 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages
), urls AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), outcomes AS (
  SELECT doc_id AS page_id, count(quality) AS n, sum(1 - quality) AS bad FROM labels
  WHERE quality IS NOT NULL GROUP BY doc_id
), hosts AS (
  SELECT host, string_split(host, '.') AS parts, coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad
  FROM urls LEFT JOIN outcomes USING (page_id) GROUP BY host
), tails AS (
  SELECT *, array_to_string(parts[-2:], '.') AS two, array_to_string(parts[-3:], '.') AS three,
    array_to_string(parts[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br',
      'co.nz', 'co.in') AS long FROM hosts
), levels AS (
  SELECT host, n, bad, CASE WHEN long THEN two ELSE parts[-1] END AS suffix,
    CASE WHEN long THEN three ELSE two END AS domain FROM tails
), domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM levels GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM levels GROUP BY ALL),
s1 AS ({_STRENGTH.format("suffixes")}), s2 AS ({_STRENGTH.format("domains")}),
s3 AS ({_STRENGTH.format("levels")}),
above AS (
  SELECT d.suffix, d.domain, d.n, d.bad,
    (s.bad - d.bad + mean * strength) / (s.n - d.n + strength) AS rate
  FROM domains d JOIN suffixes s ON d.suffix = s.suffix, s1
), by_domain AS (
  SELECT h.host, h.n, h.bad, (a.bad - h.bad + rate * strength) / (a.n - h.n + strength) AS rate
  FROM levels h JOIN above a ON h.suffix = a.suffix AND h.domain = a.domain, s2
), of_host AS (
  SELECT host, n, strength, (bad + rate * strength) / (n + strength) AS rate FROM by_domain, s3
), bounds AS (
  SELECT host, rate, rate - 1.645 * sqrt(rate * (1 - rate) / (n + strength + 1)) AS lower FROM of_host
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
      THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule FROM urls
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN lower > 0.3 THEN 'block' ELSE 'allow' END AS verdict,
  round(rate, 9) AS bad_rate, round(lower, 9) AS lower
FROM ruled LEFT JOIN bounds USING (host)
"""

OP10 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
    list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (h)
  WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS least FROM documents
  UNION SELECT y, least FROM reach JOIN links ON x = node WHERE least < y
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT node AS doc_id, min(least) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

# CRC-32 by bits: a byte is folded in (b >= 0), then eight shifts follow (b < 0).
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda x, b: CASE WHEN b >= 0 THEN xor(x, b) ELSE xor(x >> 1, (x & 1) * 3988292384) END), 4294967295::BIGINT)"""

# States: 0 nothing yet, 1 system, 2 user, 3 assistant. Row by row, the least cost and audit of each state.
OP11 = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS way
  FROM conversations
), after AS (
  SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
    CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given, unnest(range(CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail
  FROM after
), copies AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy FROM placed
), faulty AS (
  SELECT *, CASE WHEN tail = '' THEN 1 WHEN copy > 1 THEN 2 WHEN tail NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM copies
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) AS n, count(*) FILTER (before IS NOT NULL
      AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), moves(p, q, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')
), edits AS (
  SELECT conv_id, i, p, p AS q, 2 AS cost, 'D' AS letter FROM faulty, (VALUES (0), (1), (2), (3)) s(p)
  UNION ALL SELECT conv_id, i, p, q, CASE fault WHEN 3 THEN 5 ELSE 0 END, 'K' FROM faulty, moves
    WHERE left(role, 1) = initial AND fault IN (0, 3)
  UNION ALL SELECT conv_id, i, p, q, CASE fault WHEN 3 THEN 6 ELSE 1 END, 'R' FROM faulty, moves
    WHERE initial <> 's' AND fault IN (0, 3)
), inserted(p, q, cost, letter) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'),
  (1, 2, 5, 'I'), (3, 2, 5, 'I'), (2, 3, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II'), (2, 2, 10, 'II'), (3, 3, 10, 'II')
), steps AS (
  SELECT conv_id, e.i, a.p, e.q, min({{'cost': a.cost + e.cost, 'audit': a.letter || e.letter}}) AS step
  FROM edits e JOIN inserted a ON a.q = e.p GROUP BY ALL
), best AS (
  SELECT conv_id, 0 AS i, 0 AS q, {{'cost': 0, 'audit': ''}} AS found FROM counts
  UNION ALL
  SELECT b.conv_id, s.i, s.q, min({{'cost': b.found.cost + s.step.cost, 'audit': b.found.audit || s.step.audit}})
  FROM best b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.p = b.q
  GROUP BY b.conv_id, s.i, s.q
), ended AS (
  SELECT b.conv_id, min({{'cost': b.found.cost + a.cost, 'audit': b.found.audit || a.letter}}) AS found
  FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i
    JOIN inserted a ON a.p = b.q AND a.q IN (0, 3)
  GROUP BY b.conv_id
), letters AS (
  SELECT conv_id, place, string_split(found.audit, '')[place] AS letter,
    place - length(replace(left(found.audit, place), 'I', '')) AS skipped,
    length(replace(left(found.audit, place), 'D', '')) AS written
  FROM (SELECT *, unnest(range(1, length(found.audit) + 1)) AS place FROM ended)
), lines AS (
  SELECT l.*, f.role AS own, coalesce(f.text, '') AS text, max(CASE WHEN written = 1 AND letter = 'K'
    AND left(f.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS system
  FROM letters l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id
    AND f.i = place - skipped AND letter <> 'I'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN own WHEN (written - system) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS whole
  FROM lines WHERE letter <> 'D' GROUP BY conv_id
)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(found.cost, 0)::BIGINT AS cost,
  coalesce(found.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
  LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id
  LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM g.conv_id
"""


def _nearest(centroids: str) -> str:
    return f"""
  SELECT vec_id, v, min({{'d': list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT,
    'c': c}}) AS near
  FROM kept, {centroids} GROUP BY vec_id, v"""


def _means(assigned: str, centroids: str) -> str:
    return f"""
  SELECT c, coalesce(m, w) AS w FROM {centroids} LEFT JOIN (
    SELECT c, list((s - (s % n + n) % n) // n ORDER BY k) AS m FROM (
      SELECT near.c AS c, k, sum(x)::BIGINT AS s, count(*) AS n
      FROM (SELECT near, unnest(v) AS x, unnest(range(64)) AS k FROM {assigned}) GROUP BY ALL)
    GROUP BY c) USING (c)"""


OP13 = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v AS w FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16
), a0 AS ({_nearest("c0")}), c1 AS ({_means("a0", "c0")}),
a1 AS ({_nearest("c1")}), c2 AS ({_means("a1", "c1")}),
a2 AS ({_nearest("c2")}), c3 AS ({_means("a2", "c2")}),
a3 AS ({_nearest("c3")})
SELECT vec_id, near.c::INTEGER AS cluster, near.d AS distance,
  sum(near.d) OVER (PARTITION BY near.c)::BIGINT AS cluster_inertia, sum(near.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.c = near.c
"""

ORACLE = {
    "op3_chat": OP3,
    "op7_secrets": OP7,
    "op9_url_reputation": OP9,
    "op10_jaccard_join": OP10,
    "op11_conversation_repair": OP11,
    "op13_bit_plane_clusters": OP13,
}
