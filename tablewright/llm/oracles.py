"""SQL with the results of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from .mixing import SQL as MIX_SOURCES

_WORDS = r"""
words AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
)"""

QUALITY_RULES = rf"""
WITH {_WORDS},
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS s FROM words WHERE len(ws) >= 8),
windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 7], ' ') AS w FROM starts),
twice AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT s + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
listed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS place FROM words),
again AS (
  SELECT doc_id, count(*) FILTER (word = before) AS n
  FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM listed) GROUP BY doc_id
),
counted AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) AS n_capitals, strlen(text) AS n_bytes,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(again.n, 0) AS n_again
  FROM words w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN again USING (doc_id)
),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.05 * n_bytes OR n_capitals > 0.40 * n_bytes OR n_again > 0.30 * n_words) AS kept
FROM base
"""

SUBSTRING_DEDUP = rf"""
WITH {_WORDS},
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM words WHERE len(ws) >= 35),
windows AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) AS w FROM starts),
twice AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS place FROM twice, (SELECT unnest(range(0, 35)) AS k)),
listed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM listed l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.place = l.place) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept USING (doc_id)
"""

_COMPONENTS = """
reach AS (
  SELECT id, id AS other FROM nodes
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
),
least AS (SELECT id, min(other) AS component FROM reach GROUP BY id)"""

JACCARD_JOIN = rf"""
WITH RECURSIVE {_WORDS.replace("coalesce(text, '') AS text", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text")},
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS s FROM words WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_have AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
),
nodes AS (SELECT doc_id AS id FROM documents),
links AS (
  SELECT a, b FROM both_have JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * o >= 80 * (s.n + t.n - o)
),
{_COMPONENTS}
SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component AS component_id
FROM least LEFT JOIN sizes ON doc_id = id
"""

NEAR_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (
  SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.id <> y.id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95
),
{_COMPONENTS},
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT least.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component AS component_id, least.id = component AS kept
FROM least LEFT JOIN counted ON counted.id = least.id
"""

REPAIR = r"""
WITH RECURSIVE bits AS (
  SELECT range AS i, range::BIGINT AS c, 0 AS step FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
),
dealt AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ord(k[i])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM given, crc
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM dealt, (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending, substr(role, 1, 1) AS c
  FROM damaged
),
faulty AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS c_before, max(i) OVER (PARTITION BY conv_id) AS n
  FROM placed
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (c_before IS NOT NULL AND c_before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
),
search AS (
  SELECT conv_id, n + 1 AS i, {'cost': 0, 'audit': '', 'lines': ''} AS b0, {'cost': 6, 'audit': 'II', 'lines': chr(10) || 'user:' || chr(10) || 'assistant:'} AS b1,
    {'cost': 3, 'audit': 'I', 'lines': chr(10) || 'assistant:'} AS b2, {'cost': 0, 'audit': '', 'lines': ''} AS b3
  FROM faulty WHERE i = 1
  UNION ALL
  SELECT conv_id, i, list_min([k0, i0, j0]), list_min([k1, i1, j1]), list_min([k2, i2, j2]), list_min([k3, i3, j3])
  FROM (
    SELECT conv_id, i, k0, k1, k2, k3,
      {'cost': k2.cost + 3, 'audit': 'I' || k2.audit, 'lines': chr(10) || 'user:' || k2.lines} AS i0,
      {'cost': k2.cost + 3, 'audit': 'I' || k2.audit, 'lines': chr(10) || 'user:' || k2.lines} AS i1,
      {'cost': k3.cost + 3, 'audit': 'I' || k3.audit, 'lines': chr(10) || 'assistant:' || k3.lines} AS i2,
      {'cost': k2.cost + 3, 'audit': 'I' || k2.audit, 'lines': chr(10) || 'user:' || k2.lines} AS i3,
      {'cost': k3.cost + 6, 'audit': 'II' || k3.audit, 'lines': chr(10) || 'user:' || chr(10) || 'assistant:' || k3.lines} AS j0,
      {'cost': k3.cost + 6, 'audit': 'II' || k3.audit, 'lines': chr(10) || 'user:' || chr(10) || 'assistant:' || k3.lines} AS j1,
      {'cost': k2.cost + 6, 'audit': 'II' || k2.audit, 'lines': chr(10) || 'assistant:' || chr(10) || 'user:' || k2.lines} AS j2,
      {'cost': k3.cost + 6, 'audit': 'II' || k3.audit, 'lines': chr(10) || 'user:' || chr(10) || 'assistant:' || k3.lines} AS j3
    FROM (
      SELECT conv_id, i,
        list_min([{'cost': b0.cost + 4, 'audit': 'D' || b0.audit, 'lines': b0.lines},
          {'cost': b2.cost + stay + 3, 'audit': 'R' || b2.audit, 'lines': chr(10) || 'user:' || text || b2.lines},
          {'cost': CASE c WHEN 's' THEN b1.cost WHEN 'u' THEN b2.cost ELSE 10**9 END::INT + stay, 'audit': 'K' || CASE c WHEN 's' THEN b1.audit ELSE b2.audit END,
           'lines': chr(10) || role || ':' || text || CASE c WHEN 's' THEN b1.lines ELSE b2.lines END}]) AS k0,
        list_min([{'cost': b1.cost + 4, 'audit': 'D' || b1.audit, 'lines': b1.lines},
          {'cost': b2.cost + stay + 3, 'audit': 'R' || b2.audit, 'lines': chr(10) || 'user:' || text || b2.lines},
          {'cost': CASE c WHEN 'u' THEN b2.cost ELSE 10**9 END::INT + stay, 'audit': 'K' || b2.audit, 'lines': chr(10) || role || ':' || text || b2.lines}]) AS k1,
        list_min([{'cost': b2.cost + 4, 'audit': 'D' || b2.audit, 'lines': b2.lines},
          {'cost': b3.cost + stay + 3, 'audit': 'R' || b3.audit, 'lines': chr(10) || 'assistant:' || text || b3.lines},
          {'cost': CASE c WHEN 'a' THEN b3.cost ELSE 10**9 END::INT + stay, 'audit': 'K' || b3.audit, 'lines': chr(10) || role || ':' || text || b3.lines}]) AS k2,
        list_min([{'cost': b3.cost + 4, 'audit': 'D' || b3.audit, 'lines': b3.lines},
          {'cost': b2.cost + stay + 3, 'audit': 'R' || b2.audit, 'lines': chr(10) || 'user:' || text || b2.lines},
          {'cost': CASE c WHEN 'u' THEN b2.cost ELSE 10**9 END::INT + stay, 'audit': 'K' || b2.audit, 'lines': chr(10) || role || ':' || text || b2.lines}]) AS k3
      FROM (
        SELECT s.*, f.i AS i_row, f.role, f.text, f.c,
          CASE WHEN fault IN ('blank', 'duplicate') THEN 10**9 WHEN fault = 'truncated' THEN 3 ELSE 0 END::INT AS stay
        FROM (SELECT conv_id, i - 1 AS i, b0, b1, b2, b3 FROM search WHERE i > 1) s
        JOIN faulty f ON f.i = s.i AND f.conv_id IS NOT DISTINCT FROM s.conv_id
      )
    )
  )
),
found AS (SELECT conv_id, b0.cost AS cost, b0.audit AS audit, b0.lines AS lines FROM search WHERE i = 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN found ON found.conv_id IS NOT DISTINCT FROM o.conv_id
"""

COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
listed AS (SELECT lang, ws, len(ws) AS m FROM split WHERE len(ws) > 0),
totals AS (SELECT lang, sum(m)::BIGINT AS n FROM listed GROUP BY lang),
grams AS (
  SELECT lang, ws[s:s + k - 1] AS g, k FROM (
    SELECT lang, ws, m, k, unnest(range(1, m - k + 2)) AS s FROM listed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE m >= k
  )
),
f AS (SELECT lang, g, k, count(*)::HUGEINT AS a FROM grams GROUP BY lang, g, k HAVING count(*) >= 30),
cuts AS (SELECT lang, g, k, a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scores AS (
  SELECT c.lang, c.g, c.k, c.a, c.c, x.a AS l, y.a AS r, (2000000 * c.a) // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.c] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.c + 1:c.k]
),
least AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, c) AS place FROM scores) WHERE place = 1
),
inner_parts AS (
  SELECT DISTINCT lang, g[s:s + size - 1] AS part, a FROM (
    SELECT lang, g, k, a, size, unnest(range(1, k - size + 2)) AS s FROM f, (SELECT unnest([2, 3]) AS size) WHERE k > size
  )
),
longer AS (SELECT lang, part, max(a) AS most FROM inner_parts GROUP BY lang, part),
kept AS (
  SELECT x.*, array_to_string(x.g, ' ') AS phrase FROM least x LEFT JOIN longer y ON y.lang = x.lang AND y.part = x.g
  WHERE y.most IS NULL OR 100 * y.most < 80 * x.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op11_collocations": COLLOCATIONS,
    "op4_near_vectors": NEAR_VECTORS,
    "op6_quality_rules": QUALITY_RULES,
    "op7_jaccard_join": JACCARD_JOIN,
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op10_mix_sources": MIX_SOURCES,
    "op12_repair": REPAIR,
}
