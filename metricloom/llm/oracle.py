"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# Fixed pattern, as in the queries: words are runs of characters other than ASCII white space.
_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
_DOCS = "SELECT row_number() OVER () AS r, doc_id, source, lang, coalesce(text, '') AS t FROM documents"

LINE_FREQUENCY = rf"""
WITH docs AS ({_DOCS}),
lines AS (
  SELECT r, doc_id, source, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS at
  FROM docs),
plain AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS p FROM lines),
hosts AS (SELECT source, count(DISTINCT t) AS texts FROM docs GROUP BY source),
common AS (
  SELECT source, p FROM plain JOIN hosts USING (source) WHERE p <> ''
  GROUP BY source, p, texts HAVING count(DISTINCT t) >= 3 AND count(DISTINCT t) * 100 > texts * 5),
kept AS (
  SELECT r, coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (common.p IS NULL), 0)::BIGINT AS kept_chars,
    (count(*) FILTER (plain.p <> '') - count(DISTINCT line) FILTER (plain.p <> ''))::BIGINT AS n_dup_lines
  FROM plain LEFT JOIN common USING (source, p) GROUP BY r),
words AS (SELECT r, {_WORDS} AS w FROM docs),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
covered AS (SELECT r, count(DISTINCT k)::BIGINT AS n_repeat_words
            FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM twice WHERE n > 1) GROUP BY r),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, kept_chars
  FROM docs JOIN words USING (r) JOIN kept USING (r) LEFT JOIN covered USING (r))
SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND NOT kept_chars * 100 < word_chars * 30 AS kept
FROM base
"""

CONTAINMENT = r"""
WITH dw AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, least(len(w), 5) AS k, w FROM (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
shingles AS (SELECT DISTINCT item_id, array_to_string(w[i:i + k - 1], ' ') AS s
             FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM iw)),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
sizes AS (SELECT item_id, count(*) AS m FROM shingles GROUP BY item_id)
SELECT doc_id, item_id, m::BIGINT AS n_shingles, count(*)::BIGINT AS n_shared
FROM ds JOIN shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, m HAVING count(*) * 100 >= m * 80
"""


def _shared(level: str, parent: str, weight: str) -> str:
    """CTEs that split the parent's `given` among its children (filled in order of capacity per weight)."""
    keys = f"{parent}, {level}" if parent else level
    source = f"JOIN given_{parent.split(', ')[-1]} USING ({parent})" if parent else "CROSS JOIN (SELECT sum(tokens) * 60 // 100 AS given FROM leaves)"
    part = f"PARTITION BY {parent}" if parent else ""
    return f"""
cap_{level} AS (SELECT {keys}, sum(tokens) * 2 AS capacity, {weight} AS weight FROM leaves GROUP BY {keys}),
level_{level} AS (
  SELECT {keys}, capacity, weight,
    (given - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM cap_{level} {source}
  WINDOW o AS ({part} ORDER BY capacity::DOUBLE / weight, capacity, weight, {level})),
given_{level} AS (
  SELECT {keys}, least(capacity, floor(max(level) OVER ({part}) * weight)::BIGINT)::BIGINT AS given FROM level_{level})"""


MIXTURE = rf"""
WITH docs AS (
  SELECT doc_id, t, CASE WHEN source IN ('src0','src1','src2','src3','src4','src5','src6','src7') THEN 'crawl' ELSE 'curated' END AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, len({_WORDS})::BIGINT AS tokens
  FROM ({_DOCS})),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
{_shared("domain", "", "CASE domain WHEN 'crawl' THEN 2 WHEN 'curated' THEN 3 ELSE 1 END")},
{_shared("lang", "domain", "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END")},
{_shared("source", "domain, lang", "CASE source WHEN 'src1' THEN 2 WHEN 'src2' THEN 2 ELSE 1 END")},
plan AS (SELECT domain, lang, source, given // tokens AS whole, given % tokens AS rest
         FROM given_source JOIN leaves USING (domain, lang, source)),
ranked AS (
  SELECT docs.*, whole, rest,
    sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || (whole + 1) || ':' || doc_id)) AS so_far
  FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, tokens, unnest(range(1, whole + 1)) AS epoch FROM ranked WHERE whole > 0
UNION ALL
SELECT doc_id, domain, lang, source, tokens, whole + 1 AS epoch FROM ranked WHERE rest > 0 AND so_far <= rest
"""

_SAFE = r"regexp_replace(replace(%s, '\', '\\'), '(<|\[)(/?(?:s>|INST\]))', '\1\\\2', 'g')"
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
safe AS (SELECT *, {_SAFE % "role"} AS safe_role, {_SAFE % "t"} AS safe_text FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(safe_role) + length(safe_text) + 20)::BIGINT AS formatted_chars
FROM safe GROUP BY conv_id
"""

JACCARD = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT x.r AS x, y.r AS y, count(*) AS n FROM shingles x JOIN shingles y USING (s) WHERE x.r < y.r GROUP BY x.r, y.r),
pairs AS (
  SELECT x, y FROM shared JOIN sizes nx ON nx.r = x JOIN sizes ny ON ny.r = y WHERE 100 * shared.n >= 90 * (nx.n + ny.n - shared.n)),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT r, r AS other FROM docs UNION SELECT x, other FROM reach JOIN links ON y = r)
SELECT docs.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (r) JOIN reach USING (r) JOIN docs o ON o.r = reach.other GROUP BY docs.r, docs.doc_id
"""


def _centroids(clusters: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment and means, one pair of CTEs each."""
    parts = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
cells AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS j, unnest(v) AS x FROM kept),
seeds AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS c FROM kept ORDER BY c LIMIT {clusters}),
means0 AS MATERIALIZED (SELECT c, j, x AS m FROM cells JOIN seeds USING (r))"""]
    for t in range(rounds + 1):
        parts.append(f"""
far{t} AS (SELECT r, c, sum((x - m) * (x - m)) AS d FROM cells JOIN means{t} USING (j) GROUP BY r, c),
best{t} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d)::BIGINT AS d FROM far{t} GROUP BY r)""")
        if t < rounds:
            parts.append(f"""
sums{t} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM cells JOIN best{t} USING (r) GROUP BY c, j),
means{t + 1} AS MATERIALIZED (
  SELECT c, j, CASE WHEN s IS NULL THEN m ELSE ((s - (((s % n) + n) % n)) // n)::BIGINT END AS m FROM means{t} LEFT JOIN sums{t} USING (c, j))""")
    return ",".join(parts) + f"""
SELECT vec_id, best{rounds}.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY best{rounds}.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM kept JOIN best{rounds} USING (r)
JOIN (SELECT c, sha256(string_agg(m::BIGINT::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM means{rounds} GROUP BY c) n ON n.c = best{rounds}.c
"""


SQL = {
    "op1_chat": CHAT, "op3_containment": CONTAINMENT, "op4_line_frequency": LINE_FREQUENCY, "op8_mixture": MIXTURE,
    "op12_jaccard_regions": JACCARD, "op13_heap_centroids": _centroids(),
}
