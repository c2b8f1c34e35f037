"""The SQL that the queries are held against, where SQL can express an operator's result."""

from __future__ import annotations

from quayside.llm.linequality import BOILERPLATE, LINE_END

_PHRASES = "|".join(BOILERPLATE)
_ENDS = ", ".join("'" + mark.replace("'", "''") + "'" for mark in LINE_END)

LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT doc_id, i, lines[i] AS line,
         translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM docs, unnest(range(1, len(lines) + 1)) AS t(i)),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent ON keyed.key = frequent.key
GROUP BY doc_id
"""

# the default rules of LineRules line by line, and windows of three words by their number
LINE_QUALITY = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
places AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS triple
  FROM words, unnest(range(1, len(words) - 1)) AS t(i)),
twice AS (SELECT doc_id, triple FROM places GROUP BY ALL HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM places JOIN twice USING (doc_id, triple), range(3) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, i, lines[i] AS line, regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+') AS own
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM docs), unnest(range(1, len(lines) + 1)) AS t(i)),
measured AS (
  SELECT doc_id, i, line, len(own) AS n, len(list_distinct(own)) AS n_distinct,
    right(own[-1], 1) IN ({_ENDS}) AS ended,
    len(regexp_extract_all(line, '[!?]')) AS shouts,
    len(regexp_extract_all(line, '[|»›•·]')) AS bars,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    regexp_matches(lower(line), '{_PHRASES}') AS boilerplate
  FROM lines WHERE len(own) > 0),
judged AS (
  SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup,
    (n < 6 AND NOT ended) OR (n > 1 AND shouts > 0.5 * n) OR (bars >= 2 AND bars * 6 >= n)
    OR (n > 1 AND symbols > 0.5 * n) OR (n <= 20 AND boilerplate) OR (n >= 10 AND n_distinct < 0.2 * n) AS lost
  FROM measured),
by_line AS (
  SELECT doc_id, count(*) FILTER (WHERE dup) AS n_dup_lines,
    CAST(coalesce(sum(n) FILTER (WHERE lost), 0) AS BIGINT) AS n_lost_words
  FROM judged GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lost_words, 0) AS n_lost_words
  FROM words LEFT JOIN by_line USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words <= 0.5 * n_words AS kept
FROM counted
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT doc_id, b FROM reached JOIN edges ON a = other)
SELECT doc_id, CAST(max(len(s)) AS BIGINT) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id
"""

TOP_K = """
WITH finite AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
vectors AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM finite),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _put(value: str, cost: str, edit: str, row: str | None) -> str:
    """A state's (cost, audit, rows) after one more edit; null where the state cannot be reached."""
    rows = f"list_append({value}.t, {row})" if row else f"{value}.t"
    return f"CASE WHEN {value} IS NOT NULL THEN {{'c': {value}.c + {cost}, 'a': {value}.a || '{edit}', 't': {rows}}} END"


_ROW, _CUT = "role || ':' || text", "CAST(cut AS BIGINT)"
_FREE = "NOT gone AND "


def _kept(value: str, initial: str, renamed: str) -> str:
    """A row that stays: as it is where its role has the initial, else with its role changed."""
    keep = _put(value, _CUT, "K", _ROW)
    rename = _put(value, f"2 + {_CUT}", "R", f"'{renamed}:' || text")
    return f"CASE WHEN {_FREE}initial = '{initial}' THEN {keep} WHEN {_FREE}TRUE THEN {rename} END"


_DELETED = [_put(f"b{p}", "3", "D", None) for p in range(4)]
_INSERTED = [_put(f"s{p}", "2", "I", "'user:'") for p in (0, 1, 3)]
_CLOSED = f"""s0 AS b0, s1 AS b1, least(s2, {", ".join(_INSERTED)}) AS b2"""

# the best way to each of the four points of the order, row by row: nothing, behind system, behind user, behind assistant
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_concat([4294967295], [CAST(ord(c) AS BIGINT) FOR c IN string_split(
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 1, 2, 3, 4, 5, 6, 7]),
      lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS damage
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS r(copy)),
numbered AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER o || left(role, 1) AS pair, row_number() OVER o AS i,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS unended
  FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (
  SELECT *, blank OR again AS gone, again AND NOT blank AS duplicate, unended AND NOT blank AND NOT again AS cut
  FROM (SELECT *, i > min(i) OVER (PARTITION BY conv_id, role, text) AS again FROM numbered)),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
parsed AS (
  SELECT conv_id, n, CAST(0 AS BIGINT) AS pos, z AS b0, NULLIF(z, z) AS b1, {{'c': CAST(2 AS BIGINT), 'a': 'I', 't': ['user:']}} AS b2,
    {{'c': CAST(4 AS BIGINT), 'a': 'II', 't': ['user:', 'assistant:']}} AS b3
  FROM counted, (SELECT {{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}} AS z)
  UNION ALL
  SELECT conv_id, n, pos, b0, b1, b2, least(s3, {_put("b2", "2", "I", "'assistant:'")}) AS b3
  FROM (SELECT conv_id, n, pos, s3, {_CLOSED} FROM (
    SELECT p.conv_id, n, i AS pos, {_DELETED[0]} AS s0,
      least({_DELETED[1]}, CASE WHEN {_FREE}initial = 's' THEN {_put("b0", _CUT, "K", _ROW)} END) AS s1,
      least({_DELETED[2]}, {", ".join(_kept(f"b{p}", "u", "user") for p in (0, 1, 3))}) AS s2,
      least({_DELETED[3]}, {_kept("b2", "a", "assistant")}) AS s3
    FROM parsed p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.pos + 1))),
best AS (SELECT conv_id, least(b0, b3) AS b FROM parsed WHERE pos = n)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

# every pair in doubles; ids are unique there
NEAR_VECTORS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT vec_id, b FROM reached JOIN links ON a = other)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, min(other) = vec_id AS kept
FROM reached LEFT JOIN counted USING (vec_id) GROUP BY vec_id
"""
