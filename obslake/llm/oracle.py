"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from obslake.llm import quality_rules as qr
from obslake.llm.common import WORD


def quality_rules_sql(source: str = "documents") -> str:
    """Rows of ``judge`` with the row's place ``rid``, over the rows of ``source`` (doc_id, text)."""
    count = lambda text, pattern: f"length(regexp_extract_all({text}, '{pattern}'))"
    end = qr.SENTENCE_END.replace("'", "''")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {source}),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d),
lines AS (SELECT rid, line, {count('line', WORD)} AS n, {count('line', qr.MARK_RUNS)} AS marks, {count('line', qr.SEPARATORS)} AS bars
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)),
by_line AS (SELECT rid, count(*) - count(DISTINCT line) AS dups, sum(CASE WHEN
    (n >= 5 AND NOT regexp_matches(line, '{end}')) OR (bars >= 2 AND bars * 3 >= n) OR (marks >= 1 AND marks * 3 >= n)
    OR (n <= 30 AND regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{qr.BOILERPLATE}'))
    THEN 0 ELSE n END) AS n_left FROM lines WHERE n > 0 GROUP BY rid),
places AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
windows AS (SELECT * FROM (SELECT rid, i, x || ' ' || lead(x, 1) OVER p || ' ' || lead(x, 2) OVER p AS x FROM places
  WINDOW p AS (PARTITION BY rid ORDER BY i)) WHERE x IS NOT NULL),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, x) >= 2),
covered AS (SELECT rid, sum(n) AS n_repeat FROM (
  SELECT rid, least(3, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 3)) AS n FROM twice) GROUP BY rid),
judged AS (SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST({count('t', qr.SYMBOLS)} AS BIGINT) AS n_symbols,
    CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_left, 0) AS n_left
  FROM w LEFT JOIN by_line USING (rid) LEFT JOIN covered USING (rid))
SELECT rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 100 * n_left >= 50 * n_words) AS kept
FROM judged"""


def phrase_mining_sql(source: str = "documents") -> str:
    """Rows of ``phrase_mining.mine`` with its defaults, over the rows of ``source`` (lang, text)."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM {source}),
pieces AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
w1 AS (SELECT lang, pid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM pieces),
w3 AS (SELECT lang, x, x || ' ' || lead(x) OVER p AS x2, x || ' ' || lead(x) OVER p || ' ' || lead(x, 2) OVER p AS x3 FROM w1
  WINDOW p AS (PARTITION BY pid ORDER BY i)),
f AS (SELECT lang, x AS phrase, 1 AS size, CAST(count(*) AS HUGEINT) AS f FROM w3 GROUP BY ALL
  UNION ALL SELECT lang, x2, 2, count(*) FROM w3 WHERE x2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, x3, 3, count(*) FROM w3 WHERE x3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, count(*) AS n FROM w1 GROUP BY lang),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 10),
cuts AS (SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS left_part, array_to_string(w[k + 1:size], ' ') AS right_part
  FROM c, (VALUES (1), (2)) AS cut(k) WHERE k < size),
scored AS (SELECT u.*, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score FROM cuts u
  JOIN f x ON x.lang = u.lang AND x.phrase = left_part AND x.size = k
  JOIN f y ON y.lang = u.lang AND y.phrase = right_part AND y.size = u.size - k
  QUALIFY row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, part, max(a) AS longer FROM (
  SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE size = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.phrase AND s.size = 2
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000"""


ORACLE: dict[str, str] = {
    "op3_quality_rules": f"SELECT * EXCLUDE (rid) FROM ({quality_rules_sql()})",
    "op13_phrase_mining": phrase_mining_sql(),
}
