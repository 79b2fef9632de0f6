"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"[x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"

OP2 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         {_WORDS} AS w
  FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i : i + 7], ' ') AS run
  FROM d, unnest(range(1, len(w) - 6)) AS u(i)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, run) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) AS s(k) GROUP BY r
), raw AS (
  SELECT r, host, text, line FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM raw GROUP BY r
), lines AS (
  SELECT r, host, text, lower(array_to_string(p, ' ')) AS line, len(p) AS words
  FROM (SELECT r, host, text, [x FOR x IN string_split_regex(line, '[\x20\x09-\x0D]+') IF x <> ''] AS p FROM raw)
), common AS (
  SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT text) > 10
), lost AS (
  SELECT r, sum(words) AS n FROM lines JOIN common USING (host, line) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r)
)
SELECT *, NOT base_failed AND n_words - removed_words >= 0.5 * n_words AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
"""


def all_oracles() -> dict[str, str]:
    return {"op2_quality": OP2}
