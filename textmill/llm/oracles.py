"""DuckDB SQL for the corpus queries that SQL can express; it shares no step with them.

The quality oracle counts windows by grouping strings and sums the binomial tail term by
term; the decontamination oracle joins every window of every document with every window of
every item.
"""

from __future__ import annotations

from .decontamination import WINDOW
from .quality import CUTOFFS, ERROR, LEAST_WORDS, MOST_REPEATED, RISK, UNITS

_UNITS = list(UNITS.values())
_CUTS = ", ".join(f"({j}, CAST({c} AS DOUBLE))" for j, c in enumerate(CUTOFFS))

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT r, i, w[i] || chr(10) || w[i+1] || chr(10) || w[i+2] AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, k FROM windows GROUP BY r, k HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i+1, i+2]) AS p FROM windows JOIN twice USING (r, k)) GROUP BY r),
m AS (
  SELECT d.r, doc_id, stratum, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, len(regexp_replace(t, '[^!]', '', 'g')) AS marks, len(ls) AS n_lines
  FROM d LEFT JOIN covered USING (r)),
s AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         greatest(n_symbols / greatest(word_chars, 1) / {_UNITS[0]}, capitals / greatest(word_chars, 1) / {_UNITS[1]}, marks / greatest(word_chars, 1) / {_UNITS[2]},
                  n_dup_lines / greatest(n_lines, 1) / {_UNITS[3]}, n_repeat_words / greatest(n_words, 1) / {_UNITS[4]}) AS bad
  FROM m),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
cuts AS (SELECT * FROM (VALUES {_CUTS}) v(j, cut)),
holdouts AS (SELECT DISTINCT stratum, t, bad FROM s JOIN good USING (doc_id)),
tried AS (SELECT stratum, j, cut, count(*) AS n, count(*) FILTER (bad > cut) AS k FROM holdouts, cuts GROUP BY stratum, j, cut),
tails AS (
  SELECT *, count(DISTINCT stratum) OVER () AS strata,
         CASE WHEN k < n * {RISK} THEN list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) ELSE 1 END AS p
  FROM tried),
held AS (SELECT *, min(CASE WHEN p <= {ERROR} / strata THEN 1 ELSE 0 END) OVER (PARTITION BY stratum ORDER BY j) AS ok FROM tails),
best AS (SELECT stratum, min(cut) AS cut FROM held WHERE ok = 1 GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(bad <= cut, true) AS kept
FROM s LEFT JOIN best USING (stratum)
"""


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"list_filter(string_split_regex({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
wi AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i+{WINDOW - 1}], ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wi),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i+n-1], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hits AS (SELECT r, i, n, item FROM dw JOIN wi USING (k, n)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
