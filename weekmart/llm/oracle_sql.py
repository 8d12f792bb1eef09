"""DuckDB SQL for the queries of this subpackage that SQL can state."""

from __future__ import annotations

# Stop words as in the thresholds' table.
_STOP = """'the','of','and','to','in','a','is','that','for','it','with','as','on','by','this','was',
'der','die','und','in','den','von','zu','das','mit','sich','des','auf','ist','im','dem','nicht','ein','eine','als','auch',
'de','la','le','et','les','des','en','un','une','du','que','est','pour','qui','dans',
'el','los','las','y','se','del','por','con','una','para','al','lo','su','no'"""

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(text, '!')) AS n_bangs,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') IN ({_STOP}))) AS n_stop,
         coalesce(cov.n, 0) AS n_repeat
  FROM d LEFT JOIN cov USING (rid)),
f AS (
  SELECT *, len(l) - len(list_distinct(l)) AS n_dup,
         n_words < 50 OR 100 * n_repeat > 50 * n_words AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup AS BIGINT) AS n_dup_lines,
       CAST(n_repeat AS BIGINT) AS n_repeat_words, failed AS base_failed,
       NOT failed AND word_chars >= 2.0 * n_words AND word_chars <= 15.0 * n_words
         AND CAST(n_symbols AS DOUBLE) / n_words <= 0.3 AND CAST(n_bangs AS DOUBLE) / n_words <= 0.3
         AND CAST(n_dup AS DOUBLE) / greatest(len(l), 1) <= 0.5
         AND (n_words < 200 OR CAST(n_stop AS DOUBLE) / n_words >= 0.005) AS kept
FROM f
"""
