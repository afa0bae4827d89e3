from __future__ import annotations

from .filter_audit import audit
from .queries import query, table

# the same counts from the masks: every order as a permutation of letters, every step by bit tests over the cells
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY sha256(body)) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
cell AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
         FROM d GROUP BY part, mask),
orders(filter_order, step, f, done) AS (
  SELECT '', 0, 0, 0
  UNION ALL
  SELECT filter_order || letter, step + 1, bit, done + bit
  FROM orders, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
  WHERE step < 5 AND done & bit = 0),
steps AS (
  SELECT whole.filter_order, s.step, s.f, s.done - s.f AS before
  FROM orders whole JOIN orders s ON whole.step = 5 AND s.step > 0 AND starts_with(whole.filter_order, s.filter_order)),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (before | f) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & f > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & f > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & f > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & f > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""


@query("op12_filter_audit", ORACLE)
def op12_filter_audit(spark, sf_dir):
    """All orders of the five filters over the documents of every source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
