from __future__ import annotations

from .near_dedup import NearDedup, near_duplicates
from .queries import query, table

# all pairs that share a shingle, and classes by repeated look-up of smaller neighbours
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle)
      WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS start, doc_id AS node FROM w UNION SELECT start, b FROM r JOIN l ON node = a),
c AS (SELECT start, min(node) AS component_id FROM r GROUP BY start)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON w.doc_id = c.start"""


@query("op1_near_dedup", ORACLE)
def op1_near_dedup(spark, sf_dir):
    """Near-duplicate classes of all documents by sets of four-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), NearDedup(width=4))
