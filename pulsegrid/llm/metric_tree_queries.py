from __future__ import annotations

from .metric_tree import top_k
from .queries import query, table

ORACLE = """
WITH q AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
        CAST(list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
      FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query("op4_top_k", ORACLE)
def op4_top_k(spark, sf_dir):
    """The five highest inner products of every fiftieth vector with all others."""
    return top_k(table(spark, sf_dir, "embeddings"))
