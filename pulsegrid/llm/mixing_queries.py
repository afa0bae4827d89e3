from __future__ import annotations

from .mixing import Mix, mix_counts
from .queries import query, table


def oracle(mix: Mix = Mix()) -> str:
    """The same mix in DuckDB: plain running sums, and a list of weights by rank."""
    weights = ", ".join(f"{float(w)}::DOUBLE" for w in mix.weights)
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
             CAST('0x' || substr(md5('{mix.seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([{weights}])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)} + 1 AS INT)] AS weight,
             {mix.cap} * source_size AS most, {mix.share} * (SELECT sum(source_size) FROM s) AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size,
        coalesce(least(most, (SELECT arg_min(level, (most / weight, source)) FROM l WHERE level <= most / weight) * weight), most) AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
      FROM t),
r AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id) AS upto
      FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source),
g AS (SELECT *, rest - coalesce(max(CASE WHEN upto <= rest THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM r),
f AS (SELECT source, min((abs(size - gap), h, doc_id)) AS pick FROM g
      WHERE upto > rest AND size > 0 AND abs(size - gap) < gap GROUP BY source)
SELECT g.doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(size * (whole + CASE WHEN upto <= rest OR (h = pick[2] AND g.doc_id = pick[3]) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM g LEFT JOIN f ON g.source IS NOT DISTINCT FROM f.source"""


@query("op10_mix", oracle())
def op10_mix(spark, sf_dir):
    """All documents mixed to weights 5, 2, 1 over 150 % of their words, two epochs at most."""
    return mix_counts(table(spark, sf_dir, "documents"))
