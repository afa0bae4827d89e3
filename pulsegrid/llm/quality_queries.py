from __future__ import annotations

from .quality import score
from .queries import query, table


@query("op3_quality")
def op3_quality(spark, sf_dir):
    """Quality scores of all documents, learnt from the labelled three quarters."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
