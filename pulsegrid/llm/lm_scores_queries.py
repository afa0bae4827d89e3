from __future__ import annotations

from .lm_scores import lm_scores
from .queries import query, table


@query("op7_lm_scores")
def op7_lm_scores(spark, sf_dir):
    """Language-model scores of all documents."""
    return lm_scores(table(spark, sf_dir, "documents"))
