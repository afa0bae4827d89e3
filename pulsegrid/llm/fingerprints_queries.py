from __future__ import annotations

from .fingerprints import fingerprints
from .queries import query, table


@query("op6_fingerprints")
def op6_fingerprints(spark, sf_dir):
    """Spot-signature fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
