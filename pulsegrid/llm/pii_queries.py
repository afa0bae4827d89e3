from __future__ import annotations

from .pii import personal_data
from .queries import query, table


@query("op2_pii")
def op2_pii(spark, sf_dir):
    """Personal data and disclosing terms of all documents."""
    return personal_data(table(spark, sf_dir, "documents"))
