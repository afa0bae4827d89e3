from __future__ import annotations

from .html_text import extract_text
from .queries import query, table


@query("op5_html_text")
def op5_html_text(spark, sf_dir):
    """The main text of all pages."""
    return extract_text(table(spark, sf_dir, "pages"))
