import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names clash with inner ones."""

    def make(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        clash = ["size", "h", "id", "key", "rep", "row", "word", "term", "print", "chunk", "shard", "salt", "score", "node", "times"]
        return frame.select("*", *[F.lit(f"extra {c}").alias(c) for c in clash])

    return make
