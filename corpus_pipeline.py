"""The corpus pipeline: from raw documents to token ids of a clean, mixed corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage but the last keeps the columns of
documents.  ``run`` writes each stage's result to the shared folder and reads it back, so a lost executor never
repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import mixing, near_dedup, pieces, pii, quality
from pulsegrid.llm.common import Stored
from pulsegrid.llm.pieces_queries import piece_bpe
from pulsegrid.llm.queries import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, learnt from the labels of these documents, accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near-duplicates."""
    return near_dedup.keep_first(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked and disclosing terms generalised or taken out."""
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of sources takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of the documents."""
    return pieces.encode(docs, piece_bpe())


STAGES = [("quality", keep_good), ("near_dedup", keep_first), ("pii", sanitise), ("mix", mix), ("pieces", encode)]

# the quality model is fitted, which SQL cannot state
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    store = Stored(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs, before = store.save(docs, name), store.names[:-1]
            store.drop(*before)  # the stage's result holds all that later ones read
    return docs
