"""Spot signatures as document fingerprints (DataFrame functions only).

A spot is a common word and the content words that follow it up to the next common word, ``CHAIN`` at most.
The set of spots of a text is its fingerprint, written as sorted 32-bit hashes in hex; equal texts have equal
fingerprints and an edit touches only the spots it overlaps.  Texts with few common words (less than one spot
in ``SPARSE`` words: tables, lists, noise) add a spot for every word and its follower.

Sets are compared by intersection over union, whatever their lengths.

The next document in order of doc_id is found without a global sort: rows go to chunks of ``SPAN`` consecutive
ids (each bounded by the ids it spans), and the first row of every chunk also goes to the chunk before it.

Rows: NULL and empty texts have an empty fingerprint, and two empty ones are alike (1.0); rows that repeat a
doc_id follow each other in order of text; rows without a doc_id are left out; a single document is its own
next; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Stored

# fixed values: frequent function words of English, German, French and Spanish
COMMON = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by", "this", "at", "are",
    "an", "from", "der", "die", "und", "den", "von", "das", "zu", "des", "im", "mit", "nicht", "ein", "eine", "auf", "sich",
    "de", "la", "le", "les", "et", "un", "une", "du", "en", "que", "qui", "dans", "est", "pour", "par", "el", "los", "y", "las",
    "del", "se", "por", "con", "su", "para", "no", "|",
)
CHAIN, SPARSE = 3, 8
SPAN, BLOCK = 256, 4096  # ids of a chunk; chunks whose order is settled in one task

# blanks before a common word (with marks around it or not) that begins a spot
_SPOT = r"\s+(?=(?:" + "|".join(w.replace("|", r"\|") for w in COMMON) + r")[^\p{L}\s]*+(?:\s|$))"


def spots(text: Column) -> Column:
    """The distinct spot hashes of a text, as an array of int."""
    padded = F.concat(F.lit(" "), F.lower(text))
    chains = F.transform(F.slice(F.split(padded, _SPOT), 2, 2**31 - 1), lambda s: F.slice(F.split(s, r"\s+"), 1, CHAIN + 1))
    hashes = F.transform(F.filter(chains, lambda c: F.size(F.array_remove(c, "")) > 1), lambda c: F.hash(F.array_join(c, " ")))
    return F.array_distinct(hashes)


def _dense(text: Column, own: Column) -> Column:
    """Spots, with pairs of neighbouring words where spots are few."""
    found = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    pairs = F.zip_with(found, F.slice(found, 2, 2**31 - 1), lambda w, after: F.hash(F.concat_ws(" ", w, after)))
    return F.when(F.size(own) * SPARSE < F.regexp_count(text, F.lit(r"\S+")), F.array_distinct(F.concat(own, pairs))).otherwise(own)


def with_spots(rows: DataFrame, text: str, name: str) -> DataFrame:
    rows = rows.withColumn(name, spots(F.col(text)))
    return rows.withColumn(name, _dense(F.col(text), F.col(name)))


def fingerprint(of: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(of), lambda h: F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(2**32 - 1))))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Intersection over union; 1 for two empty sets."""
    common = F.size(F.array_intersect(a, b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
            .otherwise(common / (F.size(a) + F.size(b) - common)))


def _chunk(doc_id: str = "doc_id") -> Column:
    return F.floor(F.col(doc_id) / SPAN).cast("long")


def chunk_heads(ids: DataFrame) -> DataFrame:
    """doc_id of the first row of every chunk and the chunk before (the last chunk for the very first)."""
    heads = ids.groupBy(_chunk().alias("chunk")).agg(F.min("doc_id").alias("doc_id")).withColumn(
        "block", F.floor(F.col("chunk") / BLOCK))
    blocks = heads.groupBy("block").agg(F.max("chunk").alias("last"))
    order = Window.orderBy("block")  # one row per block of chunks
    blocks = blocks.select("block", F.coalesce(
        F.lag("last").over(order), F.max("last").over(Window.partitionBy(F.lit(0)))).alias("before"))
    inner = F.lag("chunk").over(Window.partitionBy("block").orderBy("chunk"))
    return heads.withColumn("inner", inner).join(blocks, "block").select("doc_id", F.coalesce("inner", "before").alias("into"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and both texts' spots of every document, the next one by ascending doc_id."""
    store = Stored(docs.sparkSession, "spots")
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    heads = store.save(chunk_heads(docs.where("doc_id IS NOT NULL").select("doc_id")), "heads")
    # a row's own chunk, and for heads also the one before; Spark broadcasts the heads while they are small
    sent = rows.join(heads, "doc_id", "left").select("doc_id", "text", F.explode(F.when(
        F.col("into").isNull(), F.array(F.struct(_chunk().alias("chunk"), F.lit(False).alias("guest")))).otherwise(F.array(
            F.struct(_chunk().alias("chunk"), F.lit(False).alias("guest")),
            F.struct(F.col("into").alias("chunk"), F.lit(True).alias("guest"))))).alias("to")).select(
                "doc_id", "text", "to.chunk", "to.guest")
    order = Window.partitionBy("chunk").orderBy("guest", "doc_id", "text")
    rows = sent.withColumn("next_text", F.lead("text").over(order))
    rows = with_spots(rows, "text", "own")
    return rows.withColumn("next", F.lead("own").over(order)).where("NOT guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form (the last quarter replaced by the beginning of the
    next document), their likeness, and the likeness to the next document."""
    rows = with_next(docs)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - quarter),
                                              F.substring(F.col("next_text"), F.lit(1), quarter)))
    rows = with_spots(rows, "edited", "changed")
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
