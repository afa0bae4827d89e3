from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import WORD
from .period_runs import longest, runs_and_rest
from .queries import query, table


def periodic_tail() -> Column:
    """The text; for one document in ten (by the checksum of its id) with a tail that repeats a block of its words."""
    text = F.coalesce("text", F.lit(""))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.slice(words, a + 1, p)
    tail = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(text)


@query("op11_period_runs")
def op11_period_runs(spark, sf_dir):
    """Runs of all documents, a tenth of them with a planted periodic tail."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_tail().alias("text"))
    runs, best = F.col("runs"), longest(F.col("runs"))
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return runs_and_rest(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), (-best["less"]).alias("length"),
        best["period"].alias("period"), F.floor(-1000 * best["less"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256")
