"""Mixing sources to target weights by capped water-filling.

Every source is to give ``weight`` shares of the mix, but none more than ``cap`` times its own size.
What a capped source cannot give goes to the others in proportion to their weights until no target
is above its cap.  The fixed point is ``target = min(cap * size, level * weight)``; the level follows
from one sort of the sources by ``cap * size / weight``.

Each document is then repeated ``floor(target / size)`` times; the rest of a target is filled with
documents in the order of a seeded hash of their id, and one more document whose size comes nearest
to what is still missing.  The choice depends on the seed and the data only.

Rows: NULL or empty texts have size 0 and change nothing; a NULL source is a source of its own, last
in order; rows that repeat a ``doc_id`` within a source are taken or left together; no rows give no
rows.  Extra columns travel along in ``mix``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Stored, word_count

SALTS = 64  # copies of the one-row-per-source table, so that a large source is dealt to many tasks
_BITS = 12  # of the 60-bit hash, for each of the two levels of the search for a cut


@dataclass(frozen=True)
class Mix:
    """weights: repeat over the sources in order; share: size of the mix against all sizes; cap: most epochs."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5
    cap: float = 2.0
    seed: int = 17


def order_hash(seed: int, doc_id: str | Column = "doc_id") -> Column:
    """60 uniform bits from the seed and the document id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def _keyed(docs: DataFrame, mix: Mix) -> DataFrame:
    """What the choice needs of a document: the source, its key, size, hash and id."""
    return docs.select(
        "source", _source_key().alias("skey"), word_count("text").alias("size"),
        order_hash(mix.seed).alias("h"), F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
    )


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """skey, source_size and target of every source; ``sizes`` has source, skey and size.

    Windows without a partition run over one row per source.
    """
    sources = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]),
                     ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                      % len(mix.weights) + 1).cast("int")),
    )
    rise = Window.orderBy((F.col("most") / F.col("weight")), "skey")
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    onward = rise.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    filled = (
        ranked.withColumn("most", mix.cap * F.col("source_size"))
        .withColumn("mix_size", mix.share * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("mix_size") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                    / F.sum("weight").over(onward))
        .withColumn("turn", F.row_number().over(rise))
        # sources before the first that stays below its cap are capped
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct("turn", "level")))
                    .over(everything)["level"])
    )
    return filled.select(
        "skey", "source_size",
        F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")).alias("target"),
    )


def _salted(per_source: DataFrame) -> DataFrame:
    return per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _with_plan(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """Documents (with skey and h) beside the row of their source."""
    return docs.withColumn("salt", (F.col("h") % SALTS).cast("int")).join(_salted(per_source), ["skey", "salt"], "left").drop("salt")


def source_plan(keyed: DataFrame, store: Stored, mix: Mix = Mix()) -> DataFrame:
    """One row per source: how often all of it is taken and where in hash order the rest ends.

    Running sums never cover a whole source: the cut is first located among 4096 hash ranges,
    then among 4096 parts of that range, and only the documents of that part are ordered.
    """
    targets = source_targets(keyed, mix).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = store.save(targets.coalesce(1), "targets")

    def cut(of: DataFrame, shift: int, span: DataFrame) -> DataFrame:
        """The first hash range in which the sum of sizes passes what is missing: its start, and the missing part."""
        sums = of.groupBy("skey", F.shiftright("h", shift).alias("part")).agg(F.sum("size").alias("sum"))
        up = Window.partitionBy("skey").orderBy("part")
        run = sums.join(span, "skey").withColumn("end", F.sum("sum").over(up))
        return (run.where(F.col("end") > F.col("rest")).groupBy("skey")
                .agg(F.min(F.struct("part", (F.col("end") - F.col("sum")).alias("passed"))).alias("first"))
                .select("skey", "first.part", "first.passed"))

    coarse = cut(keyed, 60 - _BITS, targets.select("skey", "rest"))
    near = store.save(
        _with_plan(keyed.select("skey", "size", "h", "id"), coarse.join(targets.select("skey", "rest"), "skey"))
        .where(F.shiftright("h", 60 - _BITS) == F.col("part"))
        .select("skey", "size", "h", "id", (F.col("rest") - F.col("passed")).alias("rest"), "passed"), "near")
    missing = near.groupBy("skey").agg(F.first("rest").alias("rest"), F.first("passed").alias("over"))
    fine = cut(near, 60 - 2 * _BITS, missing.select("skey", "rest"))
    last = _with_plan(near.select("skey", "size", "h", "id"), fine.join(missing, "skey")).where(
        F.shiftright("h", 60 - 2 * _BITS) == F.col("part"))
    ordered = last.withColumn("end", F.sum("size").over(Window.partitionBy("skey").orderBy("h", "id")) + F.col("passed"))
    ends = ordered.groupBy("skey").agg(
        F.max(F.when(F.col("end") <= F.col("rest"), F.struct("h", "id"))).alias("upto"),
        F.coalesce(F.max(F.when(F.col("end") <= F.col("rest"), F.col("end"))), F.first("passed")).alias("inside"),
        F.first("over").alias("over"),
        F.shiftleft(F.first("part"), 60 - 2 * _BITS).alias("start"),
    )
    # a source without an end is taken up to the last document
    plan = store.save(targets.join(ends, "skey", "left").select(
        "skey", "source_size", "target", "whole",
        F.when(F.col("start").isNull(), F.lit(2**61)).otherwise(F.coalesce("upto.h", F.col("start") - 1)).alias("upto_h"),
        F.coalesce("upto.id", F.lit(2**63 - 1)).alias("upto_id"),
        F.when(F.col("start").isNull(), F.lit(0.0)).otherwise(F.col("rest") - F.col("inside") - F.col("over")).alias("gap"),
    ).coalesce(1), "ends")
    gap = F.abs(F.col("size") - F.col("gap"))
    filler = (
        _with_plan(keyed.select("skey", "size", "h", "id"), plan)
        .where(~_taken() & (F.col("size") > 0) & (gap < F.col("gap")))
        .groupBy("skey").agg(F.min(F.struct(gap.alias("gap"), "h", "id")).alias("filler"))
    )
    done = store.save(plan.drop("gap").join(filler, "skey", "left").select(
        "skey", "source_size", "target", "whole", "upto_h", "upto_id",
        F.col("filler.h").alias("fill_h"), F.col("filler.id").alias("fill_id")).coalesce(1), "plan")
    store.drop("near", "targets", "ends")
    return done


def _taken() -> Column:
    return (F.col("h") < F.col("upto_h")) | ((F.col("h") == F.col("upto_h")) & (F.col("id") <= F.col("upto_id")))


def _times() -> Column:
    """How often a document beside its source's plan goes into the mix."""
    filler = F.coalesce((F.col("h") == F.col("fill_h")) & (F.col("id") == F.col("fill_id")), F.lit(False))
    return F.col("whole") + F.when(_taken() | filler, 1).otherwise(0)


def mix_counts(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken (words of the document in the mix) of every row."""
    store = Stored(docs.sparkSession, "mix")
    keyed = store.save(_keyed(docs, mix).withColumn("doc_id", F.when(F.col("id") != F.lit(-(2**63)), F.col("id"))), "keyed")
    plan = source_plan(keyed, store, mix)
    return _with_plan(keyed, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times()).cast("long").alias("taken"))


def mix(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it (documents without words
    as often as the whole repetitions of their source, once at least)."""
    store = Stored(docs.sparkSession, "mix")
    plan = source_plan(store.save(_keyed(docs, mix), "keyed"), store, mix)
    own = {"skey": _source_key(), "h": order_hash(mix.seed), "id": F.coalesce("doc_id", F.lit(-(2**63)))}
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      *[c.alias(n) for n, c in own.items()], word_count("text").alias("size"))
    times = F.when(F.col("size") > 0, _times()).otherwise(F.greatest("whole", F.lit(1)))
    repeated = _with_plan(row, plan).withColumn("times", times.cast("int")).where("times > 0")
    return repeated.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
