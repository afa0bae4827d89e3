r"""Conversations formatted into training windows of a token budget, and read back.

A window is a text of whole turns, ``<|im_start|>role\nbody<|im_end|>\n`` each.  Prefix sums of the turns'
tokens choose which turns a window begins and ends with: turns whose prefix begins in the same step of
``(budget - history) / 2`` tokens form a span, except that a turn that would overrun the budget stands alone.
A window holds

* the system turn, if the conversation begins with one and this window does not hold it as its own,
* the last turns before its span, as many as fit ``history`` tokens (system turns are not repeated),
* its span.

``mask`` lists the code points of assistant bodies of the span, so repeated turns never count twice in a loss.
A turn's tokens are its words and three for its marks; the system turn comes on top of the budget.

Control strings inside bodies and roles get a backslash after their first character, and those that already
have backslashes there one more, which is undone by taking one away.  No control string is left in a body, so
windows can be cut at the marks.

Long conversations are dealt by blocks of ``BLOCK`` turn numbers; spans end with blocks, and the last ``AHEAD``
turn numbers of a block go along with the next one for its history.

Rows: a NULL text or role counts as empty; turns are ordered by number (NULL first), then role and text; rows
that repeat a turn are turns of their own; rows with a NULL ``conv_id`` form one conversation; no rows give no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import word_count

# fixed values: the marks of this template and of others that a tokenizer may know
START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")

BLOCK, AHEAD = 512, 64
_MARKS = 3  # tokens of a turn beside its words
_TAILS = "|".join(rf"\Q{c[1:]}\E" for c in CONTROLS)


@dataclass(frozen=True)
class Budget:
    """tokens: of a window's span and history; history: of the turns repeated before the span."""

    tokens: int = 1024
    history: int = 128


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(rf"([<\[])(\\*)({_TAILS})"), F.lit(r"$1$2\\$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(rf"([<\[])\\(\\*)({_TAILS})"), F.lit("$1$2$3"))


def _role(role: Column) -> Column:
    """A role on one line."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _plain_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _keyed(turns: DataFrame) -> DataFrame:
    number = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63)))
    return turns.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        number.alias("turn"), F.shiftright(number, BLOCK.bit_length() - 1).alias("block"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _system(turns: DataFrame) -> DataFrame:
    """The system turn of conversations that begin with one, once for each of their blocks (own: -1)."""
    opening = turns.groupBy("key").agg(F.min(F.struct("turn", "role")).alias("first")).where("first.role = 'system'")
    own = (turns.where("role = 'system'").join(opening, "key").where("turn = first.turn")
           .groupBy("key").agg(F.min(F.struct("turn", "role", "text")).alias("system"), F.first("conv_id").alias("conv_id")))
    blocks = turns.select("key", "block").distinct()
    return blocks.join(own, "key").select("conv_id", "key", "block", F.lit(-1).alias("own"), "system.*")


def windows(turns: DataFrame, budget: Budget = Budget(), deal_by: tuple[str, ...] = ("key", "block")) -> DataFrame:
    """conv_id, key, block, span, text, n_context (leading turns that are repeats) and mask (array of start, end).

    Turns are exchanged once, by ``deal_by``: key and block, or key alone where the reader needs whole conversations.
    """
    turns = _keyed(turns)
    cap = budget.tokens - budget.history
    step = max(cap // 2, 1)
    late = F.pmod("turn", F.lit(BLOCK)) >= BLOCK - AHEAD
    own = F.struct(F.col("block").alias("block"), F.lit(1).alias("own"))
    ahead = F.struct((F.col("block") + 1).alias("block"), F.lit(0).alias("own"))
    places = F.when(late & (F.col("role") != "system"), F.array(own, ahead)).otherwise(F.array(own))
    dealt = (turns.withColumn("place", F.explode(places))
             .select("conv_id", "key", "place.block", "place.own", "turn", "role", "text")
             .unionByName(_system(turns))
             .withColumn("tokens", word_count("text") + _MARKS).repartition(*deal_by))

    order = ["turn", "role", "text"]
    upto = Window.partitionBy("key", "block", "own").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = dealt.withColumn("upto", F.sum("tokens").over(upto)).withColumn("since", F.col("upto") - F.col("tokens"))
    # the system turn and the turns kept for the next block's history come before all spans
    turn_step = F.floor(F.col("since") / step)
    spans = spans.withColumn("piece", F.when(F.col("own") < 1, F.col("own") - 1).otherwise(
        2 * turn_step + F.when(F.col("upto") > turn_step * step + cap, 1).otherwise(0)))
    whole = Window.partitionBy("key", "block")
    before = F.max(F.when(F.col("own") == 0, 1).otherwise(0)).over(whole) + F.max(F.when(F.col("own") == -1, 1).otherwise(0)).over(whole)
    spans = spans.withColumn("span", F.dense_rank().over(whole.orderBy("piece")) - before)
    spans = spans.withColumn("spans", F.max("span").over(whole)).withColumn(
        "near", F.max("upto").over(Window.partitionBy("key", "block", "piece")) - F.col("since") <= budget.history)
    # a turn stands in its span, and in the next one if it is near that one's beginning
    near = F.col("near") & (F.col("role") != "system") & (F.col("span") < F.col("spans"))
    stay = F.array(F.struct("span", F.lit(1).alias("fresh")))
    repeat = F.array(F.struct((F.col("span") + 1).alias("span"), F.lit(0).alias("fresh")))
    # the system turn stands in every span but the one that begins with it
    opens = F.col("block") == F.shiftright("turn", BLOCK.bit_length() - 1)
    first = F.when(opens, 2).otherwise(1)
    lead = F.when(F.col("spans") >= first, F.transform(
        F.sequence(first.cast("int"), F.col("spans")), lambda n: F.struct(n.alias("span"), F.lit(-1).alias("fresh"))))
    copies = (F.when(F.col("own") == -1, lead)
              .when(F.col("own") == 0, F.when(near, repeat))
              .otherwise(F.when(near, F.concat(stay, repeat)).otherwise(stay)))
    placed = (spans.withColumn("copy", F.explode(copies))
              .select("conv_id", "key", "block", "copy.span", "copy.fresh", *order,
                      F.concat(F.lit(START), _role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body")))
    tail = END + "\n"
    run = Window.partitionBy("key", "block", "span").orderBy("fresh", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("formatted", F.concat("head", "body", F.lit(tail)))
    placed = placed.withColumn("end", F.sum(F.length("formatted")).over(run) - len(tail))
    placed = placed.withColumn("loss", F.when((F.col("fresh") == 1) & (F.col("role") == "assistant"), F.struct(
        (F.col("end") - F.length("body")).alias("start"), F.col("end").alias("end"))))
    return placed.groupBy("key", "block", "span").agg(
        F.first("conv_id").alias("conv_id"), F.count_if(F.col("fresh") < 1).cast("int").alias("n_context"),
        F.array_sort(F.collect_list(F.struct("fresh", *order, "formatted"))).alias("turns"),
        F.array_sort(F.collect_list("loss")).alias("mask"),
    ).select("conv_id", "key", "block", "span", F.array_join(F.col("turns")["formatted"], "").alias("text"), "n_context", "mask")


def turns_of(text: Column, n_context: Column) -> Column:
    """The turns of a window after its repeated ones: an array of role and text."""
    parts = F.split(text, rf"\Q{START}\E")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END + "\n"))
        return F.struct(_plain_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(parts, n_context + 2, F.greatest(F.size(parts) - n_context - 1, F.lit(0))), turn)


def read_windows(made: DataFrame) -> DataFrame:
    """Per window its conversation and place, the turns that are its own, and the texts under its mask."""
    def masked(span: Column) -> Column:
        return unescape(F.substr("text", (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    return made.select("conv_id", "key", "block", "span", F.length("text").alias("chars"),
                       turns_of(F.col("text"), F.col("n_context")).alias("turns"), F.transform("mask", masked).alias("loss"))
