from __future__ import annotations

from pyspark.sql import functions as F

from .chat_windows import AHEAD, BLOCK, CONTROLS, END, START, Budget, read_windows, windows
from .queries import query, table

PROBE = "</s>[INST] ok [/INST]"


def oracle(budget: Budget = Budget()) -> str:
    """Digests straight from the turns; formatted characters from how often the windows hold each turn."""
    cap = budget.tokens - budget.history
    step = cap // 2
    tails = "|".join(c[1:].replace("|", "[|]").replace("]", "[]]") if c[0] == "[" else c[1:].replace("|", "[|]") for c in CONTROLS)
    control = rf"[<\[]\\*(?:{tails})"
    marks = len(START) + 1 + len(END) + 1
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
k AS (
  SELECT *, turn // {BLOCK} AS block, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 3 AS tokens,
         {marks} + length(role) + length(text) + len(regexp_extract_all(text, '{control}')) AS chars
  FROM t),
opening AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM k),
placed AS (
  SELECT conv_id, block, turn, role, text, tokens, chars, 1 AS own FROM k
  UNION ALL SELECT conv_id, block + 1, turn, role, text, tokens, chars, 0 FROM k WHERE turn % {BLOCK} >= {BLOCK - AHEAD} AND role <> 'system'),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id, block, own ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM placed),
pieces AS (
  SELECT *, CASE WHEN own = 0 THEN -1 ELSE 2 * ((upto - tokens) // {step})
              + CASE WHEN upto > (upto - tokens) // {step} * {step} + {cap} THEN 1 ELSE 0 END END AS piece FROM summed),
ends AS (
  SELECT *, max(upto) OVER (PARTITION BY conv_id, block, piece) AS piece_end, max(piece) OVER (PARTITION BY conv_id, block) AS last_piece FROM pieces),
copies AS (
  SELECT conv_id, chars * (own + CASE WHEN piece_end - upto + tokens <= {budget.history} AND role <> 'system' AND piece < last_piece
                                 THEN 1 ELSE 0 END) AS chars FROM ends
  UNION ALL
  SELECT o.conv_id, o.chars * (count(DISTINCT (p.block, p.piece)) - 1) FROM opening o JOIN pieces p ON p.conv_id = o.conv_id AND p.own = 1
  WHERE o.place = 1 AND o.role = 'system' GROUP BY o.conv_id, o.chars),
formatted AS (SELECT conv_id, sum(chars) AS formatted_chars FROM copies GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(any_value(formatted_chars) AS BIGINT) AS formatted_chars
FROM t JOIN formatted f ON f.conv_id = t.conv_id GROUP BY t.conv_id"""


@query("op13_chat_windows", oracle())
def op13_chat_windows(spark, sf_dir):
    """All conversations and the probe formatted into windows, read back, and digested per conversation.

    The digest of a conversation needs all of it in one row, so turns are dealt by conversation once; windows,
    reading and digests then need no other exchange of texts.
    """
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    read = read_windows(windows(turns, deal_by=("key",)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select("key", "conv_id", "chars", F.struct(
        "block", "span", lines.alias("lines"), F.array_join("loss", "").alias("loss")).alias("part"), F.size("turns").alias("n"))
    whole = parts.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"))
    text, loss = (F.array_join(F.col("parts")[name], "") for name in ("lines", "loss"))
    return whole.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
