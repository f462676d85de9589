"""Preference formatting of chosen and rejected conversations, on DataFrame functions.

Works turn by turn: a conversation is never gathered into one row, so neither
a long conversation nor many alike ones make a large task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<|{role}|>\n", "\n"  # around each turn


def _turns(turns: DataFrame, side: str) -> DataFrame:
    """One row for each conversation and turn; of rows that share both, the smallest (role, text) counts."""
    return turns.filter("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.lit(side).alias("side"), F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"))


def rendered(role: Column, text: Column) -> Column:
    before, after = OPEN.split("{role}")
    return F.concat(F.lit(before), role, F.lit(after), text, F.lit(CLOSE))


def preference_rows(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Prompt, chosen and rejected rows of each pair, one row for each turn.

    Both inputs have (conv_id, turn, role, text); a pair is a conv_id that
    occurs in both.  The longest common prefix of turns (same turn number,
    role and text) is the prompt and comes once; what follows comes as part
    `chosen` and part `rejected`.  Returns conv_id, part, turn, role, content
    (the rendered turn) and mask (1 where the loss counts: assistant turns of
    a completion).  A part's content in order of turn is its text.

    Null roles and texts are empty; rows without conv_id or turn belong to no
    conversation; of rows that share both, the smallest counts; a pair whose
    sides are equal is all prompt.  Other columns are not read.
    """
    both = _turns(chosen, "chosen").unionByName(_turns(rejected, "rejected"))
    met = both.groupBy("conv_id", "turn").agg(*[F.min(F.when(F.col("side") == s, F.col("said"))).alias(s) for s in ("chosen", "rejected")])
    # Turns before the first that differs; a side that lacks the turn differs.
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    pairs = met.groupBy("conv_id").agg(
        F.min(F.when(differs, F.col("turn"))).alias("_fork"), F.count("chosen").alias("_c"), F.count("rejected").alias("_r"))
    placed = met.join(pairs.filter("_c > 0 and _r > 0").select("conv_id", "_fork"), "conv_id")
    prompt = F.col("_fork").isNull() | (F.col("turn") < F.col("_fork"))
    part = lambda name, said: F.struct(F.lit(name).alias("part"), F.col(said).alias("said"))
    parts = F.when(prompt, F.array(part("prompt", "chosen"))).otherwise(F.array(part("chosen", "chosen"), part("rejected", "rejected")))
    rows = placed.select("conv_id", "turn", F.inline(parts)).filter("said is not null")
    return rows.select(
        "conv_id", "part", "turn", F.col("said.role").alias("role"), rendered(F.col("said.role"), F.col("said.text")).alias("content"),
        F.when((F.col("part") != "prompt") & (F.col("said.role") == "assistant"), 1).otherwise(0).alias("mask"))


def repeated_answer(turns: DataFrame) -> DataFrame:
    """A worse variant of each conversation: its last answer gives way to its first one, or to nothing.

    With one answer only, the answer is empty; a conversation without an
    answer stays as it is.  Columns conv_id, turn, role, text.
    """
    answers = turns.filter("role = 'assistant' and conv_id is not null and turn is not null")
    ends = answers.groupBy("conv_id").agg(
        F.max("turn").alias("_last"), F.min("turn").alias("_first"),
        F.min(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("_said"))
    again = F.when(F.col("_first") < F.col("_last"), F.col("_said.text")).otherwise("")
    return turns.select("conv_id", "turn", "role", "text").join(ends, "conv_id", "left").select(
        "conv_id", "turn", "role", F.when((F.col("role") == "assistant") & (F.col("turn") == F.col("_last")), again).otherwise(F.col("text")).alias("text"))


SQL = """
WITH ends AS (
  SELECT conv_id, max(turn) AS last, min(turn) AS first, min({'turn': turn, 'text': coalesce(text, '')}).text AS said
  FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id),
c AS (
  SELECT conv_id, turn, min({'role': coalesce(role, ''), 'text': coalesce(text, '')}) AS said FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
r AS (
  SELECT v.conv_id, turn, min({'role': coalesce(role, ''), 'text': CASE WHEN role = 'assistant' AND turn = last
    THEN CASE WHEN first < last THEN e.said ELSE '' END ELSE coalesce(text, '') END}) AS said
  FROM conversations v LEFT JOIN ends e USING (conv_id) WHERE v.conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
met AS (SELECT conv_id, turn, c.said AS a, r.said AS b, min(CASE WHEN c.said IS DISTINCT FROM r.said THEN turn END) OVER (PARTITION BY conv_id) AS fork
  FROM c FULL JOIN r USING (conv_id, turn)),
parts AS (
  SELECT conv_id, 'prompt' AS part, turn, a AS said FROM met WHERE fork IS NULL OR turn < fork
  UNION ALL SELECT conv_id, 'chosen', turn, a FROM met WHERE turn >= fork AND a IS NOT NULL
  UNION ALL SELECT conv_id, 'rejected', turn, b FROM met WHERE turn >= fork AND b IS NOT NULL)
SELECT conv_id, part, turn, said.role AS role, '<|' || said.role || '|>' || chr(10) || said.text || chr(10) AS content,
  CASE WHEN part <> 'prompt' AND said.role = 'assistant' THEN 1 ELSE 0 END AS mask FROM parts
"""
