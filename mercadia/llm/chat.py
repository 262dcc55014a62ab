"""Chat formatting: multi-party perspective rotation.

Every participant of a dialogue gets a rendering of the whole dialogue in which
their own turns are the assistant's and everybody else speaks as a named user.
Only the assistant's words carry loss. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The template of a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNNAMED = "system", "unknown"


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", turns_per_block: int = 64) -> DataFrame:
    """One row per (conversation, participant, turn): that turn as rendered for
    that participant and where it stands in the participant's rendering.

    Columns: conv_id, speaker, turn, seq (long, from 0 in each rendering), role
    (system / assistant / user), name (of a user, else null), rendered, start_at,
    end_at (code points in the rendering, end exclusive), mask_start, mask_end
    (span that carries loss: the assistant's text with its closing mark; both
    equal ``end_at`` where nothing does).

    The pieces of a rendering, in order of seq, concatenate to it without gaps
    (``assemble`` does so); keeping them apart lets a conversation of any length
    spread over tasks. Cases: a blank or null role is the participant
    ``unknown``; ``system`` turns are kept, but system is no participant, so a
    conversation of system turns alone has no row; a null text is empty; a null
    conversation id is one conversation; equal turn numbers are ordered by role,
    then text, and repeated rows are all kept; a null turn number comes first.
    Offsets are summed per block of ``turns_per_block`` turn numbers, then within.
    """
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.nullif(F.trim(F.col(role_col).cast("string")), F.lit("")), F.lit(UNNAMED)).alias("_by"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    people = (t.where(F.col("_by") != SYSTEM).groupBy(F.col("conv_id").alias("_conv"))
              .agg(F.collect_set("_by").alias("_people")))
    seen = (t.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))
            .select("conv_id", F.explode("_people").alias("speaker"), "turn", "_by", "_text"))
    own, system = F.col("_by") == F.col("speaker"), F.col("_by") == SYSTEM
    seen = (seen
            .withColumn("role", F.when(system, F.lit(SYSTEM)).when(own, F.lit("assistant")).otherwise(F.lit("user")))
            .withColumn("name", F.when(~system & ~own, F.col("_by")))
            .withColumn("rendered", F.concat(F.lit(OPEN), F.col("role"),
                                             F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")),
                                             F.lit("\n"), F.col("_text"), F.lit(CLOSE)))
            .withColumn("_n", F.char_length("rendered").cast("long"))
            .withColumn("_block", F.coalesce(F.floor(F.col("turn") / F.lit(turns_per_block)), F.lit(-(1 << 62))))
            .withColumn("_masked", F.when(F.col("role") == "assistant",
                                          F.char_length("_text") + F.lit(len(CLOSE.rstrip("\n")))).otherwise(0)))
    key = ["conv_id", "speaker"]
    blocks = seen.groupBy(*key, "_block").agg(F.sum("_n").alias("_chars"), F.count(F.lit(1)).alias("_turns"))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(F.col("conv_id").alias("_c"), F.col("speaker").alias("_s"), F.col("_block").alias("_b"),
                           F.coalesce(F.sum("_chars").over(before), F.lit(0)).alias("_chars"),
                           F.coalesce(F.sum("_turns").over(before), F.lit(0)).alias("_turns"))
    inside = Window.partitionBy(*key, "_block").orderBy(F.col("turn").asc_nulls_first(), "_by", "_text")
    placed = (seen.join(starts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("speaker") == F.col("_s"))
                        & (F.col("_block") == F.col("_b")))
              .withColumn("seq", (F.col("_turns") + F.row_number().over(inside) - 1).cast("long"))
              .withColumn("end_at", (F.col("_chars") + F.sum("_n").over(
                  inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))).cast("long")))
    trained = F.col("role") == "assistant"
    return placed.select(
        "conv_id", "speaker", "turn", "seq", "role", "name", "rendered",
        (F.col("end_at") - F.col("_n")).alias("start_at"), "end_at",
        F.when(trained, F.col("end_at") - 1 - F.col("_masked")).otherwise(F.col("end_at")).cast("long").alias("mask_start"),
        F.when(trained, F.col("end_at") - 1).otherwise(F.col("end_at")).cast("long").alias("mask_end"))


def assemble(pieces: DataFrame) -> DataFrame:
    """(conv_id, speaker, rendered, masks): the pieces of each rendering in one row,
    masks as an array of [start, end) pairs. For dialogues that fit a model's window."""
    masks = F.filter(F.col("_p"), lambda p: p["mask_end"] > p["mask_start"])
    return (pieces.groupBy("conv_id", "speaker")
            .agg(F.sort_array(F.collect_list(F.struct("seq", "rendered", "mask_start", "mask_end"))).alias("_p"))
            .select("conv_id", "speaker",
                    F.concat_ws("", F.transform("_p", lambda p: p["rendered"])).alias("rendered"),
                    F.transform(masks, lambda p: F.array(p["mask_start"], p["mask_end"])).alias("masks")))


# DuckDB: the same rows from the table `conversations`.
ROTATE_SQL = r"""
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, COALESCE(NULLIF(trim(role), ''), 'unknown') AS by_, COALESCE(text, '') AS txt
  FROM conversations
), people AS (SELECT DISTINCT conv_id, by_ AS speaker FROM t WHERE by_ <> 'system'),
seen AS (
  SELECT t.conv_id, p.speaker, t.turn, t.by_, t.txt,
         CASE WHEN t.by_ = 'system' THEN 'system' WHEN t.by_ = p.speaker THEN 'assistant' ELSE 'user' END AS role,
         CASE WHEN t.by_ <> 'system' AND t.by_ <> p.speaker THEN t.by_ END AS name
  FROM t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), r AS (
  SELECT *, '<|im_start|>' || role || COALESCE(' name=' || name, '') || chr(10) || txt || '<|im_end|>' || chr(10) AS rendered
  FROM seen
), w AS (
  SELECT *, CAST(row_number() OVER o - 1 AS BIGINT) AS seq,
         CAST(sum(length(rendered)) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_at
  FROM r WINDOW o AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, by_, txt)
)
SELECT conv_id, speaker, turn, seq, role, name, rendered, end_at - length(rendered) AS start_at, end_at,
       CASE WHEN role = 'assistant' THEN end_at - 1 - length(txt) - 10 ELSE end_at END AS mask_start,
       CASE WHEN role = 'assistant' THEN end_at - 1 ELSE end_at END AS mask_end
FROM w
"""
