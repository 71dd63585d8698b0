"""Chat formatting: every dialogue once for each participant, with that participant as assistant.

All other participants are users under their own names; system turns stay system turns. A mask gives
the characters that the assistant wrote, in code points of the rendered text.

A dialogue is rendered in parts of a fixed range of turn numbers, so one long conversation is many
rows in many tasks; the parts, in order, are the dialogue. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 256
FIXED_ROLES = ("system",)
UNKNOWN = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    """Text in which nothing reads as a marker; missing text is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame, fixed_roles: tuple[str, ...] = FIXED_ROLES,
                 part_turns: int = PART_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, perspective, part, n_turns, rendered, mask; one row for each part of each view.

    ``perspective`` is the participant shown as assistant, ``mask`` its ``start:end`` ranges in the
    part, comma-joined. Turns come by number, then by role and text; repeated turns are all kept.
    Missing conversation ids are one conversation, missing turn numbers come first in part -1,
    missing roles are one participant, "unknown". A conversation of fixed roles alone has no view.
    An empty table gives no rows. Other columns are not read.
    """
    speaker = F.coalesce(F.col(role_col), F.lit(UNKNOWN))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        _plain(speaker).alias("speaker"), _plain(F.col(text_col)).alias("said"),
        speaker.isin(*fixed_roles).alias("fixed"),
        F.coalesce(F.floor(F.col(turn_col) / part_turns), F.lit(-1)).alias("part"))
    views = (rows.filter(~F.col("fixed")).select(F.col("conv_id").alias("view_conv"),
                                                 F.col("speaker").alias("perspective")).distinct())
    seen = rows.join(views, rows["conv_id"].eqNullSafe(views["view_conv"])).drop("view_conv")
    own = ~F.col("fixed") & (F.col("speaker") == F.col("perspective"))
    head = F.concat(
        F.lit(OPEN), F.when(F.col("fixed"), F.col("speaker")).when(own, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.col("speaker"))), F.lit("\n"))
    segment = F.struct("turn", "speaker", "said", head.alias("head"), own.alias("own"))
    grouped = seen.groupBy("conv_id", "perspective", "part").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list(segment)).alias("segments"))

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + F.length(s["head"])
        end = start + F.length(s["said"]) + len(CLOSE)
        spans = F.when(s["own"], F.concat(state["spans"], F.array(
            F.concat_ws(":", start.cast("string"), end.cast("string"))))).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return grouped.select(
        "conv_id", "perspective", "part", "n_turns",
        F.array_join(F.transform("segments", lambda s: F.concat(
            s["head"], s["said"], F.lit(CLOSE + "\n"))), "").alias("rendered"),
        F.array_join(F.aggregate("segments", begin, step, lambda state: state["spans"]),
                     ",").alias("mask"))


PERSPECTIVES_SQL = """
WITH rows AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS said,
         coalesce(role, 'unknown') = 'system' AS fixed,
         CAST(coalesce(floor(turn / 256.0), -1) AS BIGINT) AS part
  FROM conversations),
views AS (SELECT DISTINCT conv_id, speaker AS perspective FROM rows WHERE NOT fixed),
seen AS (
  SELECT r.*, v.perspective, NOT r.fixed AND r.speaker = v.perspective AS own,
         '<|im_start|>' || CASE WHEN r.fixed THEN r.speaker
                                WHEN r.speaker = v.perspective THEN 'assistant'
                                ELSE 'user name=' || r.speaker END || chr(10) AS head
  FROM rows r JOIN views v ON r.conv_id IS NOT DISTINCT FROM v.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(said) + 11) OVER (
           PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, speaker, said
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM seen)
SELECT conv_id, perspective, part, count(*) AS n_turns,
       string_agg(head || said || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, speaker, said) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(before + length(head) AS BIGINT) || ':'
                  || CAST(before + length(head) + length(said) + 10 AS BIGINT) END, ','
                  ORDER BY turn NULLS FIRST, speaker, said), '') AS mask
FROM placed GROUP BY conv_id, perspective, part
"""
