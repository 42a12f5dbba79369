"""Render dialogues once per participant, with that speaker as the assistant.

Every participant (each role but the system's) gets the whole dialogue: own turns as ``assistant``, the others' as
``user`` with their name, system turns as ``system``. The result has one row per turn and perspective, so a dialogue of
any length is dealt over tasks; the mask is the span of a turn's text that is learnt, empty for turns of others. ``position`` orders the
turns of a rendering, ``starts_at`` is where a turn starts in the rendered dialogue, and ``learn_from`` and ``learn_to`` are its mask there.
Both come from prefix sums over sorted ranges, so one very long dialogue is not one task.

Defined cases: a null text is empty, a null role is the speaker ``unknown``; equal turn numbers are ordered by role and text, repeated rows
stay; turns without a conversation number form one dialogue; a dialogue of system turns only has no participant
and no rendering; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrove.llm.mixing import ranges, with_sums_ahead

SYSTEM = "system"
UNKNOWN = "unknown"
OPEN, CLOSE, STOP = "<|", "|>", "<|end|>"


def header(role: Column, name: Column) -> Column:
    """Start of a rendered turn; only users carry a name."""
    named = F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(F.lit(""))
    return F.concat(F.lit(OPEN), role, named, F.lit(CLOSE + "\n"))


def turns(df: DataFrame) -> DataFrame:
    """``conv_id, turn, speaker, content`` with nulls replaced."""
    return df.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("content"),
    )


def rendered_turns(df: DataFrame) -> DataFrame:
    """One row per turn and participant: ``conv_id, perspective, turn, speaker, role, name, rendered, mask_start, mask_end``.

    The participants of a dialogue are a short list made by a grouped set, summed in every task first; a dialogue
    with very many turns meets that one list, and Spark's handling of skewed joins splits its rows.
    """
    said = turns(df)
    people = said.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    both = said.withColumnRenamed("conv_id", "_c").join(people, F.col("_c").eqNullSafe(F.col("conv_id"))).drop("_c")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    name = F.when(~own & (F.col("speaker") != SYSTEM), F.col("speaker"))
    parts = both.withColumns({"role": role, "name": name})
    head = header(F.col("role"), F.col("name"))
    start = F.length(head)
    learnt = F.col("role") == "assistant"
    return parts.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        "role",
        "name",
        F.concat(head, F.col("content"), F.lit(STOP + "\n")).alias("rendered"),
        F.when(learnt, start).otherwise(0).cast("long").alias("mask_start"),
        F.when(learnt, start + F.length("content") + len(STOP)).otherwise(0).cast("long").alias("mask_end"),
    )


def perspectives(df: DataFrame) -> DataFrame:
    """``rendered_turns`` with ``position``, ``starts_at``, ``learn_from`` and ``learn_to``: places in the rendered dialogue."""
    order = ["turn", "speaker", "rendered"]
    dialogue = ["_none", "_conv", "perspective"]
    rows = rendered_turns(df).withColumns(
        {
            "_none": F.col("conv_id").isNull(), "_conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
            "_one": F.lit(1), "_size": F.length("rendered").cast("long"),
        }
    )
    placed = with_sums_ahead(ranges(rows, [*dialogue, *order], "turns"), dialogue, order, ["_one", "_size"])
    learnt = F.col("mask_end") > 0
    return placed.withColumns(
        {
            "position": F.col("ahead__one").cast("long"),
            "starts_at": F.col("ahead__size").cast("long"),
            "learn_from": F.when(learnt, F.col("ahead__size") + F.col("mask_start")).otherwise(0).cast("long"),
            "learn_to": F.when(learnt, F.col("ahead__size") + F.col("mask_end")).otherwise(0).cast("long"),
        }
    ).drop("_none", "_conv", "_one", "_size", "part", "ahead__one", "ahead__size")


def dialogues(rendered: DataFrame) -> DataFrame:
    """``conv_id, perspective, text, masks`` from ``perspectives``: renderings put together, for dialogues that fit a row."""
    turn = F.struct("position", "rendered", "learn_from", "learn_to")
    rows = rendered.groupBy("conv_id", "perspective").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    masks = F.transform(
        F.filter("turns", lambda t: t["learn_to"] > 0), lambda t: F.struct(t["learn_from"].alias("start"), t["learn_to"].alias("stop"))
    )
    return rows.select("conv_id", "perspective", F.array_join(F.col("turns")["rendered"], "").alias("text"), masks.alias("masks"))


SQL = """
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
parts AS (
  SELECT p.conv_id, p.perspective, s.turn, s.speaker, s.content,
    CASE WHEN s.speaker = p.perspective THEN 'assistant' WHEN s.speaker = 'system' THEN 'system' ELSE 'user' END AS role,
    CASE WHEN s.speaker NOT IN (p.perspective, 'system') THEN s.speaker END AS name
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
heads AS (SELECT *, '<|' || role || coalesce(' name=' || name, '') || '|>' || chr(10) AS head FROM parts),
turns AS (
  SELECT conv_id, perspective, turn, speaker, role, name, head || content || '<|end|>' || chr(10) AS rendered,
    CASE WHEN role = 'assistant' THEN length(head) ELSE 0 END AS mask_start,
    CASE WHEN role = 'assistant' THEN length(head) + length(content) + 7 ELSE 0 END AS mask_end
  FROM heads),
placed AS (
  SELECT *, row_number() OVER so_far - 1 AS position, sum(length(rendered)) OVER so_far - length(rendered) AS starts_at FROM turns
  WINDOW so_far AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, rendered ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, turn, speaker, role, name, rendered, mask_start, mask_end, position, starts_at::BIGINT AS starts_at,
  CASE WHEN mask_end > 0 THEN starts_at + mask_start ELSE 0 END::BIGINT AS learn_from,
  CASE WHEN mask_end > 0 THEN starts_at + mask_end ELSE 0 END::BIGINT AS learn_to
FROM placed
"""
