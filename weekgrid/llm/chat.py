"""Perspective rotation of many-party dialogues.

For every participant a dialogue is rendered once with that speaker as
``assistant`` and all others as named users, and the mask lists the character
spans that the assistant says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weekgrid.llm.common import table
from weekgrid.llm.order import ranked

PART = 1024


def rotate(
    turns: DataFrame, part_turns: int = PART, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per dialogue, perspective and part. The rows of a dialogue are numbered
    from 0 by turn, role and text; a part holds those from ``part * part_turns`` on,
    ``part_turns`` at most, so that neither a very long dialogue nor many rows of one
    turn ever meet in one group. ``start`` is where the part begins in the whole
    rendering; ``mask`` has its own spans as start:end in code points.

    Lines are ``name: text`` and a line feed; the span is the text alone. A null
    text is empty. A null or empty role is the speaker ``unknown``. A null
    conversation is a dialogue of its own, null turns come first. Every row is a
    line, also where it repeats another one. An empty table gives no rows.
    """
    role = F.when(F.trim(F.coalesce(role_col, F.lit(""))) == "", "unknown").otherwise(F.col(role_col))
    said = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    said = ranked(said, ["conv_id"], ["turn", "role", "text", "row"], "turns")
    parts = said.groupBy("conv_id", F.floor(F.col("rank") / part_turns).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "role", "text"))).alias("turns")
    )
    speakers = said.groupBy("conv_id", "role").agg(F.lit(1).alias("one")).select(
        F.col("conv_id").alias("of"), F.col("role").alias("perspective")
    )
    each = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    def line(x):
        name = F.when(x["role"] == F.col("perspective"), F.lit("assistant")).otherwise(F.concat(F.lit("user "), x["role"]))
        return F.struct((x["role"] == F.col("perspective")).alias("own"), F.concat(name, F.lit(": ")).alias("head"), x["text"].alias("text"))

    def add(state, x):
        begin = state["at"] + F.length(x["head"])
        end = begin + F.length(x["text"])
        span = F.struct(begin.cast("long").alias("a"), end.cast("long").alias("b"))
        return F.struct(
            (end + 1).cast("long").alias("at"),
            F.when(x["own"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    lines = each.withColumn("lines", F.transform("turns", line))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)").alias("spans"))
    walked = lines.withColumn("walk", F.aggregate("lines", empty, add))
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rendered = F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["text"], F.lit("\n"))), "")
    mask = F.array_join(F.transform("walk.spans", lambda s: F.concat_ws(":", s["a"], s["b"])), ",")
    return walked.select(
        "conv_id", "perspective", "part", F.coalesce(F.sum("walk.at").over(before), F.lit(0)).alias("start"),
        F.size("turns").cast("long").alias("n_turns"), F.size("walk.spans").cast("long").alias("n_masked"),
        rendered.alias("rendered"), mask.alias("mask"),
    )


ORACLE_SQL = """
WITH rows AS (
  SELECT conv_id, turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE role END AS role, coalesce(text, '') AS text
  FROM conversations),
said AS (
  SELECT *, rank // 1024 AS part
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS rank FROM rows)),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM said),
lines AS (
  SELECT s.conv_id, p.perspective, s.part, s.rank, s.role, s.text, s.role = p.perspective AS own,
         CASE WHEN s.role = p.perspective THEN 'assistant' ELSE 'user ' || s.role END || ': ' AS head
  FROM said s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(text) + 1) OVER w - length(text) - 1 AS a
  FROM lines
  WINDOW w AS (PARTITION BY conv_id, perspective, part ORDER BY rank ROWS UNBOUNDED PRECEDING)),
grouped AS (
  SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_masked,
         string_agg(head || text || chr(10), '' ORDER BY rank) AS rendered,
         coalesce(string_agg(CAST(a AS BIGINT) || ':' || CAST(a + length(text) AS BIGINT), ',' ORDER BY rank)
                  FILTER (WHERE own), '') AS mask
  FROM placed GROUP BY ALL)
SELECT conv_id, perspective, part,
       CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY part
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       n_turns, n_masked, rendered, mask
FROM grouped
"""


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))
