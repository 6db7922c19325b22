"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as
``assistant``; all others become ``user`` with their names, ``system`` turns stay system
turns.  One row per (conversation, perspective, turn) carries the rendered segment, its character
offset in that rendering and its loss mask: [mask_start, mask_end) are the characters of the dialogue
that the perspective's speaker wrote.  The segments of a perspective, in the order of ``offset``, are the
whole rendering without gaps; they stay rows so that a conversation of any length is never gathered
in one value or task.  Offsets come from two levels of sums: within blocks of ``BLOCK`` turn numbers, and
over the blocks of a perspective.

Control strings in texts and role names are broken up (``<|im_`` becomes ``<| im_``), and line ends in names
become spaces, so no turn can open or close another one; ``perspective`` and ``role`` keep the names as they are.

Results for odd rows: a null role is the participant ``unknown``, a null text is empty, a null
turn comes first; turns equal in number are ordered by role and text, and repeated rows are rendered each;
conversations with system turns only have no participant and no rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256
SYSTEM = "system"


def plain(c: Column) -> Column:
    """Text without control strings."""
    return F.replace(c, F.lit("<|im_"), F.lit("<| im_"))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
                     plain(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    t = t.withColumn("__block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-2 ** 62)))
    # pre-aggregated map-side: one row per speaker of a conversation
    speakers = (t.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("__conv"),
                                                         F.col("role").alias("perspective")).distinct())
    j = t.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    own = F.col("role") == F.col("perspective")
    head = F.when(own, F.lit("<|im_start|>assistant\n")).when(
        F.col("role") == SYSTEM, F.lit("<|im_start|>system\n")).otherwise(
        F.concat(F.lit("<|im_start|>user name="), plain(F.translate("role", "\r\n", "  ")), F.lit("\n")))
    j = (j.withColumn("__head", head).withColumn("segment", F.concat("__head", "text", F.lit("<|im_end|>\n")))
         .withColumn("__chars", F.length("segment").cast("long")))
    keys = ["conv_id", "perspective"]
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    inside = Window.partitionBy(*keys, "__block").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (j.groupBy(*keys, "__block").agg(F.sum("__chars").alias("__size"), F.count(F.lit(1)).alias("__rows")))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("__c"), F.col("perspective").alias("__p"), F.col("__block").alias("__b"),
                           F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__ahead"),
                           F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_ahead"))
    placed = (j.withColumn("__in", F.coalesce(F.sum("__chars").over(before), F.lit(0)))
              .withColumn("__row", F.row_number().over(inside) - 1)
              .join(blocks, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("perspective") == F.col("__p"))
                    & (F.col("__block") == F.col("__b"))))
    offset = (F.col("__in") + F.col("__ahead"))
    start = offset + F.length("__head")
    return placed.select(
        "conv_id", "perspective", (F.col("__row") + F.col("__rows_ahead")).cast("long").alias("position"),
        "turn", "role", "segment", offset.cast("long").alias("offset"), own.alias("trained"),
        F.when(own, start).cast("long").alias("mask_start"),
        F.when(own, start + F.length("text") + len("<|im_end|>")).cast("long").alias("mask_end"))


SQL = """
    WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|im_', '<| im_') AS text
              FROM conversations),
    s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
    j AS (SELECT t.*, s.perspective, role = perspective AS own,
                 CASE WHEN role = perspective THEN '<|im_start|>assistant' || chr(10)
                      WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
                      ELSE '<|im_start|>user name=' || replace(translate(role, chr(13) || chr(10), '  '), '<|im_', '<| im_') || chr(10) END AS head
          FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
    r AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM j),
    o AS (SELECT *, row_number() OVER w - 1 AS position,
                 coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
          FROM r WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, perspective, position, turn, role, segment, CAST(place AS BIGINT) AS "offset", own AS trained,
           CASE WHEN own THEN CAST(place + length(head) AS BIGINT) END AS mask_start,
           CASE WHEN own THEN CAST(place + length(head) + length(text) + 10 AS BIGINT) END AS mask_end
    FROM o"""
