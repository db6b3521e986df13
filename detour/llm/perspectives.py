"""Multi-party perspective rotation: every participant's view of a dialogue.

For each participant the dialogue is rendered with that speaker as the assistant, whose
turns are trained on, and all others as named users; system turns stay system turns in every view.
One row holds one turn of one view: its text in chat markup and where it stands in the
rendered dialogue, so that a conversation of any length needs no row of its own size. The
view is the concatenation of its segments by ``position``.

Texts and names can't forge turns: a control mark in them (``<|im_start|>``, ``<|im_end|>``) is rendered with a blank after its
``<|``, and a line break in a name as a blank. Speakers are told apart by their names as given.

Turns are ordered by (turn, role, text), nulls first; turns that are equal in all three keep any order. A null
role speaks as ``unknown``; a null text is empty; a null conv_id is a conversation like
others; conversations without a participant (system turns only) have no view; repeated
rows are repeated turns; an empty table gives no rows; other columns aren't carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.llm import common

CONTEXT_ROLES = ("system",)
UNKNOWN = "unknown"


def _plain(text: Column) -> Column:
    """Without control marks."""
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def _header(role: Column, perspective: Column, context: Column) -> Column:
    name = F.translate(_plain(role), "\r\n", "  ")
    return (F.when(context, F.concat(F.lit("<|im_start|>"), name, F.lit("\n")))
            .when(role == perspective, F.lit("<|im_start|>assistant\n"))
            .otherwise(F.concat(F.lit("<|im_start|>user name="), name, F.lit("\n"))))


def rotate(turns: DataFrame, context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """(conv_id, perspective, position, turn, role, rendered_role, segment, start, trained_start, trained_end):
    ``start`` is the segment's first character in the view; the characters
    [trained_start, trained_end) of the view are learned (null: none of the segment)."""
    context, own = F.col("role").isin(*context_roles), F.col("role") == F.col("perspective")
    said = turns.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("role"), common.text_or_empty().alias("text"))
    people = said.where(~context).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    header = _header(F.col("role"), F.col("perspective"), context)
    body_text = _plain(F.col("text"))
    segment = F.concat(header, body_text, F.lit("<|im_end|>\n"))
    views = said.join(people, F.col("conv_id").eqNullSafe(F.col("of")), "inner").drop("of").withColumn("row", F.monotonically_increasing_id())
    group = ["conv_id", "perspective"]
    order = [*group, "turn", "role", "text", "row"]
    dealt = common.ranged(views, order, common.scratch(turns.sparkSession, "perspectives"))
    placed = common.prefix_sums(dealt, order, {"position": F.lit(1).cast("long"), "start": F.length(segment).cast("long")}, group)
    body = F.when(own, F.col("start") + F.length(header))
    return placed.select(
        "conv_id", "perspective", "position", "turn", "role",
        F.when(context, F.col("role")).when(own, F.lit("assistant")).otherwise(F.lit("user")).alias("rendered_role"),
        segment.alias("segment"), "start", body.alias("trained_start"),
        (body + F.length(F.concat(body_text, F.lit("<|im_end|>")))).alias("trained_end"))
