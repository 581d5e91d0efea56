"""Chat formatting: each participant in turn is the assistant.

For every participant of a conversation the whole dialogue is rendered with that speaker's turns as
the assistant's and all others' as named users'. A row is one segment of one rendering: its
text, its place among the segments, where it starts and stops in the rendering (in characters), and
whether it is trained on (`train`; for a trained segment `mask_start` to `mask_stop` is the
speaker's own text with its end mark, without the header). The segments in order, joined, are the
rendering, so a conversation of any length is spread over many tasks.

Rows are sorted over the whole table, so one long conversation is split like any other rows. A
running length is summed within a partition, and what earlier partitions hold of the same
rendering, at most one row per partition, is added.

Defined cases: a null turn comes first; equal turns are ordered by role, then by text; repeated
rows are turns of their own. A null text is empty. A null role is a user named `unknown` and no
participant. A conversation without participants gives no rows. A null conversation is one like others.
`<|` in names and texts becomes `< |`, so no text can pass for a mark. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.surrogate import place_in_order
from dimflow.sources.staging import stage

ASSISTANT = "<|assistant|>\n"
USER = "<|user name={}|>\n"
END = "<|end|>\n"
UNKNOWN = "unknown"
_POSITION_BITS = 33


def _harmless(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, perspective, position, turn, role, segment, start, stop, train, mask_start, mask_stop)."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(conv_col).alias("c")).alias("_conv"),  # equal also where null
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    speakers = rows.filter("role is not null").select("_conv", F.col("role").alias("perspective")).distinct()
    own = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    before, after = USER.split("{}")
    name = F.concat(F.lit(before), _harmless(F.coalesce("role", F.lit(UNKNOWN))), F.lit(after))
    header = F.when(own, F.lit(ASSISTANT)).otherwise(name)
    # The turns of a long conversation are split by the join: speakers are read from a written table.
    segments = rows.join(stage(speakers), "_conv").select(
        "conv_id", "perspective", "turn", "role", own.alias("train"),
        F.length(header).alias("_header"),
        F.concat(header, _harmless(F.col("_text")), F.lit(END)).alias("segment"),
    )
    order = [
        F.col("conv_id").asc_nulls_first(), F.col("perspective"), F.col("turn").asc_nulls_first(),
        F.col("role").asc_nulls_first(), F.col("segment"),
    ]
    placed = place_in_order(segments, order)
    placed = placed.withColumn("_part", F.shiftright("_spot", _POSITION_BITS))
    group = ["conv_id", "perspective"]
    piece = placed.groupBy("_part", *group).agg(
        F.sum(F.length("segment")).alias("chars"), F.count(F.lit(1)).alias("rows")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first rendering of a partition can go on from earlier ones: one row per partition.
    carried = piece.select(
        F.col("_part").alias("_p"), F.struct(*group).alias("_g"),
        F.sum("chars").over(earlier).alias("_chars"), F.sum("rows").over(earlier).alias("_rows"),
    ).filter("_rows is not null")
    up_to = Window.partitionBy("_part", *group).orderBy("_spot").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("segment").cast("bigint")
    summed = placed.select(
        "*", F.sum(size).over(up_to).alias("_end"), F.row_number().over(up_to).alias("_number")
    )
    here = (F.col("_part") == F.col("_p")) & (F.struct(*group) == F.col("_g"))
    summed = summed.join(F.broadcast(carried), here, "left")
    stop = F.col("_end") + F.coalesce("_chars", F.lit(0))
    out = summed.select(
        *group,
        (F.col("_number") - 1 + F.coalesce("_rows", F.lit(0))).cast("bigint").alias("position"),
        "turn", "role", "segment", (stop - size).alias("start"), stop.alias("stop"), "train", "_header",
    )
    return out.select(
        "*",
        F.when(F.col("train"), F.col("start") + F.col("_header")).alias("mask_start"),
        F.when(F.col("train"), F.col("stop") - 1).alias("mask_stop"),
    ).drop("_header")
