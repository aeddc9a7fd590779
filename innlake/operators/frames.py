"""Assembly of control-message frames (START, rows, END) from an ordered log.

The log of one topic partition may hold most of all messages, so no window ever
spans it. Messages are cut into blocks of consecutive offsets; windows run
inside a block, and only one summary row per block is ordered along the whole
partition to carry the open frame across block borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "START", "END"
BLOCK_SPAN = 1_000_000
_START, _END = 1, 2


def _word(code: Column) -> Column:
    return F.when(code == _START, START).when(code == _END, END)


def tag_frames(messages: DataFrame, block_span: int = BLOCK_SPAN) -> DataFrame:
    """Add the position of every message relative to the control messages.

    messages: topic, partition, offset, value (string), offsets unique per
    (topic, partition). Added columns:
      control       START / END for control messages, else NULL
      frame_id      number of STARTs up to here (0 before the first)
      prev_control  last control message up to here
      next_control  next control message after here
      n_emissions   ENDs after here and before the next START
    """
    log = ["topic", "partition"]
    block = log + ["block"]
    # Controls as numbers: aggregates over them stay hash-based.
    blocks = messages.withColumns({
        "control": F.when(F.col("value") == START, _START).when(F.col("value") == END, _END),
        "block": F.expr(f"offset div {int(block_span)}"),
    })
    upto = Window.partitionBy(*block).orderBy("offset").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # Looking ahead is a look back over the descending order: linear, where a
    # frame that ends in "unbounded following" would be quadratic.
    ahead = Window.partitionBy(*block).orderBy(F.desc("offset")).rowsBetween(
        Window.unboundedPreceding, -1)
    is_start, is_end = F.col("control") == _START, F.col("control") == _END
    local = (
        blocks
        .withColumns({
            "starts_in": F.count_if(is_start).over(upto),
            "ends_in": F.count_if(is_end).over(upto),
            "prev_in": F.last("control", ignorenulls=True).over(upto),
        })
        .withColumns({
            "next_in": F.last("control", ignorenulls=True).over(ahead),
            "ends_at_next_start_in": F.last(
                F.when(is_start, F.col("ends_in")), ignorenulls=True).over(ahead),
        })
    )
    summary = local.groupBy(*block).agg(
        F.count_if(is_start).alias("starts"), F.count_if(is_end).alias("ends"),
        F.min_by("control", F.when(F.col("control").isNotNull(), F.col("offset"))).alias("first_control"),
        F.max_by("control", F.when(F.col("control").isNotNull(), F.col("offset"))).alias("last_control"),
        F.min(F.when(is_start, F.col("ends_in"))).alias("ends_at_first_start"),
    )
    before = Window.partitionBy(*log).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*log).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary
        .withColumns({
            "starts_before": F.coalesce(F.sum("starts").over(before), F.lit(0)),
            "ends_before": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            "prev_block_control": F.last("last_control", ignorenulls=True).over(before),
        })
        .withColumns({
            "next_block_control": F.last("first_control", ignorenulls=True).over(after),
            "ends_at_next_block_start": F.last(
                F.col("ends_before") + F.col("ends_at_first_start"), ignorenulls=True).over(after),
            # ENDs of this block and the later ones, on top of those before.
            "ends_total": F.col("ends_before") + F.col("ends")
            + F.coalesce(F.sum("ends").over(after), F.lit(0)),
        })
        .select(*block, "starts_before", "ends_before", "prev_block_control",
                "next_block_control", "ends_at_next_block_start", "ends_total")
    )
    ends_upto = F.col("ends_before") + F.col("ends_in")
    ends_at_reset = F.coalesce(
        F.col("ends_before") + F.col("ends_at_next_start_in"),
        F.col("ends_at_next_block_start"), F.col("ends_total"))
    return local.join(carried, block).select(
        *messages.columns, _word(F.col("control")).alias("control"),
        (F.col("starts_before") + F.col("starts_in")).alias("frame_id"),
        _word(F.coalesce("prev_in", "prev_block_control")).alias("prev_control"),
        _word(F.coalesce("next_in", "next_block_control")).alias("next_control"),
        (ends_at_reset - ends_upto).alias("n_emissions"),
    )


def frame_messages(
    messages: DataFrame, strict: bool = True, block_span: int = BLOCK_SPAN,
) -> DataFrame:
    """Data messages with the frame they belong to.

    strict: only rows between a START and the END that directly follows it.
    Otherwise every row an END hands over: END does not reset the buffer, rows
    before the first START form frame 0, and n_emissions says how many ENDs
    hand the row over.
    """
    tagged = tag_frames(messages, block_span)
    data = tagged.filter(F.col("control").isNull())
    if strict:
        kept = data.filter((F.col("prev_control") == START) & (F.col("next_control") == END))
        return kept.select(*messages.columns, "frame_id")
    return data.filter("n_emissions > 0").select(*messages.columns, "frame_id", "n_emissions")
