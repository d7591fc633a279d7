"""Which rows of numbered micro-batches a watermark would drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Batches per block of the running maximum.
BLOCK = 1024


def mark_late(events: DataFrame, time: str, batch: str, size: str = "1 day",
              delay: str = "0 seconds") -> DataFrame:
    """Add ``late``: the row's window of ``size`` closed before its batch came.

    A stream drops a row of batch N when the window of the row ends at or before the watermark
    that held before batch N - 1 was read: the latest time of batches up to N - 2, less ``delay``.
    Both durations must be exact (days or shorter). ``time`` is wall-clock time; rows without one
    are left out, as they have no window.
    """
    end = F.window(F.col(time), size)["end"]
    late = end <= F.col("_watermark") - F.expr(f"interval {delay}")
    return (events.join(_watermarks(events, time, batch), batch, "left")
            .withColumn("late", F.coalesce(late, F.lit(False)))
            .drop("_watermark"))


def _watermarks(events: DataFrame, time: str, batch: str) -> DataFrame:
    """Per batch, the latest time among the batches at least two before it.

    A running maximum in two steps, within blocks of batches and over the blocks, so that a task
    meets the batches of one block, or one row per block.
    """
    latest = events.groupBy(batch).agg(F.max(time).alias("_latest"))
    # A batch's time counts from two batches later on; the batch asks at its own number.
    counts = F.struct((F.col(batch) + 2).alias("_at"), F.col("_latest"), F.lit(False).alias("_asks"))
    asks = F.struct(F.col(batch).alias("_at"), F.nullif("_latest", "_latest").alias("_latest"),
                    F.lit(True).alias("_asks"))
    steps = latest.select(F.inline(F.array(counts, asks))).withColumn(
        "_block", F.floor(F.col("_at") / BLOCK))

    up_to_here = Window.partitionBy("_block").orderBy("_at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    blocks_before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (steps.groupBy("_block").agg(F.max("_latest").alias("_block_latest"))
              .withColumn("_before", F.max("_block_latest").over(blocks_before))
              .drop("_block_latest"))
    return (steps.withColumn("_here", F.max("_latest").over(up_to_here))
            .where("_asks").join(blocks, "_block")
            .select(F.col("_at").alias(batch),
                    F.greatest("_here", "_before").alias("_watermark")))
