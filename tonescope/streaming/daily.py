"""Daily tone sum of one country, each day emitted once when the watermark passes its end."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import instant, wall_clock
from ..operators.aggregates import windowed_sum
from ..operators.selection import of_country, with_tone
from ..sources.layout import ADDED, COUNTRY, TONE


def daily_tone_stream(events: DataFrame | Sequence[DataFrame], country: str = "USA", *,
                      key: str = COUNTRY, time: str = ADDED, tone: str = TONE, size: str = "1 day",
                      delay: str = "0 seconds") -> DataFrame:
    """The rows of ``daily_tone_sum`` for append mode.

    The watermark follows the rows of the country, ``delay`` behind the latest. Later rows of a
    closed window are dropped. A stream cannot know that a feed has ended, so the last window stays
    open; the batch plan has it.

    Of several feeds (streams with equal columns) each has a watermark of its own, and windows close by
    the slowest: as long as ``spark.sql.streaming.multipleWatermarkPolicy`` is ``min``, its default, no
    feed loses rows to a faster one. A feed that brings nothing holds all windows open.
    """
    feeds = [events] if isinstance(events, DataFrame) else list(events)
    timed = [_timed(feed, country, key, time, tone, delay) for feed in feeds]
    sums = windowed_sum(reduce(DataFrame.unionByName, timed), F.col("at"), key, "tone", size)
    return sums.select(key, "tone_sum", wall_clock(F.col("span.start")).alias("window_start"),
                       wall_clock(F.col("span.end")).alias("window_end"))


def _timed(events: DataFrame, country: str, key: str, time: str, tone: str, delay: str) -> DataFrame:
    chosen = with_tone(of_country(events, country, key), tone)
    timed = chosen.select(key, F.col(tone).alias("tone"), instant(F.col(time)).alias("at"))
    return timed.withWatermark("at", delay)
