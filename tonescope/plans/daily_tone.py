"""Daily tone sum of one actor country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import windowed_sum
from ..operators.selection import of_country, with_tone
from ..sources.layout import ADDED, COUNTRY, TONE


def daily_tone_sum(events: DataFrame, country: str = "USA", *, key: str = COUNTRY,
                   time: str = ADDED, tone: str = TONE, size: str = "1 day",
                   exact: bool = False) -> DataFrame:
    """``key, tone_sum, window_start, window_end`` per non-empty window of wall-clock time. ``exact``
    here and in the other plans: bit-equal sums, however the feed is partitioned."""
    chosen = with_tone(of_country(events, country, key), tone)
    sums = windowed_sum(chosen, F.col(time).cast("timestamp_ntz"), key, tone, size, exact)
    return sums.select(key, "tone_sum", F.col("span.start").alias("window_start"),
                       F.col("span.end").alias("window_end"))
