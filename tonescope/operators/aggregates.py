"""Tone sums, counts and means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_sum
from .fanout import unordered


def _sum(tone: str, exact: bool) -> Column:
    return (exact_sum(F.col(tone)) if exact else F.sum(tone)).alias("tone_sum")


def windowed_sum(events: DataFrame, time: Column, key: str, tone: str, size: str = "1 day",
                 exact: bool = False) -> DataFrame:
    """Tone sum per key and tumbling window of an instant or a wall-clock time. An ``exact`` one does
    not depend on the order in which tasks add the rows."""
    return (events.groupBy(F.window(time, size).alias("span"), F.col(key))
            .agg(_sum(tone, exact)))


def count_and_sum(events: DataFrame, keys: Sequence[str | Column], tone: str,
                  exact: bool = False) -> DataFrame:
    """The mergeable pair every mean is made of."""
    return events.groupBy(*keys).agg(F.count(tone).alias("n"), _sum(tone, exact))


def pair_count_and_sum(events: DataFrame, keys: Sequence[str | Column], first: str, second: str,
                       tone: str, exact: bool = False) -> DataFrame:
    """Count and sum per unordered pair, as they hold for each of its directions.

    Every event counts in both directions, so both always agree: aggregating one of them halves
    the rows, the shuffle and a stream's state. ``directed`` adds the other direction to the far
    smaller result. On a self-pair both directions fall on one key and count twice.
    """
    sums = count_and_sum(unordered(events, first, second), [*keys, first, second], tone, exact)
    times = F.when(F.col(first) == F.col(second), 2).otherwise(1)
    return sums.withColumns({"n": F.col("n") * times, "tone_sum": F.col("tone_sum") * times})


def mean_tone() -> Column:
    return F.col("tone_sum") / F.col("n")
