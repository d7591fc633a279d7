"""Weekly tone of one actor country: plain sums and the halving average over batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rendering import weekly_line
from ..functions.times import ISO, week_monday
from ..operators.aggregates import count_and_sum
from ..operators.halving import halving_average
from ..operators.selection import of_country, with_tone
from ..sources.layout import ADDED, COUNTRY, TONE


def country_weeks(events: DataFrame, country: str, key: str, time: str, tone: str,
                  week_start: str, *kept: str) -> DataFrame:
    """The rows of one country as ``week, tone`` (and ``kept`` columns)."""
    chosen = with_tone(of_country(events, country, key), tone)
    return chosen.select(week_monday(F.col(time), week_start).alias("week"),
                         F.col(tone).alias("tone"), *kept)


def weekly_tone_sum(events: DataFrame, country: str = "USA", *, key: str = COUNTRY,
                    time: str = ADDED, tone: str = TONE, week_start: str = ISO,
                    exact: bool = False) -> DataFrame:
    weeks = country_weeks(events, country, key, time, tone, week_start)
    return count_and_sum(weeks, ["week"], "tone", exact).drop("n")


def weekly_halving_average(events: DataFrame, batch: str, country: str = "USA", *,
                           key: str = COUNTRY, time: str = ADDED, tone: str = TONE,
                           week_start: str = ISO) -> DataFrame:
    """``week, batch, average`` after each batch that brought the week any tone.

    The value depends on the batches by definition, so their number is a column of ``events``.
    """
    weeks = country_weeks(events, country, key, time, tone, week_start, batch)
    sums = weeks.groupBy("week", batch).agg(F.sum("tone").alias("tone_sum"))
    return halving_average(sums, "week", batch, "tone_sum").drop("tone_sum")


def weekly_lines(averages: DataFrame, country: str = "USA", average: str = "average",
                 digits: int | None = None) -> DataFrame:
    line = weekly_line(F.lit(country), F.col("week"), F.col(average), digits)
    return averages.select(line.alias("value"))
