"""Weekly halving average of one country as running state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.times import ISO, instant
from ..operators.selection import of_country, with_tone
from ..plans.weekly_tone import country_weeks
from ..sources.layout import ADDED, COUNTRY, TONE


def weekly_halving_stream(events: DataFrame, country: str = "USA", *, key: str = COUNTRY,
                          time: str = ADDED, tone: str = TONE, week_start: str = ISO,
                          keep_open: str | None = None) -> DataFrame:
    """``week, average`` for update mode: half of (batch sum + previous average) of every week
    the micro-batch touched. State is one number per week.

    With ``keep_open`` a week's number is given up, and its later rows dropped, that long after its
    end; without it every week stays open. Rows without a time then belong to no week. Timers need the
    RocksDB state store, which ``build_session`` sets.
    """
    if keep_open is None:
        weeks = country_weeks(events, country, key, time, tone, week_start)
        return _sums_by_task(weeks).groupBy("week").applyInPandasWithState(
            _halve_without_end(), "week date, average double", "average double", "update",
            GroupStateTimeout.NoTimeout)
    timed = with_tone(of_country(events, country, key), tone).where(F.col(time).isNotNull())
    timed = timed.withColumn("_at", instant(F.col(time))).withWatermark("_at", keep_open)
    # The watermark follows the rows; what the state function reads has no time any more, so that
    # late rows of a week that is still open count.
    weeks = country_weeks(timed, country, key, time, tone, week_start)
    return _sums_by_task(weeks).groupBy("week").transformWithStateInPandas(
        _halving_until_closed(week_start), "week date, average double", "update", "eventTime")


# What runs in workers is nested in functions, so that they receive it and need not import this
# package.
def _sums_by_task(weeks: DataFrame) -> DataFrame:
    """``week, tone``: a row per week and task.

    A streaming aggregation cannot precede a stateful function in update mode. This does its part: a
    week sends one row per task through the shuffle, however many events it has.
    """
    def sums(batches):
        import pyarrow as pa
        totals = {}
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by("week").aggregate([("tone", "sum")])
            for week, total in zip(found["week"].to_pylist(), found["tone_sum"].to_pylist(), strict=True):
                totals[week] = totals.get(week, 0.0) + total
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(totals.keys(), pa.date32()), pa.array(totals.values(), pa.float64())],
                names=["week", "tone"])

    return weeks.mapInArrow(sums, "week date, tone double")


def _halve_without_end():
    def halve(week, parts, state):
        import pandas as pd
        total = sum(part["tone"].to_numpy().sum() for part in parts)
        previous, = state.get if state.exists else (0.0,)
        average = float((total + previous) / 2.0)
        state.update((average,))
        yield pd.DataFrame({"week": [week[0]], "average": [average]})
    return halve


def _halving_until_closed(week_start: str):
    from pyspark.sql.streaming import StatefulProcessor
    days = 7 if week_start == ISO else 6  # from the Monday that names a week to its end

    class Halving(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.average = handle.getValueState("average", "average double")

        def handleInputRows(self, key, rows, timerValues):
            import datetime

            import pandas as pd
            total = sum(part["tone"].to_numpy().sum() for part in rows)
            end = 86_400_000 * (key[0] - datetime.date(1970, 1, 1)).days + 86_400_000 * days
            if end <= timerValues.getCurrentWatermarkInMs():
                return
            if self.average.exists():
                previous, = self.average.get()
            else:
                previous = 0.0
                self.handle.registerTimer(end)
            average = float((total + previous) / 2.0)
            self.average.update((average,))
            yield pd.DataFrame({"week": [key[0]], "average": [average]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.average.clear()
            return iter(())

        def close(self):
            pass

    return Halving()
