"""Weekly relations of country pairs: their tone, and the actor types most often involved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rendering import number_text, pair_line, ranking_text
from ..functions.times import ISO, week_monday
from ..operators.aggregates import mean_tone, pair_count_and_sum
from ..operators.fanout import directed, each_type, unordered
from ..operators.selection import UNKNOWN, or_unknown, with_both, with_tone
from ..operators.topk import ranking_list, top_k
from ..sources.layout import ACTOR_TYPES, ADDED, PLACES, TONE

PAIR = ("c1", "c2")
GROUP = ("week", *PAIR)


def relation_rows(events: DataFrame, places: Sequence[str], time: str, tone: str,
                  types: Sequence[str] = (), week_start: str = ISO,
                  extra: Sequence[str] = ()) -> DataFrame:
    """``week, c1, c2, tone`` and the given further columns of every event with a tone and a time."""
    return with_tone(events, tone).where(F.col(time).isNotNull()).select(
        week_monday(F.col(time), week_start).alias("week"),
        F.col(places[0]).alias("c1"), F.col(places[1]).alias("c2"),
        F.col(tone).alias("tone"), *types, *extra)


def bilateral_tone(events: DataFrame, *, places: Sequence[str] = PLACES, time: str = ADDED,
                   tone: str = TONE, week_start: str = ISO, exact: bool = False) -> DataFrame:
    """``week, c1, c2, n, mean_tone`` of every ordered pair; events without both countries are
    skipped."""
    rows = with_both(relation_rows(events, places, time, tone, week_start=week_start), *PAIR)
    pairs = pair_count_and_sum(rows, ["week"], *PAIR, "tone", exact)
    return directed(pairs, *PAIR).select(*GROUP, "n", mean_tone().alias("mean_tone"))


def _type_sums(events, places, types, time, tone, week_start, unknown_label,
               exact=False) -> DataFrame:
    rows = relation_rows(events, places, time, tone, types, week_start)
    rows = each_type(or_unknown(rows, *PAIR, label=unknown_label), types)
    return pair_count_and_sum(rows, ["week", "actor_type"], *PAIR, "tone", exact)


def actor_type_stats(events: DataFrame, *, places: Sequence[str] = PLACES,
                     types: Sequence[str] = ACTOR_TYPES, time: str = ADDED, tone: str = TONE,
                     week_start: str = ISO, unknown_label: str = UNKNOWN,
                     exact: bool = False) -> DataFrame:
    """``week, c1, c2, actor_type, n, mean_tone``; a missing country is ``unknown_label``."""
    sums = _type_sums(events, places, types, time, tone, week_start, unknown_label,
                      exact)
    return directed(sums, *PAIR).select(*GROUP, "actor_type", "n",
                                        mean_tone().alias("mean_tone"))


def rank_types(sums: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent types of each unordered pair in ``week, c1, c2, actor_type, n,
    tone_sum`` rows, within each value of the ``by`` columns."""
    ranked = top_k(sums, [*by, *GROUP], "n", "actor_type", k)
    return ranked.select(*by, *GROUP, "actor_type", "n", mean_tone().alias("mean_tone"), "rank")


def actor_type_top(events: DataFrame, k: int = 5, *, places: Sequence[str] = PLACES,
                   types: Sequence[str] = ACTOR_TYPES, time: str = ADDED, tone: str = TONE,
                   week_start: str = ISO, unknown_label: str = UNKNOWN,
                   exact: bool = False) -> DataFrame:
    """``week, c1, c2, actor_type, n, mean_tone, rank``, one row per type among the top ``k``."""
    sums = _type_sums(events, places, types, time, tone, week_start, unknown_label,
                      exact)
    return directed(rank_types(sums, k), *PAIR).select(
        *GROUP, "actor_type", "n", "mean_tone", "rank")


def actor_type_top_list(events: DataFrame, k: int = 5, *, places: Sequence[str] = PLACES,
                        types: Sequence[str] = ACTOR_TYPES, time: str = ADDED, tone: str = TONE,
                        week_start: str = ISO, unknown_label: str = UNKNOWN,
                        exact: bool = False) -> DataFrame:
    """``week, c1, c2, ranking``: the top ``k`` as an array of (actor_type, n, mean_tone)."""
    sums = _type_sums(events, places, types, time, tone, week_start, unknown_label,
                      exact)
    return directed(type_lists(rank_types(sums, k)), *PAIR).select(*GROUP, "ranking")


def type_lists(ranked: DataFrame) -> DataFrame:
    return ranking_list(ranked, GROUP, ["actor_type", "n", "mean_tone"])


def actor_type_top_touched(events: DataFrame, batch: str, k: int = 5, *,
                           places: Sequence[str] = PLACES, types: Sequence[str] = ACTOR_TYPES,
                           time: str = ADDED, tone: str = TONE, week_start: str = ISO,
                           unknown_label: str = UNKNOWN) -> DataFrame:
    """What the running ranking shows after each numbered batch: counts so far, ranked among the
    types the batch brought."""
    rows = relation_rows(events, places, time, tone, types, week_start, extra=[batch])
    rows = unordered(or_unknown(rows, *PAIR, label=unknown_label), *PAIR)
    # Every batch has keys of its own, so the partial sums of rows as they come grow with the rows. Of
    # gathered pairs a task holds few keys; a pair of very many rows is split.
    rows = each_type(rows.hint("rebalance", *GROUP), types)
    sums = pair_count_and_sum(rows, [batch, "week", "actor_type"], *PAIR, "tone")
    so_far = (Window.partitionBy(*GROUP, "actor_type").orderBy(batch)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = sums.withColumns({"n": F.sum("n").over(so_far),
                                "tone_sum": F.sum("tone_sum").over(so_far)})
    return directed(rank_types(running, k, by=[batch]), *PAIR).select(
        batch, *GROUP, "actor_type", "n", "mean_tone", "rank")


def bilateral_lines(pairs: DataFrame, digits: int | None = None) -> DataFrame:
    text = number_text(F.col("mean_tone"), digits)
    return pairs.select(pair_line(F.col("week"), F.col("c1"), F.col("c2"), text).alias("value"))


def ranking_lines(lists: DataFrame, digits: int | None = None) -> DataFrame:
    text = ranking_text(F.col("ranking"), digits)
    return lists.select(pair_line(F.col("week"), F.col("c1"), F.col("c2"), text).alias("value"))
