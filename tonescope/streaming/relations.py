"""Running relations of country pairs: both results from one scan, one shuffle and one state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import ISO, instant, week_window, window_monday
from ..operators.aggregates import mean_tone, pair_count_and_sum
from ..operators.fanout import directed
from ..operators.selection import UNKNOWN, or_unknown
from ..plans.relations import (GROUP, PAIR, bilateral_lines, rank_types, ranking_lines,
                               relation_rows, type_lists)
from ..sources.committed import BATCH, FEED, commit, is_committed, query_feed, read_committed
from ..sources.layout import ACTOR_TYPES, ADDED, PLACES, TONE
from .sinks import use_up, write_text_batch

#: The outputs of ``relation_files``.
PAIR_LINES, TYPE_LINES = "bilateral_relationships", "week"
UPDATES_DDL = "week date, actor_type string, c1 string, c2 string, n long, tone_sum double"


def relation_updates(events: DataFrame, *, places: Sequence[str] = PLACES,
                     types: Sequence[str] = ACTOR_TYPES, pairs: bool = True, time: str = ADDED,
                     tone: str = TONE, week_start: str = ISO, unknown_label: str = UNKNOWN,
                     keep_open: str | None = None) -> DataFrame:
    """Count and tone sum so far, per week, unordered pair and actor type, for update mode.

    The rows without ``actor_type`` are those of the pair itself (``pairs=False`` leaves them out;
    no ``types`` leaves out the others). State holds one direction of each pair. With
    ``keep_open`` a week's state is given up, and its later rows dropped, that long after its end;
    without it every week stays open and state grows with the feed.
    """
    at = [instant(F.col(time)).alias("at")] if keep_open else []
    rows = relation_rows(events, places, time, tone, types, week_start, extra=at)
    if keep_open:
        rows = rows.withWatermark("at", keep_open)

    known = F.col("c1").isNotNull() & F.col("c2").isNotNull() & F.lit(pairs)
    slots = F.array(F.lit(None).cast("string"), *types)
    kept = ["week", "tone", *(["at"] if keep_open else [])]
    rows = rows.select(*kept, "c1", "c2", known.alias("known"),
                       F.posexplode(slots).alias("slot", "actor_type"))
    rows = rows.where(F.when(F.col("slot") == 0, F.col("known"))
                      .otherwise(F.col("actor_type").isNotNull()))
    rows = or_unknown(rows, *PAIR, label=unknown_label)

    if keep_open:
        span = week_window(F.col("at"), week_start).alias("span")
        sums = pair_count_and_sum(rows, [span, "actor_type"], *PAIR, "tone")
        sums = sums.withColumn("week", window_monday(F.col("span"), week_start))
    else:
        sums = pair_count_and_sum(rows, ["week", "actor_type"], *PAIR, "tone")
    return sums.select("week", "actor_type", *PAIR, "n", "tone_sum")


def pair_results(updates: DataFrame) -> DataFrame:
    """``week, c1, c2, n, mean_tone`` of the ordered pairs in a batch of updates."""
    rows = directed(updates.where(F.col("actor_type").isNull()), *PAIR)
    return rows.select(*GROUP, "n", mean_tone().alias("mean_tone"))


def type_results(updates: DataFrame, k: int = 5) -> DataFrame:
    """``week, c1, c2, actor_type, n, mean_tone, rank`` among the types in a batch of updates."""
    ranked = rank_types(updates.where(F.col("actor_type").isNotNull()), k)
    return directed(ranked, *PAIR).select(*GROUP, "actor_type", "n", "mean_tone", "rank")


def type_list_results(updates: DataFrame, k: int = 5) -> DataFrame:
    """The same with one row per ordered pair and the types in one array, best first."""
    ranked = rank_types(updates.where(F.col("actor_type").isNotNull()), k)
    return directed(type_lists(ranked), *PAIR).select(*GROUP, "ranking")


def latest(updates: DataFrame, batch: str = "batch") -> DataFrame:
    """The state after the last batch, from stored updates: the newest row of every key.

    ``type_results`` of it is the ranking over all types instead of those one batch touched.
    """
    newest = F.max_by(F.struct("n", "tone_sum"), batch).alias("newest")
    return (updates.groupBy("week", "actor_type", *PAIR).agg(newest)
            .select("week", "actor_type", *PAIR, "newest.n", "newest.tone_sum"))


def relation_files(output: str, k: int = 5, digits: int | None = None,
                   checkpoint: str | None = None) -> Callable[[DataFrame, int], None]:
    """Write each batch as text: ``bilateral_relationships`` and ``week``, a folder per batch.

    With the query's ``checkpoint`` the two outputs of a batch count together, from one record on:
    ``read_relation_lines`` never shows one without the other, wherever a run was stopped.
    """
    def on_batch(updates: DataFrame, batch_id: int) -> None:
        spark = updates.sparkSession
        feed = query_feed(spark, checkpoint) if checkpoint else None
        if feed and is_committed(spark, output, feed, batch_id):
            use_up(updates)
            return
        updates.persist()  # two outputs, one update of the state
        try:
            for name, lines in ((PAIR_LINES, bilateral_lines(pair_results(updates), digits)),
                                (TYPE_LINES, ranking_lines(type_list_results(updates, k), digits))):
                write_text_batch(lines, f"{output}/{name}" + (f"/{FEED}={feed}" if feed else ""),
                                 batch_id)
        finally:
            updates.unpersist()
        if feed:
            folder = f"{FEED}={feed}/{BATCH}={batch_id}"
            commit(spark, output, feed, batch_id, [(PAIR_LINES, folder, None), (TYPE_LINES, folder, None)])
    return on_batch


def read_relation_lines(spark: SparkSession, output: str, name: str) -> DataFrame:
    """``value, feed, batch``: the lines of one output of ``relation_files``, of recorded batches."""
    return read_committed(spark, output, name, "value string", "text")
