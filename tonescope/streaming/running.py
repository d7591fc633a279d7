"""Running relations of country pairs kept as stored sums, without a state store.

Counts and sums add up, so what a batch brings is a small table of its own, and the state of any number
of batches and feeds is the sum of such tables. They are stored by month, count from their commit record
on, and are merged in levels. A new feed adds its own sums and never reads another feed's events; a
ranking among all types of the pairs a batch touched reads the months it touched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import ISO
from ..operators.selection import UNKNOWN
from ..plans.relations import GROUP, PAIR
from ..sources.committed import (BATCH, FEED, commit, is_committed, live_folders, query_feed,
                                 read_committed, read_folders)
from ..sources.layout import ACTOR_TYPES, ADDED, PLACES, TONE
from ..sources.levels import merge_levels, partition_of, store_batch
from .relations import UPDATES_DDL, latest, pair_results, relation_updates, type_results
from .sinks import use_up

SUMS, PAIRS, TOPS, LOG = "sums", "pairs", "tops", "log"
MONTH = "month"
SUMS_DDL = f"{UPDATES_DDL}, {MONTH} int"
LOG_DDL = f"{UPDATES_DDL}, version long"
PAIRS_DDL = "week date, c1 string, c2 string, n long, mean_tone double"
TOPS_DDL = "week date, c1 string, c2 string, actor_type string, n long, mean_tone double, rank int"
_KEYS = ("week", "actor_type", *PAIR)


def add_up(sums: DataFrame) -> DataFrame:
    """Sums of several batches or feeds as sums of all."""
    return sums.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("tone_sum").alias("tone_sum"))


def _by_month(sums: DataFrame) -> DataFrame:
    month = (F.year("week") * 100 + F.month("week")).cast("int")
    return sums.select(*_KEYS, "n", "tone_sum", F.coalesce(month, F.lit(0)).alias(MONTH))


def add_feed(events: DataFrame, root: str, feed: str, batch: int = 0, *, places: Sequence[str] = PLACES,
             types: Sequence[str] = ACTOR_TYPES, time: str = ADDED, tone: str = TONE,
             week_start: str = ISO, unknown_label: str = UNKNOWN) -> bool:
    """Add the sums of a feed, or of one batch of it, to those stored under ``root``, once.

    What is recorded already is left as it is, and the result is False. The stored sums must all be
    made with the same arguments.
    """
    spark = events.sparkSession
    if is_committed(spark, root, feed, batch):
        return False
    sums = relation_updates(events, places=places, types=types, time=time, tone=tone,
                            week_start=week_start, unknown_label=unknown_label)
    folders = store_batch(_by_month(sums), root, SUMS, feed, batch, MONTH)
    commit(spark, root, feed, batch, folders)
    merge_sums(spark, root)
    return True


def merge_sums(spark: SparkSession, root: str) -> int:
    """Merge small tables of sums; the number of folders replaced."""
    return merge_levels(spark, root, SUMS, SUMS_DDL, lambda sums: _by_month(add_up(sums)), MONTH)


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    """``week, actor_type, c1, c2, n, tone_sum`` of everything added so far, a row per key, in the
    form ``pair_results`` and ``type_results`` take."""
    return add_up(read_committed(spark, root, SUMS, SUMS_DDL))


def running_relations(root: str, checkpoint: str, k: int | None = 5,
                      **columns) -> Callable[[DataFrame, int], None]:
    """For ``start_batches`` over events: after each batch, store its sums and, for the pairs it touched,
    the tone so far (``read_pairs``) and the top ``k`` among all types so far (``read_tops``).

    The three outputs of a batch count together. Without ``k`` the sums are all that is stored, for
    readers that want results now and then. ``columns`` are the arguments of ``add_feed``.
    """
    def on_batch(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        feed = query_feed(spark, checkpoint)
        if k is None:
            add_feed(events, root, feed, batch_id, **columns)
            return
        if is_committed(spark, root, feed, batch_id):
            return
        own = store_batch(_by_month(relation_updates(events, **columns)), root, SUMS, feed, batch_id,
                          MONTH)
        folders, months = [r.folder for r in own], {partition_of(r.folder) for r in own}
        brought = read_folders(spark, root, SUMS, folders, SUMS_DDL)
        before = [r.folder for r in live_folders(spark, root, SUMS) if partition_of(r.folder) in months]
        stored = read_folders(spark, root, SUMS, before + folders, SUMS_DDL)
        totals = add_up(_of_touched(stored, brought))
        outputs = store_batch(pair_results(totals), root, PAIRS, feed, batch_id)
        outputs += store_batch(type_results(totals, k), root, TOPS, feed, batch_id)
        commit(spark, root, feed, batch_id, own + outputs)
        merge_sums(spark, root)
    return on_batch


def _of_touched(sums: DataFrame, brought: DataFrame) -> DataFrame:
    """The sums of pairs, and of all types of pairs, that ``brought`` has rows of."""
    kind = F.col("actor_type").isNull()
    touched = brought.select(*GROUP, kind.alias("whole")).distinct()
    return (sums.withColumn("whole", kind).join(touched, [*GROUP, "whole"], "left_semi")
            .drop("whole"))


def read_pairs(spark: SparkSession, root: str) -> DataFrame:
    """``week, c1, c2, n, mean_tone, feed, batch``: the pairs each batch touched, with the tone then."""
    return read_committed(spark, root, PAIRS, PAIRS_DDL)


def read_tops(spark: SparkSession, root: str) -> DataFrame:
    """``week, c1, c2, actor_type, n, mean_tone, rank, feed, batch``: the rankings after each batch."""
    return read_committed(spark, root, TOPS, TOPS_DDL)


def relation_log(root: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """For ``start_batches`` over ``relation_updates``: keep the newest row of every key, merging older
    versions away in levels, so that reading the snapshot does not read the history."""
    def on_batch(updates: DataFrame, batch_id: int) -> None:
        spark = updates.sparkSession
        feed = query_feed(spark, checkpoint)
        if is_committed(spark, root, feed, batch_id):
            use_up(updates)
        else:
            rows = updates.withColumn("version", F.lit(batch_id).cast("long"))
            commit(spark, root, feed, batch_id, store_batch(rows, root, LOG, feed, batch_id))
            merge_levels(spark, root, LOG, LOG_DDL, _newest)
    return on_batch


def _newest(rows: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("n", "tone_sum", "version"), "version").alias("last")
    return rows.groupBy(*_KEYS).agg(last).select(*_KEYS, "last.n", "last.tone_sum", "last.version")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The state after the last recorded batch: ``week, actor_type, c1, c2, n, tone_sum``."""
    return latest(read_committed(spark, root, LOG, LOG_DDL).drop(FEED, BATCH), "version")
