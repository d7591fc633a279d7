"""Merging the folders of a growing table, so that reading it costs what its keys cost.

Batches add folders of rows whose keys recur. Of a partition's folders, the smallest are merged by key up
to the last that is less than a quarter of the smaller ones together. So of those that remain, each is at
least a quarter of all smaller ones, and a reader meets at most five times the largest, which has one row
per key, whatever the number of batches. A row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .committed import (BATCH, FEED, batch_folder, commit, committed_batches, live_folders,
                        read_folders, written)

#: The feed of merged folders; no other feed's name begins with a plus.
MERGED = "+merged"
RATIO = 0.25


def store_batch(rows: DataFrame, root: str, name: str, feed: str, batch: int,
                partition: str | None = None) -> list[Row]:
    """Write one batch of an output and list its folders for the commit record. A batch that runs
    again replaces its own folder. Rows of a partition are gathered, so it gets few files."""
    if partition:
        rows = rows.hint("rebalance", F.col(partition))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer = writer.partitionBy(partition) if partition else writer
    writer.parquet(batch_folder(root, name, feed, batch))
    return written(rows.sparkSession, root, name, feed, batch)


def to_merge(folders: Sequence[Row], ratio: float = RATIO) -> list[Row]:
    """The folders of one partition that should become one: see above."""
    ordered, size, last = sorted(folders, key=lambda r: (r.bytes, r.folder)), 0, 0
    for n, row in enumerate(ordered, 1):
        if size and row.bytes < ratio * size:
            last = n
        size += row.bytes
    return ordered[:last]


def merge_levels(spark: SparkSession, root: str, name: str, ddl: str,
                 combine: Callable[[DataFrame], DataFrame], partition: str | None = None,
                 ratio: float = RATIO) -> int:
    """Merge what should be merged, in all partitions at once; the number of folders replaced.

    ``combine`` merges rows by key and keeps the columns of ``ddl``. The merged folders replace the others by
    one commit record: a merge that is stopped changes nothing, and of two at the same time one fails.
    """
    by_partition: dict[str, list[Row]] = {}
    for row in live_folders(spark, root, name):
        by_partition.setdefault(partition_of(row.folder), []).append(row)
    chosen = [row.folder for rows in by_partition.values() for row in to_merge(rows, ratio)]
    if not chosen:
        return 0
    done = [n for feed, n in committed_batches(spark, root) if feed == MERGED]
    number, attempt = max(done, default=-1) + 1, f"{MERGED}-{uuid.uuid4().hex}"
    merged = combine(read_folders(spark, root, name, chosen, ddl).drop(FEED, BATCH))
    folders = store_batch(merged, root, name, attempt, number, partition)
    commit(spark, root, MERGED, number, folders, [(name, f) for f in chosen], mode="errorifexists")
    return len(chosen)


def partition_of(folder: str) -> str:
    """What follows feed and batch in a folder's name."""
    return "/".join(folder.split("/")[2:])
