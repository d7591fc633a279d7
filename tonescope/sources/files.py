"""Reading event files and the parquet event table built from them."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import session_settings
from .committed import (BATCH, FEED, batch_folder, commit, committed_batches, is_committed,
                        live_folders, read_committed, read_folders, written)
from .layout import ADDED, EVENT_DDL, NAMES
from .lines import LINE, OK, STATUS, events, parse_lines

MONTH = "added_month"
DATA = "data"
#: The feed of gathered folders; no other feed's name begins with a plus.
GATHERED = "+gathered"
_STORED_DDL = f"{EVENT_DDL}, {LINE} string, {STATUS} string, {MONTH} int"


def read_lines(spark: SparkSession, path: str, *kept: str) -> DataFrame:
    """Lines of a file, folder or glob, ended by a line feed; one carriage return before it is
    cut off. Large files are split over many tasks. ``kept`` are hidden columns to keep besides."""
    return _uncut(spark.read.text(path, lineSep="\n"), *kept)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """The same lines of a file, or of the files that arrive in a folder, each read exactly once.

    One of ``max_files`` and ``max_bytes`` may bound a micro-batch, in whole files
    (``sources.deliveries`` cuts a file).
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _uncut(reader.text(file_or_folder(path), lineSep="\n"))


def _uncut(lines: DataFrame, *kept: str) -> DataFrame:
    cut = F.expr("substring(value, 1, length(value) - 1)")
    return lines.select(F.when(F.endswith("value", F.lit("\r")), cut)
                        .otherwise(F.col("value")).alias("value"), *kept)


def file_or_folder(path: str) -> str:
    """A path a file stream accepts: it refuses the name of a single file, but not a pattern that
    only this file (or folder) matches."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    return events(parse_lines(read_lines(spark, path)))


def stream_event_files(spark: SparkSession, path: str, max_files: int | None = None,
                       max_bytes: int | None = None) -> DataFrame:
    return events(parse_lines(stream_lines(spark, path, max_files, max_bytes)))


def table_rows(parsed: DataFrame) -> DataFrame:
    """``parse_lines`` output with the month it is stored under; 0 without a date."""
    month = F.year(ADDED) * 100 + F.month(ADDED)
    return parsed.withColumn(MONTH, F.coalesce(month, F.lit(0)))


def write_event_table(parsed: DataFrame, path: str, feed: str = "load", batch: int = 0,
                      rebalance: bool = False) -> bool:
    """Store ``parse_lines`` output, events and quarantined lines, as one batch of a feed.

    The batch counts from its commit record on (``sources.committed``). A batch that is recorded
    already is left as it is, and the result is False: loading the same file again under its name adds
    nothing. Feeds, batch loads and streams may write to one table at the same time.

    A batch is partitioned by status and month, so a later query on a time range reads only its
    months and only its columns. Feeds come in time order, where a task meets few months; for
    shuffled input ``rebalance`` gathers each month, splitting months that are too large.
    """
    spark = parsed.sparkSession
    if is_committed(spark, path, feed, batch):
        return False
    rows = table_rows(parsed)
    if rebalance:
        rows = rows.hint("rebalance", STATUS, MONTH)
    _store(rows, batch_folder(path, DATA, feed, batch))
    commit(spark, path, feed, batch, written(spark, path, DATA, feed, batch))
    return True


def _store(rows: DataFrame, folder: str) -> None:
    # static: what a crash left behind goes, whatever the session says about overwriting.
    (rows.write.partitionBy(STATUS, MONTH).mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(folder))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, DATA, _STORED_DDL)


def read_event_table(spark: SparkSession, path: str, first: date | None = None,
                     last: date | None = None) -> DataFrame:
    """Events of the table added from ``first`` to ``last``; only their months are read."""
    stored = _stored(spark, path).where(F.col(STATUS) == OK)
    if first:
        stored = stored.where((F.col(MONTH) >= _month(first)) & (F.col(ADDED) >= F.lit(first)))
    if last:
        stored = stored.where((F.col(MONTH) <= _month(last)) & (F.col(ADDED) <= F.lit(last)))
    return stored.select(*NAMES, MONTH)


def _month(day: date) -> int:
    return day.year * 100 + day.month


def read_quarantine_table(spark: SparkSession, path: str) -> DataFrame:
    return (_stored(spark, path).where(F.col(STATUS) != OK)
            .select(LINE, F.col(STATUS).alias("reason")))


def compact_event_table(spark: SparkSession, path: str, target_bytes: int = 256 << 20) -> int:
    """Gather the small folders of each status and month into files of about ``target_bytes``; the
    number of folders replaced.

    A folder is small below half of the target. The new files count, and the old ones no longer do,
    from one commit record on: a run that is stopped changes nothing, one that is repeated finds
    nothing to do, and of two at the same time one fails. Readers that have listed the old files may
    finish with them, so they are not deleted here.
    """
    small = {}
    for row in live_folders(spark, path, DATA):
        if row.bytes < target_bytes / 2:
            month = re.search(f"{STATUS}=([^/]*)/{MONTH}=([^/]*)$", row.folder).groups()
            small.setdefault(month, []).append(row)
    small = {month: rows for month, rows in small.items() if len(rows) > 1}
    if not small:
        return 0
    folders = [row.folder for rows in small.values() for row in rows]
    done = [n for feed, n in committed_batches(spark, path) if feed == GATHERED]
    number, attempt = max(done, default=-1) + 1, f"{GATHERED}-{uuid.uuid4().hex}"

    # Each month is dealt to as many tasks as it fills files; every task fills one file.
    tasks, dealing = 0, []
    for (status, month), of_month in small.items():
        files = -(-sum(row.bytes for row in of_month) // target_bytes)
        dealing += [F.lit(f"{status}/{month}"),
                    F.struct(F.lit(tasks).alias("first"), F.lit(files).alias("files"))]
        tasks += files
    of_month = F.element_at(F.create_map(*dealing),
                            F.concat_ws("/", STATUS, F.col(MONTH).cast("string")))
    share = F.pmod(F.xxhash64(LINE, *NAMES[:4], "sourceUrl"), of_month["files"])
    rows = read_folders(spark, path, DATA, folders, _STORED_DDL).drop(FEED, BATCH)
    dealt = rows.repartitionById(tasks, (of_month["first"] + share).cast("int"))
    # A writer sorts a task's rows by folder, all of them in memory, unless it may keep files open. One
    # is enough here.
    with session_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "1"}):
        _store(dealt, batch_folder(path, DATA, attempt, number))
    commit(spark, path, GATHERED, number, written(spark, path, DATA, attempt, number),
           replaced=[(DATA, folder) for folder in folders], mode="errorifexists")
    return len(folders)


def stream_event_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The event table as a stream: what several queries over one feed should share, since each
    then reads a few columns and none parses text again.

    A file source cannot ask the records: it sees a batch when its files arrive, each row in the folder
    it first came in. A batch that a crash keeps from its record is written, and seen, again.
    """
    reader = spark.readStream.schema(f"{_STORED_DDL}, {FEED} string, {BATCH} long")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    base = f"{path.rstrip('/')}/{DATA}"
    stored = reader.option("basePath", base).parquet(f"{base}/{FEED}=[^+]*")
    return stored.where(F.col(STATUS) == OK).select(*NAMES)
