"""Folders of rows that count only once a commit record names them.

A writer, known by its ``feed``, puts the rows of one batch into ``NAME/feed=F/batch=N`` under a root, one
folder per output NAME, and then one record into ``commits/feed=F/batch=N``. A record is a single
small file, so it appears at once. Readers ask the records, never the folders: what a crash left half
written does not show, all outputs of a batch show together, and a batch that runs again replaces its
own folders before its record is there and nothing after. A record can also say that folders of
earlier records are replaced, which is how small folders are gathered into large ones.

Records pass through the driver, one row per live folder, as the file lists of any table do; rows
never.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COMMITS = "commits"
FEED, BATCH = "feed", "batch"
_KEYS_DDL = f"{FEED} string, {BATCH} long"
_RECORD_DDL = "name string, folder string, bytes long, replaced boolean"


def batch_folder(root: str, name: str, feed: str, batch: int) -> str:
    """Where one batch of a feed keeps an output."""
    if not re.fullmatch(r"[A-Za-z0-9_.+-]+", feed):
        raise ValueError(f"a feed is named by letters, digits and _.+-, not {feed!r}")
    return f"{root.rstrip('/')}/{name}/{FEED}={feed}/{BATCH}={batch}"


def is_committed(spark: SparkSession, root: str, feed: str, batch: int) -> bool:
    return bool(_read_records(spark, batch_folder(root, COMMITS, feed, batch), "").head(1))


def commit(spark: SparkSession, root: str, feed: str, batch: int, folders: Iterable[Row | Sequence],
           replaced: Iterable[tuple[str, str]] = (), mode: str = "overwrite") -> None:
    """Record the batch: ``folders`` are rows (name, folder, bytes) as ``written`` lists them;
    ``replaced`` are (name, folder) of earlier records that count no longer.

    A batch without rows is recorded too. ``mode="errorifexists"`` lets one of two rivals win.
    """
    rows = [(None, None, None, None)]
    rows += [(name, folder, size, False) for name, folder, size in folders]
    rows += [(name, folder, None, True) for name, folder in replaced]
    record = spark.createDataFrame(rows, _RECORD_DDL).coalesce(1)
    record.write.mode(mode).json(batch_folder(root, COMMITS, feed, batch))


def written(spark: SparkSession, root: str, name: str, feed: str, batch: int,
            pattern: str = "*.parquet") -> list[Row]:
    """(name, folder, bytes) of the folders that hold the batch's files, relative to the output."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(batch_folder(root, name, feed, batch)))
    inside = F.regexp_extract("path", f".*/({FEED}=[^/]*/{BATCH}=.*)/[^/]*$", 1)
    return (files.groupBy(F.lit(name).alias("name"), inside.alias("folder"))
            .agg(F.sum("length").alias("bytes")).collect())


def records(spark: SparkSession, root: str) -> DataFrame:
    """``name, folder, bytes, replaced, feed, batch`` of all records; no rows if there are none."""
    return _read_records(spark, f"{root.rstrip('/')}/{COMMITS}", f", {_KEYS_DDL}")


def live_folders(spark: SparkSession, root: str, name: str) -> list[Row]:
    """``folder, bytes`` of the folders that count, in order."""
    found = records(spark, root).where(F.col("name") == name).groupBy("folder").agg(
        F.max("bytes").alias("bytes"), F.bool_or("replaced").alias("replaced"))
    return sorted(found.where(~F.col("replaced")).select("folder", "bytes").collect())


def committed_batches(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Feed and number of every recorded batch, in order."""
    return sorted((r.feed, r.batch) for r in
                  records(spark, root).select(FEED, BATCH).distinct().collect())


def read_folders(spark: SparkSession, root: str, name: str, folders: Sequence[str], ddl: str,
                 kind: str = "parquet") -> DataFrame:
    """The rows of some folders of an output: the columns of ``ddl``, then ``feed`` and ``batch``."""
    schema = f"{ddl}, {_KEYS_DDL}"
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/{name}"
    return (spark.read.schema(schema).option("basePath", base).format(kind)
            .load([f"{base}/{folder}" for folder in folders]))


def read_committed(spark: SparkSession, root: str, name: str, ddl: str,
                   kind: str = "parquet") -> DataFrame:
    """The rows that count of an output, with the ``feed`` and ``batch`` they came in."""
    folders = [r.folder for r in live_folders(spark, root, name)]
    return read_folders(spark, root, name, folders, ddl, kind)


def query_feed(spark: SparkSession, checkpoint: str) -> str:
    """The id a streaming query keeps in its checkpoint: two queries never share one, and a query
    that starts anew with another checkpoint does not meet the batches of the old one."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).head()[0]
    return re.search(r'"id"\s*:\s*"([^"]+)"', text)[1]


def _read_records(spark: SparkSession, path: str, keys: str) -> DataFrame:
    try:
        return spark.read.schema(_RECORD_DDL + keys).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _RECORD_DDL + keys)
