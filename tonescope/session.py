"""Session settings and the working folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job of this library is tuned for. None of them is needed for right
# results: all time handling is written to be independent of the session time zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A generated method above 8000 bytes is never compiled by HotSpot. Typing all 58 columns is
    # above; run it with split methods instead (three times faster).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keyed state outgrows the heap on large feeds: keep it in RocksDB and upload only changes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the keys costs a lookup on every update.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app_name: str = "tonescope", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's settings, overridden and extended by ``settings``.

    The master, the memory and the number of shuffle partitions belong to the cluster and are only
    set when passed.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for tables that one run writes and reads back.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session, where every task sees the same disk, may fall back to a temporary folder.
    """
    shared = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getCheckpointDir())
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = tempfile.mkdtemp(prefix="tonescope-")
    folder = os.path.join(shared, f"{purpose}-{uuid.uuid4().hex}")
    for collected in _collecting:
        collected.append(folder)
    return folder


_collecting: list[list[str]] = []


@contextmanager
def collected_folders() -> Iterator[list[str]]:
    """The folders that ``work_folder`` names inside, for whoever knows when they are used up."""
    folders: list[str] = []
    _collecting.append(folders)
    try:
        yield folders
    finally:
        # By identity: two lists without folders are equal.
        _collecting[:] = [x for x in _collecting if x is not folders]


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with other settings; at the end it has its own again."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def released_shuffles(spark: SparkSession):
    """Inside, what a job has shuffled goes from disk when the job ends, and not only when the driver's
    garbage is collected: for chains of written tables."""
    return session_settings(
        spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete work folders, on whatever file system they are; a missing one is no error."""
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
