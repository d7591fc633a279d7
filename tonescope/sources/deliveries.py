"""One large file as many deliveries: numbered stretches of lines, for micro-batches inside a file.

A file source hands a file to one micro-batch, whatever its size. Here the lines of a file are numbered
and dealt to folders ``delivery=N``, which a stream then takes one after another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import work_folder
from .files import read_lines, stream_lines

DELIVERY, NUMBER = "delivery", "line_number"
#: Blocks that large files are cut into, about, until these blocks have the usual size: each costs a
#: task per reading and a file per delivery it touches.
BLOCKS = 1000
USUAL_BLOCK = 128 << 20


def numbered_lines(spark: SparkSession, path: str, block_bytes: int = USUAL_BLOCK) -> DataFrame:
    """``value, line_number`` of the lines of a file, from 0 in the order of the file.

    The lines of several files are numbered in the order of their paths. Every task counts the lines
    of its blocks of the file; prefix sums over the blocks, a slim table, then number all lines without
    a shuffle of their texts. The file is read twice. ``block_bytes`` is the least size of a block:
    large files are cut into larger ones (``_cut``).
    """
    return _number(spark, path, block_bytes)[0]


def _number(spark: SparkSession, path: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The numbered lines, and how many they are."""
    # Both readings must cut the file alike. The number of executors, which may change meanwhile,
    # must not count: a session of its own fixes the size of a block.
    session, block_bytes = spark.newSession(), _cut(spark, path, block_bytes)
    for key, value in (("maxPartitionBytes", block_bytes), ("minPartitionNum", 1),
                       ("openCostInBytes", min(block_bytes, 4 << 20))):
        session.conf.set(f"spark.sql.files.{key}", str(value))
    lines = read_lines(session, path, "_metadata.file_path", "_metadata.file_block_start").withColumn(
        "_id", F.monotonically_increasing_id())

    blocks = lines.groupBy("file_path", "file_block_start").agg(
        F.count("*").alias("n"), F.min("_id").alias("first_id"))
    folder = work_folder(spark, "blocks")
    blocks.write.parquet(f"{folder}/counts")
    counts = session.read.parquet(f"{folder}/counts")
    # Two levels: the blocks of a file, and the files.
    in_file = Window.partitionBy("file_path").orderBy("file_block_start")
    files = counts.groupBy("file_path").agg(F.sum("n").alias("size"))
    in_order = Window.orderBy("file_path")
    files = files.select("file_path", (F.sum("size").over(in_order) - F.col("size")).alias("before"))
    placed = counts.withColumn("here", F.sum("n").over(in_file) - F.col("n")).join(files, "file_path")
    placed.select("file_path", "file_block_start",
                  (F.col("before") + F.col("here") - F.col("first_id")).alias("shift")).write.parquet(
        f"{folder}/shifts")
    shifts = session.read.parquet(f"{folder}/shifts")

    number = F.col("_id") + F.coalesce("shift", F.raise_error(
        F.lit("the file changed while its lines were numbered")).cast("long"))
    numbered = lines.join(shifts, ["file_path", "file_block_start"], "left").select(
        "value", number.alias(NUMBER))
    return numbered, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _cut(spark: SparkSession, path: str, least: int) -> int:
    """The size of a block: ``least``, or as much more, up to the usual size, as makes BLOCKS of all files."""
    # Of files read so, Spark looks up the lengths and not the contents.
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(least, min(-(-size // BLOCKS), USUAL_BLOCK))


def deliver_file(spark: SparkSession, path: str, landing: str, lines_per_delivery: int,
                 block_bytes: int = USUAL_BLOCK) -> int:
    """Deal the lines of a file to ``landing/delivery=N``, so many to each; the number of deliveries.

    Every task writes the deliveries that its blocks touch, without a shuffle.
    """
    lines, total = _number(spark, path, block_bytes)
    delivery = F.floor(F.col(NUMBER) / lines_per_delivery).alias(DELIVERY)
    lines.select("value", delivery).write.partitionBy(DELIVERY).text(landing)
    return -(-total // lines_per_delivery)


def play_deliveries(spark: SparkSession, landing: str, deliveries: int,
                    start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Run a query once per delivery: ``start`` gets the stream of lines and starts a query that takes
    all there is and stops (``micro_batch_ms=None``), always with the same checkpoint.

    Each run finds the files of one more delivery and goes on where the one before stopped, so every
    delivery is one micro-batch, however many files it has. Played again after a crash, deliveries
    that the checkpoint holds are passed over.
    """
    for arrived in range(1, deliveries + 1):
        numbers = ",".join(str(n) for n in range(arrived))
        start(stream_lines(spark, f"{landing}/{DELIVERY}={{{numbers}}}")).awaitTermination()
