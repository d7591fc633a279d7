"""Where results go: a folder per micro-batch, and if wanted some rows to the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BATCH = "batch"


def _folder(prefix: str, batch_id: int) -> str:
    return f"{prefix}/{BATCH}={batch_id}"


def write_text_batch(lines: DataFrame, prefix: str, batch_id: int) -> None:
    """One line per row. A batch that runs again replaces its own folder and no other."""
    lines.write.mode("overwrite").text(_folder(prefix, batch_id))


def write_table_batch(rows: DataFrame, prefix: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_folder(prefix, batch_id))


def read_text_batches(spark: SparkSession, prefix: str) -> DataFrame:
    """The lines of all batches, with the number of the batch."""
    return spark.read.schema(f"value string, {BATCH} long").text(prefix)


def read_table_batches(spark: SparkSession, prefix: str, ddl: str) -> DataFrame:
    """The rows of all batches, with the number of the batch."""
    return spark.read.schema(f"{ddl}, {BATCH} long").parquet(prefix)


def trigger(writer: DataStreamWriter, micro_batch_ms: int | None) -> DataStreamWriter:
    """A micro-batch every so many milliseconds, or with None: all there is now, then stop."""
    if micro_batch_ms is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{micro_batch_ms} milliseconds")


def start_batches(rows: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
                  output_mode: str, micro_batch_ms: int | None = 1000,
                  name: str | None = None) -> StreamingQuery:
    """Hand every micro-batch of results to ``on_batch``; resumes from ``checkpoint``."""
    writer = (rows.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
              .foreachBatch(on_batch))
    if name:
        writer = writer.queryName(name)
    return trigger(writer, micro_batch_ms).start()


def use_up(rows: DataFrame) -> None:
    """Run a batch whose results are there already: its state must be written all the same."""
    rows.write.format("noop").mode("overwrite").save()


def also_shown(on_batch: Callable[[DataFrame, int], None],
               rows: int) -> Callable[[DataFrame, int], None]:
    """``on_batch``, after which the first ``rows`` rows of the batch are printed."""
    if rows <= 0:
        return on_batch

    def write_and_show(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the state is updated once
        try:
            on_batch(batch, batch_id)
            batch.show(rows, truncate=False)
        finally:
            batch.unpersist()
    return write_and_show
