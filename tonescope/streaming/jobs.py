"""The feeds as long-running jobs: events in, results out.

``source`` is a path of event files, or a stream of events, such as ``stream_event_table`` gives, with
the columns named by ``key``, ``places``, ``types``, ``time`` and ``tone``. ``max_files`` and ``max_bytes``
bound a micro-batch of files. ``micro_batch_ms=None`` processes what is there and stops. A job started
again with the same ``checkpoint`` goes on where it stopped.

Results are always written, to a folder beside the checkpoint (``checkpoint`` and ``-results``) unless
``output`` names another. ``show`` prints so many rows of every batch besides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import ISO
from ..operators.selection import UNKNOWN
from ..plans.weekly_tone import weekly_lines
from ..sources.committed import query_feed
from ..sources.files import stream_event_files, write_event_table
from ..sources.layout import ACTOR_TYPES, ADDED, COUNTRY, PLACES, TONE
from .daily import daily_tone_stream
from .relations import relation_files, relation_updates
from .running import running_relations
from .sinks import also_shown, start_batches, write_table_batch, write_text_batch
from .weekly import weekly_halving_stream


def results_folder(checkpoint: str, output: str | None = None) -> str:
    return output or f"{checkpoint.rstrip('/')}-results"


def _events(spark: SparkSession, source: str | DataFrame, max_files: int | None,
            max_bytes: int | None) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    return stream_event_files(spark, source, max_files, max_bytes)


def daily_tone_job(spark: SparkSession, source: str | DataFrame | Sequence[DataFrame], checkpoint: str,
                   country: str = "USA", micro_batch_ms: int | None = 1000,
                   delay: str = "0 seconds", max_files: int | None = None,
                   output: str | None = None, *, max_bytes: int | None = None,
                   size: str = "1 day", key: str = COUNTRY, time: str = ADDED, tone: str = TONE,
                   show: int = 0) -> StreamingQuery:
    """Write the tone sum of every closed window as parquet, a folder per micro-batch."""
    if isinstance(source, str):
        source = _events(spark, source, max_files, max_bytes)
    days = daily_tone_stream(source, country, key=key, time=time, tone=tone, size=size, delay=delay)
    folder = results_folder(checkpoint, output)
    return start_batches(days, also_shown(lambda rows, n: write_table_batch(rows, folder, n), show),
                         checkpoint, "append", micro_batch_ms)


def weekly_tone_job(spark: SparkSession, source: str | DataFrame, checkpoint: str,
                    country: str = "USA", micro_batch_ms: int | None = 1000,
                    max_files: int | None = None, output: str | None = None, *,
                    max_bytes: int | None = None, week_start: str = ISO,
                    keep_open: str | None = None, digits: int | None = None, key: str = COUNTRY,
                    time: str = ADDED, tone: str = TONE, show: int = 0) -> StreamingQuery:
    """Write the halving average of every week a micro-batch touched as text, a folder per batch."""
    averages = weekly_halving_stream(_events(spark, source, max_files, max_bytes), country, key=key,
                                     time=time, tone=tone, week_start=week_start, keep_open=keep_open)
    lines, folder = weekly_lines(averages, country, digits=digits), results_folder(checkpoint, output)
    return start_batches(lines, also_shown(lambda rows, n: write_text_batch(rows, folder, n), show),
                         checkpoint, "update", micro_batch_ms)


def relations_job(spark: SparkSession, source: str | DataFrame, output: str, checkpoint: str,
                  micro_batch_ms: int | None = 1000, keep_open: str | None = None,
                  max_files: int | None = None, *, max_bytes: int | None = None, k: int = 5,
                  digits: int | None = None, week_start: str = ISO, unknown_label: str = UNKNOWN,
                  places: Sequence[str] = PLACES, types: Sequence[str] = ACTOR_TYPES,
                  time: str = ADDED, tone: str = TONE, show: int = 0) -> StreamingQuery:
    """Write the tone and the top ``k`` actor types of every pair a micro-batch touched, both or
    neither of a batch (``read_relation_lines``). The ranking is among the types the batch touched."""
    updates = relation_updates(_events(spark, source, max_files, max_bytes), places=places,
                               types=types, time=time, tone=tone, week_start=week_start,
                               unknown_label=unknown_label, keep_open=keep_open)
    return start_batches(updates, also_shown(relation_files(output, k, digits, checkpoint), show),
                         checkpoint, "update", micro_batch_ms)


def running_relations_job(spark: SparkSession, source: str | DataFrame, root: str, checkpoint: str,
                          micro_batch_ms: int | None = 1000, max_files: int | None = None, *,
                          max_bytes: int | None = None, k: int | None = 5, week_start: str = ISO,
                          unknown_label: str = UNKNOWN, places: Sequence[str] = PLACES,
                          types: Sequence[str] = ACTOR_TYPES, time: str = ADDED,
                          tone: str = TONE) -> StreamingQuery:
    """The same results from stored sums, ranked among all types so far (``streaming.running``); without
    ``k`` only the sums, which ``read_sums`` reads.

    Several jobs, each with a checkpoint of its own, and batch loads may add to one ``root``.
    """
    on_batch = running_relations(root, checkpoint, k, places=places, types=types, time=time, tone=tone,
                                 week_start=week_start, unknown_label=unknown_label)
    return start_batches(_events(spark, source, max_files, max_bytes), on_batch, checkpoint, "append",
                         micro_batch_ms)


def event_table_job(parsed: DataFrame, table: str, checkpoint: str,
                    micro_batch_ms: int | None = 1000) -> StreamingQuery:
    """Append a parsed stream to the event table, each line once.

    Batch loads and any number of streams, each with a checkpoint of its own, may share the table.
    """
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        write_event_table(rows, table, query_feed(rows.sparkSession, checkpoint), batch_id)
    return start_batches(parsed, on_batch, checkpoint, "append", micro_batch_ms)
