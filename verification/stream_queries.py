"""Streaming queries that process what is there, stop, and return what they wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonescope.session import work_folder
from tonescope.sources import lines
from tonescope.sources.deliveries import deliver_file, play_deliveries
from tonescope.sources.files import (compact_event_table, file_or_folder, read_event_table,
                                     stream_lines, write_event_table)
from tonescope.sources.layout import COUNTRY, NAMES
from tonescope.streaming import daily, jobs, relations, running, sinks, weekly
from tonescope.streaming.jobs import event_table_job

from . import feeds
from .batch_queries import batched_tone_events, event_table_summary, rounded

_FEED = {"key": "event_type", "time": "ts", "tone": "value"}
_TYPED = {"places": feeds.PLACES, "types": feeds.TYPES, "time": "ts", "tone": "tone"}


def parse_events_stream(spark, sf_dir):
    landing, table = work_folder(spark, "landing"), work_folder(spark, "event-table")
    feeds.event_lines(spark, sf_dir).write.text(landing)
    parsed = lines.parse_lines(stream_lines(spark, landing))
    event_table_job(parsed, table, work_folder(spark, "checkpoint"), None).awaitTermination()
    return read_event_table(spark, table).select(*NAMES)


def parse_events_interval_stream(spark, sf_dir):
    """The same with a micro-batch every second, stopped when the input is used up."""
    landing, table = work_folder(spark, "landing"), work_folder(spark, "event-table")
    feeds.event_lines(spark, sf_dir).write.text(landing)
    parsed = lines.parse_lines(stream_lines(spark, landing))
    query = event_table_job(parsed, table, work_folder(spark, "checkpoint"), 1000)
    query.processAllAvailable()
    query.stop()
    return read_event_table(spark, table).select(*NAMES)


def _shared_table(spark, sf_dir):
    """One event table from a batch load and two streams, each third of the lines by another."""
    table, given = work_folder(spark, "event-table"), feeds.odd_lines(spark, sf_dir, "event_id")
    third = [given.where(F.col("event_id") % 3 == n).select("value") for n in range(3)]
    write_event_table(lines.parse_lines(third[0]), table)
    for n in (1, 2):
        landing = work_folder(spark, "landing")
        third[n].repartition(3).write.text(landing)
        parsed = lines.parse_lines(stream_lines(spark, landing, max_files=2))
        event_table_job(parsed, table, work_folder(spark, "checkpoint"), None).awaitTermination()
    return table


def event_table_two_feeds(spark, sf_dir):
    return event_table_summary(spark, _shared_table(spark, sf_dir))


def event_table_compacted(spark, sf_dir):
    table = _shared_table(spark, sf_dir)
    while compact_event_table(spark, table):
        pass
    return event_table_summary(spark, table)


def daily_tone_sum_stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).parquet(file_or_folder(path))
    sums = daily.daily_tone_stream(stream, feeds.COUNTRY, **_FEED)
    return rounded(_written(spark, sums, "append").drop("batch"), "tone_sum")


def daily_tone_sum_late_stream(spark, sf_dir):
    """Quarters of the feed in the order 0, 2, 1, 3: what is late in the third delivery is dropped."""
    place = F.when(F.col("quarter") == 1, 2).when(F.col("quarter") == 2, 1).otherwise(F.col("quarter"))
    rows = feeds.quarters(spark, sf_dir).withColumn("batch", place).drop("quarter")
    sums = _delivered(spark, rows, lambda stream: daily.daily_tone_stream(
        stream, feeds.COUNTRY, **_FEED), mode="append")
    return rounded(sums.drop("batch"), "tone_sum")


def daily_tone_two_feeds_stream(spark, sf_dir):
    """Even event ids in two files, odd ones in four: the second feed is behind the first."""
    streams, rows = [], feeds.quarters(spark, sf_dir)
    for odd, files in ((0, ((0, 1), (2, 3))), (1, ((0,), (1,), (2,), (3,)))):
        landing, own = work_folder(spark, "landing"), rows.where(F.col("event_id") % 2 == odd)
        for quarters in files:
            chosen = own.where(F.col("quarter").isin(*quarters)).drop("quarter")
            chosen.coalesce(1).write.mode("append").parquet(landing)
        streams.append(spark.readStream.schema(feeds.events(spark, sf_dir).schema)
                       .option("maxFilesPerTrigger", 1).parquet(landing))
    sums = daily.daily_tone_stream(streams, feeds.COUNTRY, **_FEED)
    return rounded(_written(spark, sums, "append").drop("batch"), "tone_sum")


def daily_tone_job_lines(spark, sf_dir):
    landing, checkpoint = work_folder(spark, "landing"), work_folder(spark, "checkpoint")
    feeds.event_lines(spark, sf_dir).repartition(3).write.text(landing)
    jobs.daily_tone_job(spark, landing, checkpoint, feeds.COUNTRY, None).awaitTermination()
    days = sinks.read_table_batches(spark, jobs.results_folder(checkpoint), (
        f"{COUNTRY} string, tone_sum double, window_start timestamp_ntz, window_end timestamp_ntz"))
    return rounded(days.withColumnRenamed(COUNTRY, "event_type").drop("batch"), "tone_sum")


def weekly_tone_job_lines(spark, sf_dir):
    landing, output = work_folder(spark, "landing"), work_folder(spark, "output")
    feeds.event_lines(spark, sf_dir).write.text(landing)
    jobs.weekly_tone_job(spark, landing, work_folder(spark, "checkpoint"), feeds.COUNTRY, None,
                         output=output, week_start="us", digits=6).awaitTermination()
    return sinks.read_text_batches(spark, output).select("value")


def weekly_halving_file_stream(spark, sf_dir):
    """Lines in the order of their ids, in one file or, so that no task sorts them all, a row of files,
    dealt to six deliveries."""
    file, landing, output = (work_folder(spark, name) for name in ("file", "landing", "output"))
    checkpoint, n = work_folder(spark, "checkpoint"), feeds.events(spark, sf_dir).count()
    # Rows go through the shuffle, and its sampling, and become lines behind it.
    given = feeds.events(spark, sf_dir).repartitionByRange(
        max(-(-n // feeds.FILE_LINES), 1), "event_id").sortWithinPartitions("event_id")
    feeds.lines_of(given).write.text(file)
    count = deliver_file(spark, file, landing, -(-n // feeds.DELIVERIES), block_bytes=1 << 16)

    def start(stream):
        averages = weekly.weekly_halving_stream(lines.events(lines.parse_lines(stream)), feeds.COUNTRY)
        return sinks.start_batches(averages, lambda df, i: sinks.write_table_batch(df, output, i),
                                   checkpoint, "update", None)
    play_deliveries(spark, landing, count, start)
    return rounded(sinks.read_table_batches(spark, output, "week date, average double"), "average")


def weekly_halving_avg_stream(spark, sf_dir):
    rows = feeds.events(spark, sf_dir).withColumn("batch", F.col("event_id") % feeds.BATCHES)
    averages = _delivered(spark, rows, lambda stream: weekly.weekly_halving_stream(
        stream, feeds.COUNTRY, **_FEED))
    return rounded(averages, "average")


def bilateral_tone_stream(spark, sf_dir):
    """The last value of every pair, over micro-batches of many files."""
    landing = work_folder(spark, "landing")
    rows = feeds.tone_events(spark, sf_dir).select("ts", "tone", *feeds.PLACES, *feeds.TYPES)
    rows.write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    updates = _written(spark, relations.relation_updates(stream, **_TYPED | {"types": ()}),
                       "update")
    return rounded(relations.pair_results(relations.latest(updates)), "mean_tone")


def bilateral_tone_log_stream(spark, sf_dir):
    """The last value of every pair, over four deliveries, from the merged log."""
    root, checkpoint = work_folder(spark, "log"), work_folder(spark, "checkpoint")
    rows = batched_tone_events(spark, sf_dir).select("ts", "tone", *feeds.PLACES, "batch")
    _play(spark, rows, lambda stream: sinks.start_batches(
        relations.relation_updates(stream, **_TYPED | {"types": ()}),
        running.relation_log(root, checkpoint), checkpoint, "update", None))
    return rounded(relations.pair_results(running.read_log(spark, root)), "mean_tone")


def _running(spark, sf_dir, k):
    """Stored sums of four deliveries, with what each of them showed."""
    root, checkpoint = work_folder(spark, "sums"), work_folder(spark, "checkpoint")
    columns = ["ts", "tone", *feeds.PLACES, *feeds.TYPES, "batch"]
    _play(spark, batched_tone_events(spark, sf_dir).select(*columns),
          lambda stream: jobs.running_relations_job(spark, stream, root, checkpoint, None, k=k, **_TYPED))
    return root


def actor_type_top5_stream(spark, sf_dir):
    """Both relation results in one query; the ranking over the whole state at the end."""
    rows = batched_tone_events(spark, sf_dir)
    updates = _delivered(spark, rows, lambda s: relations.relation_updates(s, **_TYPED))
    return rounded(relations.type_results(relations.latest(updates)), "mean_tone")


def actor_type_top5_sums_stream(spark, sf_dir):
    """The ranking over the stored sums of all deliveries."""
    sums = running.read_sums(spark, _running(spark, sf_dir, None))
    return rounded(relations.type_results(sums), "mean_tone")


def actor_type_top5_running_stream(spark, sf_dir):
    """After each delivery, the ranking among all types so far of the pairs it touched."""
    tops = running.read_tops(spark, _running(spark, sf_dir, 5))
    return rounded(tops.drop("feed"), "mean_tone")


def bilateral_tone_feeds(spark, sf_dir):
    """Four feeds, added one after the other and once more."""
    root, rows = work_folder(spark, "sums"), batched_tone_events(spark, sf_dir)
    for feed in [*range(feeds.BATCHES), 0]:
        running.add_feed(rows.where(F.col("batch") == feed), root, f"feed-{feed}", **_TYPED)
    return rounded(relations.pair_results(running.read_sums(spark, root)), "mean_tone")


def relations_job_us(spark, sf_dir):
    """US weeks and three types, from a stream of rows."""
    landing, output = work_folder(spark, "landing"), work_folder(spark, "output")
    rows = feeds.tone_events(spark, sf_dir).select("ts", "tone", *feeds.PLACES, *feeds.TYPES)
    rows.write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    jobs.relations_job(spark, stream, output, work_folder(spark, "checkpoint"), None, k=3, digits=6,
                       week_start="us", unknown_label="NONE", **_TYPED).awaitTermination()
    return relations.read_relation_lines(spark, output, relations.TYPE_LINES).select("value")


def relation_files_stream(spark, sf_dir):
    """Both outputs of the one query, as they are after the last of four deliveries."""
    output, checkpoint = work_folder(spark, "output"), work_folder(spark, "checkpoint")
    rows = batched_tone_events(spark, sf_dir).select("ts", "tone", *feeds.PLACES, *feeds.TYPES, "batch")
    _play(spark, rows, lambda stream: jobs.relations_job(
        spark, stream, output, checkpoint, None, digits=6, **_TYPED))
    outputs = [relations.read_relation_lines(spark, output, name).select(
        F.lit(name).alias("output"), "batch", "value")
        for name in (relations.PAIR_LINES, relations.TYPE_LINES)]
    return outputs[0].unionByName(outputs[1])


def actor_type_top5_touched_stream(spark, sf_dir):
    """The ranking each micro-batch writes."""
    rows = batched_tone_events(spark, sf_dir)
    ddl = "week date, c1 string, c2 string, actor_type string, n long, mean_tone double, rank int"
    ranked = _delivered(
        spark, rows, lambda s: relations.relation_updates(s, pairs=False, **_TYPED),
        write=lambda updates, prefix, batch_id: sinks.write_table_batch(
            relations.type_results(updates), prefix, batch_id), ddl=ddl)
    return rounded(ranked, "mean_tone")


def _written(spark: SparkSession, result: DataFrame, mode: str) -> DataFrame:
    """Run a streaming result over all there is and read back what it wrote."""
    output = work_folder(spark, "output")
    sinks.start_batches(result, lambda df, i: sinks.write_table_batch(df, output, i),
                        work_folder(spark, "checkpoint"), mode, None).awaitTermination()
    return sinks.read_table_batches(spark, output, _ddl(result))


def _delivered(spark: SparkSession, rows: DataFrame,
               result_of: Callable[[DataFrame], DataFrame],
               write: Callable[[DataFrame, str, int], None] = sinks.write_table_batch,
               ddl: str | None = None, mode: str = "update") -> DataFrame:
    """What a streaming result writes over the deliveries, the rows of one ``batch`` value each."""
    output, checkpoint, found = work_folder(spark, "output"), work_folder(spark, "checkpoint"), []

    def start(stream: DataFrame) -> StreamingQuery:
        result = result_of(stream)
        found.append(_ddl(result))
        return sinks.start_batches(result, lambda df, i: write(df, output, i), checkpoint, mode, None)
    _play(spark, rows, start)
    return sinks.read_table_batches(spark, output, ddl or found[0])


def _play(spark: SparkSession, rows: DataFrame,
          start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Start a query once per delivery.

    Each run finds the files of one more delivery and goes on from the checkpoint, so that every
    delivery is one micro-batch, whatever the number of its files.
    """
    landing = work_folder(spark, "landing")
    rows.write.partitionBy("batch").parquet(landing)
    schema = rows.drop("batch").schema
    for arrived in range(1, feeds.BATCHES + 1):
        folders = ",".join(str(batch) for batch in range(arrived))
        start(spark.readStream.schema(schema).parquet(f"{landing}/batch={{{folders}}}")
              ).awaitTermination()


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


QUERIES = {
    "parse_events_stream": parse_events_stream,
    "parse_events_interval_stream": parse_events_interval_stream,
    "event_table_two_feeds": event_table_two_feeds,
    "event_table_compacted": event_table_compacted,
    "daily_tone_sum_stream": daily_tone_sum_stream,
    "daily_tone_sum_late_stream": daily_tone_sum_late_stream,
    "daily_tone_two_feeds_stream": daily_tone_two_feeds_stream,
    "daily_tone_job_lines": daily_tone_job_lines,
    "weekly_tone_job_lines": weekly_tone_job_lines,
    "weekly_halving_file_stream": weekly_halving_file_stream,
    "weekly_halving_avg_stream": weekly_halving_avg_stream,
    "bilateral_tone_stream": bilateral_tone_stream,
    "bilateral_tone_log_stream": bilateral_tone_log_stream,
    "bilateral_tone_feeds": bilateral_tone_feeds,
    "actor_type_top5_stream": actor_type_top5_stream,
    "actor_type_top5_sums_stream": actor_type_top5_sums_stream,
    "actor_type_top5_running_stream": actor_type_top5_running_stream,
    "actor_type_top5_touched_stream": actor_type_top5_touched_stream,
    "relations_job_us": relations_job_us,
    "relation_files_stream": relation_files_stream,
}
