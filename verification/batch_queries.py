"""Queries over complete tables. Floating-point results are rounded, as sums differ by order; those
of exact sums are not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescope.functions.rendering import ranking_text
from tonescope.functions.times import ISO, US, week_monday
from tonescope.operators.fanout import both_directions, each_type
from tonescope.operators.lateness import mark_late
from tonescope.operators.selection import of_country, or_unknown, with_both
from tonescope.plans import daily_tone, relations, weekly_tone
from tonescope.session import work_folder
from tonescope.sources import lines
from tonescope.sources.files import (read_event_files, read_event_table, read_quarantine_table,
                                     write_event_table)
from tonescope.streaming.sinks import read_text_batches, write_text_batch

from . import feeds

_FEED = {"key": "event_type", "time": "ts", "tone": "value"}
_PAIRS = {"places": feeds.PLACES, "time": "ts", "tone": "tone"}
_TYPED = {**_PAIRS, "types": feeds.TYPES}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def parse_events(spark, sf_dir):
    return lines.events(lines.parse_lines(feeds.event_lines(spark, sf_dir)))


def parse_rules(spark, sf_dir):
    parsed = lines.parse_lines(feeds.rule_lines(spark, sf_dir))
    return lines.events(parsed).select("globalEventID", *feeds.RULES)


def quarantine(spark, sf_dir):
    return lines.quarantine_counts(lines.parse_lines(feeds.odd_lines(spark, sf_dir)))


def cell_errors(spark, sf_dir):
    return lines.cell_errors(feeds.rule_lines(spark, sf_dir))


def event_table_summary(spark, path):
    kept = read_event_table(spark, path).select("globalEventID", "sourceUrl", "added_month")
    bad = read_quarantine_table(spark, path)
    return (kept.select(F.lit("ok").alias("status"), "added_month", "globalEventID", "sourceUrl")
            .unionByName(bad.select(F.col("reason").alias("status")), allowMissingColumns=True)
            .groupBy("status", "added_month")
            .agg(F.count("*").alias("n"), F.count("sourceUrl").alias("n_urls"),
                 F.sum("globalEventID").alias("id_sum")))


def event_table_roundtrip(spark, sf_dir):
    path = work_folder(spark, "event-table")
    write_event_table(lines.parse_lines(feeds.odd_lines(spark, sf_dir)), path)
    return event_table_summary(spark, path)


def parse_events_files(spark, sf_dir):
    """The lines as files, read by the bounded scan."""
    folder = work_folder(spark, "lines")
    feeds.event_lines(spark, sf_dir).repartition(3).write.text(folder)
    return read_event_files(spark, folder)


def country_filter(spark, sf_dir):
    return of_country(feeds.events(spark, sf_dir), feeds.COUNTRY, "event_type").select(
        "event_id", "event_type", "value")


def week_bucket(week_start):
    def query(spark, sf_dir):
        return feeds.events(spark, sf_dir).select(
            "event_id", week_monday(F.col("ts"), week_start).alias("week"))
    return query


def pair_fanout(spark, sf_dir):
    rows = feeds.tone_events(spark, sf_dir).select("l_orderkey", "l_linenumber", "c1", "c2",
                                                   "tone")
    return both_directions(with_both(rows, "c1", "c2"), "c1", "c2")


def type_unpivot(spark, sf_dir):
    rows = feeds.tone_events(spark, sf_dir).select("l_orderkey", "l_linenumber", "c1", "c2",
                                                   *feeds.TYPES)
    return each_type(or_unknown(rows, "c1", "c2"), feeds.TYPES)


def daily_tone_sum(spark, sf_dir):
    return rounded(daily_tone.daily_tone_sum(feeds.events(spark, sf_dir), feeds.COUNTRY, **_FEED),
                   "tone_sum")


def late_split(spark, sf_dir):
    rows = feeds.events(spark, sf_dir).withColumn("batch", F.col("event_id") * 7 % 10)
    return mark_late(rows, "ts", "batch", delay="2 days").select("event_id", "batch", "late")


def daily_tone_sum_exact(spark, sf_dir):
    return daily_tone.daily_tone_sum(feeds.events(spark, sf_dir), feeds.COUNTRY, exact=True, **_FEED)


def bilateral_tone_exact(spark, sf_dir):
    return relations.bilateral_tone(feeds.tone_events(spark, sf_dir), exact=True, **_PAIRS)


def actor_type_stats_exact(spark, sf_dir):
    return relations.actor_type_stats(feeds.tone_events(spark, sf_dir), exact=True, **_TYPED)


def weekly_tone_sum(spark, sf_dir):
    return rounded(weekly_tone.weekly_tone_sum(feeds.events(spark, sf_dir), feeds.COUNTRY,
                                               **_FEED), "tone_sum")


def weekly_halving_avg(spark, sf_dir):
    rows = feeds.events(spark, sf_dir).withColumn("batch", F.col("event_id") % feeds.BATCHES)
    return rounded(weekly_tone.weekly_halving_average(rows, "batch", feeds.COUNTRY, **_FEED),
                   "average")


def bilateral_tone(week_start):
    def query(spark, sf_dir):
        return rounded(relations.bilateral_tone(feeds.tone_events(spark, sf_dir),
                                                week_start=week_start, **_PAIRS), "mean_tone")
    return query


def actor_type_stats(spark, sf_dir):
    return rounded(relations.actor_type_stats(feeds.tone_events(spark, sf_dir), **_TYPED),
                   "mean_tone")


def actor_type_top5(week_start):
    def query(spark, sf_dir):
        return rounded(relations.actor_type_top(feeds.tone_events(spark, sf_dir),
                                                week_start=week_start, **_TYPED), "mean_tone")
    return query


def actor_type_top5_list(spark, sf_dir):
    lists = relations.actor_type_top_list(feeds.tone_events(spark, sf_dir), **_TYPED)
    return lists.withColumn("ranking", ranking_text(F.col("ranking"), 6))


def batched_tone_events(spark, sf_dir):
    return feeds.tone_events(spark, sf_dir).withColumn(
        "batch", (F.col("l_orderkey") + F.col("l_linenumber")) % feeds.BATCHES)


def actor_type_top5_touched(spark, sf_dir):
    return rounded(relations.actor_type_top_touched(batched_tone_events(spark, sf_dir), "batch",
                                                    **_TYPED), "mean_tone")


def render_bilateral(spark, sf_dir):
    pairs = relations.bilateral_tone(feeds.tone_events(spark, sf_dir), **_PAIRS)
    return relations.bilateral_lines(pairs, digits=6)


def render_top5(spark, sf_dir):
    lists = relations.actor_type_top_list(feeds.tone_events(spark, sf_dir), **_TYPED)
    return relations.ranking_lines(lists, digits=6)


def render_weekly(spark, sf_dir):
    rows = feeds.events(spark, sf_dir).withColumn("batch", F.col("event_id") % feeds.BATCHES)
    averages = weekly_tone.weekly_halving_average(rows, "batch", feeds.COUNTRY, **_FEED)
    return weekly_tone.weekly_lines(averages, feeds.COUNTRY, digits=6)


def text_sink_roundtrip(spark, sf_dir):
    prefix = work_folder(spark, "text-sink")
    write_text_batch(render_bilateral(spark, sf_dir), prefix, 0)
    return read_text_batches(spark, prefix).select("value")


QUERIES = {
    "parse_events": parse_events,
    "parse_events_files": parse_events_files,
    "parse_rules": parse_rules,
    "quarantine": quarantine,
    "cell_errors": cell_errors,
    "event_table_roundtrip": event_table_roundtrip,
    "country_filter": country_filter,
    "week_bucket_iso": week_bucket(ISO),
    "week_bucket_us": week_bucket(US),
    "pair_fanout": pair_fanout,
    "type_unpivot": type_unpivot,
    "daily_tone_sum": daily_tone_sum,
    "late_split": late_split,
    "daily_tone_sum_exact": daily_tone_sum_exact,
    "bilateral_tone_exact": bilateral_tone_exact,
    "actor_type_stats_exact": actor_type_stats_exact,
    "weekly_tone_sum": weekly_tone_sum,
    "weekly_halving_avg": weekly_halving_avg,
    "bilateral_tone": bilateral_tone(ISO),
    "bilateral_tone_us": bilateral_tone(US),
    "actor_type_stats": actor_type_stats,
    "actor_type_top5": actor_type_top5(ISO),
    "actor_type_top5_us": actor_type_top5(US),
    "actor_type_top5_list": actor_type_top5_list,
    "actor_type_top5_touched": actor_type_top5_touched,
    "render_bilateral": render_bilateral,
    "render_top5": render_top5,
    "render_weekly": render_weekly,
    "text_sink_roundtrip": text_sink_roundtrip,
}
