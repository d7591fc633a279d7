import datetime as dt
import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tonescope.operators.lateness import mark_late
from tonescope.plans import relations as batch_relations
from tonescope.plans.daily_tone import daily_tone_sum
from tonescope.plans.weekly_tone import weekly_halving_average
from tonescope.session import work_folder
from tonescope.sources.files import read_event_files
from tonescope.streaming import sinks
from tonescope.streaming.daily import daily_tone_stream
from tonescope.streaming.jobs import (daily_tone_job, relations_job, results_folder,
                                      weekly_tone_job)
from tonescope.streaming.relations import (latest, pair_results, relation_updates, type_results,
                                           UPDATES_DDL)
from tonescope.streaming.weekly import weekly_halving_stream

D = dt.date
FEED = {"key": "c", "time": "d", "tone": "v"}


class Landing:
    """A folder that receives one file per delivery, and a query that runs once after each."""

    def __init__(self, spark, tmp_path, ddl):
        self.spark, self.ddl = spark, ddl
        self.source, self.output, self.checkpoint = (
            str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def deliver(self, rows):
        (self.spark.createDataFrame(rows, self.ddl).coalesce(1)
         .write.mode("append").parquet(self.source))

    def run(self, result_of, mode, write=sinks.write_table_batch, max_files=1000):
        stream = (self.spark.readStream.schema(self.ddl).option("maxFilesPerTrigger", max_files)
                  .parquet(self.source))
        query = sinks.start_batches(result_of(stream), lambda df, i: write(df, self.output, i),
                                    self.checkpoint, mode, None)
        query.awaitTermination()
        return [json.loads(p.json) for p in query.recentProgress]

    def read(self, ddl):
        return sinks.read_table_batches(self.spark, self.output, ddl)


def test_late_rows_are_those_mark_late_names(spark, tmp_path, rows):
    ddl = "c string, d timestamp_ntz, v double, batch long"
    landing = Landing(spark, tmp_path, ddl)
    data = [("USA", dt.datetime(2024, 1, day), float(i + 1), i)
            for i, day in enumerate([10, 5, 5, 5])]
    for row in data:
        landing.deliver([row])
    progress = landing.run(lambda s: daily_tone_stream(s, "USA", **FEED), "append", max_files=1)
    dropped = [op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]]
    emitted = landing.read("c string, tone_sum double, window_start timestamp_ntz, "
                           "window_end timestamp_ntz")
    assert rows(emitted, "tone_sum", "window_start") == [(2.0, dt.datetime(2024, 1, 5))]
    marked = mark_late(spark.createDataFrame(data, ddl), "d", "batch")
    assert rows(marked.where("late"), "v") == [(3.0,), (4.0,)]
    assert dropped[:4] == [0, 0, 1, 1]


def test_daily_stream_equals_batch_but_for_the_open_day(spark, tmp_path, rows):
    landing = Landing(spark, tmp_path, "c string, d date, v double")
    data = [("USA" if i % 3 else "FRA", D(2024, 1, 1) + dt.timedelta(days=i // 10), i * 0.5)
            for i in range(60)]
    for part in range(3):
        landing.deliver(data[part * 20:part * 20 + 20])
        landing.run(lambda s: daily_tone_stream(s, "USA", **FEED), "append")
    got = landing.read("c string, tone_sum double, window_start timestamp_ntz, "
                       "window_end timestamp_ntz").drop("batch")
    whole = daily_tone_sum(spark.createDataFrame(data, landing.ddl), "USA", **FEED)
    assert rows(got) == rows(whole.where("window_start < '2024-01-06'"))


@pytest.mark.parametrize("seed", [1, 2])
def test_halving_stream_equals_batch(spark, tmp_path, rows, seed):
    rng = random.Random(seed)
    ddl = "c string, d date, v double, batch int"
    landing = Landing(spark, tmp_path, ddl)
    data = [("USA", D(2024, 1, 1) + dt.timedelta(days=rng.randrange(40)), rng.uniform(-5, 5),
             rng.randrange(4)) for _ in range(60)]
    for batch in range(4):
        landing.deliver([r for r in data if r[3] == batch])
        landing.run(lambda s: weekly_halving_stream(s, "USA", **FEED), "update")
    got = landing.read("week date, average double")
    whole = weekly_halving_average(spark.createDataFrame(data, ddl), "batch", "USA", **FEED)
    nine = F.round("average", 9)
    assert rows(got.select("week", "batch", nine)) == rows(whole.select("week", "batch", nine))


PAIR_DDL = "day date, a string, b string, tone double, t1 string, t2 string, batch int"
PAIR_FEED = {"places": ("a", "b"), "time": "day", "tone": "tone"}


def pair_feed(seed=4, n=200):
    rng = random.Random(seed)
    return [(D(2024, 1, 1) + dt.timedelta(days=rng.randrange(21)), rng.choice(["A", "B", None]),
             rng.choice(["A", "C", None]), float(rng.randint(-8, 8)),
             rng.choice(["X", "Y", "Z", None]), rng.choice(["X", "W", None]), rng.randrange(3))
            for _ in range(n)]


def test_relation_streams_equal_batch(spark, tmp_path, rows):
    data, types = pair_feed(), ("t1", "t2")
    landing = Landing(spark, tmp_path, PAIR_DDL)
    for batch in range(3):
        landing.deliver([r for r in data if r[6] == batch])
        landing.run(lambda s: relation_updates(s, types=types, **PAIR_FEED), "update")
    updates = landing.read(UPDATES_DDL)
    events = spark.createDataFrame(data, PAIR_DDL)
    state = latest(updates)
    assert rows(pair_results(state)) == rows(batch_relations.bilateral_tone(events, **PAIR_FEED))
    assert rows(type_results(state, 2)) == rows(
        batch_relations.actor_type_top(events, 2, types=types, **PAIR_FEED))
    touched = batch_relations.actor_type_top_touched(events, "batch", 2, types=types, **PAIR_FEED)
    for batch in range(3):
        assert rows(type_results(updates.where(F.col("batch") == batch), 2)) == rows(
            touched.where(F.col("batch") == batch).drop("batch"))


@pytest.mark.parametrize("week_start", ["iso", "us"])
def test_closed_weeks_are_given_up(spark, tmp_path, rows, week_start):
    feed = {**PAIR_FEED, "types": ("t1", "t2"), "week_start": week_start}
    landing = Landing(spark, tmp_path, PAIR_DDL)
    sunday, later = D(2024, 1, 7), D(2024, 3, 1)
    deliveries = [[(sunday, "A", "B", 2.0, "X", None, 0)], [(later, "A", "B", 4.0, "X", None, 1)],
                  [(later, "A", "B", 6.0, None, None, 2)], [(sunday, "A", "B", 8.0, "X", None, 3)]]
    for rows_ in deliveries:
        landing.deliver(rows_)
        progress = landing.run(lambda s: relation_updates(s, keep_open="7 days", **feed), "update")
    label = D(2024, 1, 1) if week_start == "iso" else D(2024, 1, 8)
    pairs = landing.read(UPDATES_DDL).where("actor_type IS NULL")
    assert rows(pairs, "week", "n", "tone_sum") == sorted(
        [(label, 1, 2.0), (D(2024, 2, 26), 1, 4.0), (D(2024, 2, 26), 2, 10.0)], key=repr)
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 2  # one pair, one type


def _feed_file(folder, event_line, name, *events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(event_line(**e) + "\n" for e in events))


def _event(day, c1, c2, tone, *types):
    cells = {"dateAdded": day, "avgTone": tone, "actor1Code_countryCode": "USA"}
    cells |= {"actor1Geo_countryCode": c1, "actor2Geo_countryCode": c2}
    return cells | {f"actor1Code_type{i + 1}Code": t for i, t in enumerate(types)}


def test_relations_job_from_files(spark, tmp_path, rows, event_line):
    source, output = tmp_path / "in", str(tmp_path / "out")
    first = [_event("20240103", "US", "FR", 1.5, "GOV"), _event("20240104", "FR", "US", 2.5, "MIL"),
             _event("20240103", "US", "", 3.0, "GOV"), _event("20240103", "US", "FR", "")]
    for i, events in enumerate((first, [_event("20240105", "US", "FR", 5.0, "GOV")])):
        _feed_file(source, event_line, f"{i}.csv", *events)
        relations_job(spark, str(source), output, str(tmp_path / "cp"), None).awaitTermination()
    pairs = sinks.read_text_batches(spark, f"{output}/bilateral_relationships")
    assert rows(pairs, "batch", "value") == [
        (0, "FR;US;2024-01-01;2.0"), (0, "US;FR;2024-01-01;2.0"),
        (1, "FR;US;2024-01-01;3.0"), (1, "US;FR;2024-01-01;3.0")]
    types = sinks.read_text_batches(spark, f"{output}/week")
    assert rows(types.where("value LIKE 'US;FR%' OR value LIKE 'US;UK%'"), "batch", "value") == [
        (0, "US;FR;2024-01-01;[(GOV,1,1.5), (MIL,1,2.5)]"),
        (0, "US;UKNOWN;2024-01-01;[(GOV,1,3.0)]"),
        (1, "US;FR;2024-01-01;[(GOV,2,3.25)]")]


def test_jobs_write_by_default_print_besides_and_resume(spark, tmp_path, event_line, capsys):
    source, jobs = tmp_path / "in", {"daily": daily_tone_job, "weekly": weekly_tone_job}
    for i, day in enumerate(("20240103", "20240110", "20240117")):
        _feed_file(source, event_line, f"{i}.csv", _event(day, "US", "FR", 8.0))
        for name, job in jobs.items():
            job(spark, str(source), str(tmp_path / name), "USA", None, show=1).awaitTermination()
    days = spark.read.parquet(results_folder(str(tmp_path / "daily")))
    weeks = sinks.read_text_batches(spark, results_folder(str(tmp_path / "weekly")))
    assert (days.count(), weeks.count()) == (2, 3)  # the third day is still open
    assert "AvgTone(4.0)" in capsys.readouterr().out
    assert read_event_files(spark, str(source)).count() == 3


def test_batch_that_runs_again_replaces_its_folder(spark, tmp_path, rows):
    prefix = str(tmp_path / "out")
    for values in (["a", "b"], ["c"]):
        lines = spark.createDataFrame([(v,) for v in values], "value string")
        sinks.write_text_batch(lines, prefix, 7)
    sinks.write_text_batch(lines, prefix, 8)
    assert rows(sinks.read_text_batches(spark, prefix)) == [("c", 7), ("c", 8)]


def test_work_folder_is_shared_or_local(spark):
    assert work_folder(spark, "x") != work_folder(spark, "x")

    def session(shared, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf={"spark.checkpoint.dir": shared}, sparkContext=context)
    assert work_folder(session("hdfs://shared", "yarn"), "x").startswith("hdfs://shared/x-")
    with pytest.raises(ValueError):
        work_folder(session(None, "yarn"), "x")


def test_jobs_write_every_row(spark, tmp_path, event_line, rows):
    days = [f"{y}{m:02d}{d:02d}" for y, m in ((2024, 1), (2024, 3)) for d in range(1, 31)]
    lines = [_event(day, "US", "FR", 1.0) for day in days]
    _feed_file(tmp_path / "in", event_line, "0.csv", *lines)
    # A second file moves the watermark past the first one's days.
    _feed_file(tmp_path / "in", event_line, "1.csv", _event("20240410", "US", "FR", 1.0))
    daily_tone_job(spark, str(tmp_path / "in"), str(tmp_path / "d"), "USA", None, max_files=1,
                   output=str(tmp_path / "days")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "days")).count() == 60
    weekly_tone_job(spark, str(tmp_path / "in"), str(tmp_path / "w"), "USA", None,
                    output=str(tmp_path / "weeks")).awaitTermination()
    assert sinks.read_text_batches(spark, str(tmp_path / "weeks")).count() == 11
