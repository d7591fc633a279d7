"""Committed folders, the event table, merged levels, deliveries from a file, stored sums."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tonescope.operators.halving import SEGMENT, halving_average
from tonescope.plans import relations as batch_relations
from tonescope.plans.weekly_tone import weekly_halving_average
from tonescope.sources import committed, deliveries, files, levels, lines
from tonescope.sources.deliveries import deliver_file, numbered_lines, play_deliveries
from tonescope.streaming import daily, relations, running, sinks, weekly
from tonescope.streaming.jobs import event_table_job, relations_job, running_relations_job
from verification import feeds, stream_queries

D = dt.date
PAIR_DDL = "day date, a string, b string, tone double, t1 string, t2 string, batch int"
PAIR_FEED = {"places": ("a", "b"), "time": "day", "tone": "tone", "types": ("t1", "t2")}


def pair_feed(seed=4, n=200, days=70):
    rng = random.Random(seed)
    return [(D(2024, 1, 1) + dt.timedelta(days=rng.randrange(days)), rng.choice(["A", "B", None]),
             rng.choice(["A", "C", None]), float(rng.randint(-8, 8)),
             rng.choice(["X", "Y", "Z", None]), rng.choice(["X", "W", None]), rng.randrange(3))
            for _ in range(n)]


def deliver(spark, folder, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(ddl).parquet(str(folder))


# Committed folders

def test_only_recorded_folders_count(spark, tmp_path, rows):
    root = str(tmp_path / "root")
    assert committed.committed_batches(spark, root) == []
    assert committed.read_committed(spark, root, "out", "x int").count() == 0
    for batch, values in ((0, [1, 2]), (1, [3])):
        frame = spark.createDataFrame([(v,) for v in values], "x int")
        folders = levels.store_batch(frame, root, "out", "f", batch)
        if batch == 0:
            committed.commit(spark, root, "f", batch, folders)
    assert not committed.is_committed(spark, root, "f", 1)
    assert rows(committed.read_committed(spark, root, "out", "x int")) == [(1, "f", 0), (2, "f", 0)]
    committed.commit(spark, root, "g", 0, [], replaced=[("out", "feed=f/batch=0")])
    assert committed.committed_batches(spark, root) == [("f", 0), ("g", 0)]
    assert committed.read_committed(spark, root, "out", "x int").count() == 0
    with pytest.raises(ValueError):
        committed.batch_folder(root, "out", "a/b", 0)
    with pytest.raises(AnalysisException):
        committed.commit(spark, root, "g", 0, [], mode="errorifexists")


# The event table

def event_texts(event_line, ids, day="20240103"):
    return [event_line(globalEventID=i, dateAdded=day) for i in ids] + ["bad"]


def parsed_of(spark, texts):
    return lines.parse_lines(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_one_table_of_a_load_and_two_streams(spark, tmp_path, rows, event_line):
    table = str(tmp_path / "table")
    for n in (0, 1):
        (tmp_path / f"in{n}").mkdir()
    assert files.write_event_table(parsed_of(spark, event_texts(event_line, [100])), table)
    for round_ in range(2):
        for n in (0, 1):  # both write batches 0 and 1
            (tmp_path / f"in{n}" / f"{round_}.csv").write_text(
                "\n".join(event_texts(event_line, [10 * n + round_])))
            stream = lines.parse_lines(files.stream_lines(spark, str(tmp_path / f"in{n}")))
            event_table_job(stream, table, str(tmp_path / f"cp{n}"), None).awaitTermination()
    assert files.write_event_table(parsed_of(spark, event_texts(event_line, [200])), table, "more")
    assert not files.write_event_table(parsed_of(spark, event_texts(event_line, [300])), table, "more")
    found = files.read_event_table(spark, table)
    assert rows(found, "globalEventID") == [(0,), (1,), (10,), (100,), (11,), (200,)]
    assert files.read_quarantine_table(spark, table).count() == 6


def test_a_load_that_stopped_before_its_record_runs_again(spark, tmp_path, rows, event_line, monkeypatch):
    table = str(tmp_path / "table")

    def stopped(*_, **__):
        raise RuntimeError("stopped")
    with monkeypatch.context() as patch:
        patch.setattr(files, "commit", stopped)
        with pytest.raises(RuntimeError):
            files.write_event_table(parsed_of(spark, event_texts(event_line, [1, 2])), table)
    assert files.read_event_table(spark, table).count() == 0
    assert files.write_event_table(parsed_of(spark, event_texts(event_line, [1, 3])), table)
    assert rows(files.read_event_table(spark, table), "globalEventID") == [(1,), (3,)]


def test_compaction_keeps_rows_and_months(spark, tmp_path, rows, event_line, monkeypatch):
    table = str(tmp_path / "table")
    for n in range(5):
        texts = event_texts(event_line, [n], f"20240{1 + n % 2}03")
        files.write_event_table(parsed_of(spark, texts), table, "load", n)
    before = rows(files.read_event_table(spark, table), "globalEventID", "added_month")

    def data_files():
        return files.read_event_table(spark, table).select("_metadata.file_path").distinct().count()
    assert data_files() == 5
    with monkeypatch.context() as patch:
        patch.setattr(files, "commit", lambda *_, **__: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            files.compact_event_table(spark, table)
    assert rows(files.read_event_table(spark, table), "globalEventID", "added_month") == before
    assert files.compact_event_table(spark, table) == 10  # five of events, five of quarantined lines
    assert files.compact_event_table(spark, table) == 0
    assert data_files() == 2
    assert rows(files.read_event_table(spark, table), "globalEventID", "added_month") == before
    assert files.read_quarantine_table(spark, table).count() == 5
    january = files.read_event_table(spark, table, last=D(2024, 1, 31))
    assert rows(january, "globalEventID") == [(0,), (2,), (4,)]
    # A target that folders exceed leaves them alone, and small ones are still gathered beside them.
    assert files.compact_event_table(spark, table, target_bytes=10) == 0
    files.write_event_table(parsed_of(spark, event_texts(event_line, [9])), table, "later")
    streamed = files.stream_event_table(spark, table).select("globalEventID")
    query = (streamed.writeStream.format("memory").queryName("of_table").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.awaitTermination()
    assert rows(spark.table("of_table")) == [(0,), (1,), (2,), (3,), (4,), (9,)]


def test_a_task_of_the_compaction_fills_one_file_and_does_not_sort(spark, tmp_path, event_line,
                                                                     monkeypatch):
    table, stored = str(tmp_path / "table"), []
    for n in range(16):
        texts = event_texts(event_line, [n], f"20240{1 + n % 8}03")
        files.write_event_table(parsed_of(spark, texts), table, "load", n)
    store = files._store

    def watched(frame, folder):
        sort = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
        stored.append((sort, folder))
        store(frame, folder)
    monkeypatch.setattr(files, "_store", watched)
    assert files.compact_event_table(spark, table) == 32
    (sort, folder), = stored
    tasks = [path.name.split("-")[1] for path in (tmp_path / "table").rglob("part-*.parquet")
             if str(path).startswith(folder)]
    assert len(tasks) == len(set(tasks)) == 9  # eight months of events, quarantined lines of no month
    assert not sort and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


# Levels

@pytest.mark.parametrize("ratio", [0.25, 1, 2])
def test_what_remains_is_geometric(ratio):
    draw, sizes = random.Random(3), []
    row = levels.Row("bytes", "folder")
    rewritten = 0
    for n in range(400):
        sizes.append(draw.randint(50, 150))
        chosen = levels.to_merge([row(s, str(i)) for i, s in enumerate(sizes)], ratio)
        if chosen:
            for r in chosen:
                sizes.remove(r.bytes)
            rewritten += sum(r.bytes for r in chosen)
            sizes.append(min(2000, sum(r.bytes for r in chosen)))  # 2000: a row for every key
        ordered = sorted(sizes)
        assert all(x >= ratio * sum(ordered[:i]) for i, x in enumerate(ordered) if i)
        assert sum(ordered) <= (1 + 1 / ratio) * ordered[-1]
    assert len(chosen) != 1 and len(sizes) < 20


def test_merging_keeps_the_newest_of_every_key(spark, tmp_path, rows):
    root, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    data, ddl = pair_feed(n=300), PAIR_DDL
    for part in range(10):
        stream = deliver(spark, tmp_path / "in", data[part * 30:part * 30 + 30], ddl)
        updates = relations.relation_updates(stream, **PAIR_FEED)
        sinks.start_batches(updates, running.relation_log(root, checkpoint), checkpoint, "update",
                            None).awaitTermination()
    assert len(committed.live_folders(spark, root, running.LOG)) < 10
    events = spark.createDataFrame(data, ddl)
    state = running.read_log(spark, root)
    assert rows(relations.pair_results(state)) == rows(
        batch_relations.bilateral_tone(events, places=("a", "b"), time="day", tone="tone"))
    assert rows(relations.type_results(state, 2)) == rows(
        batch_relations.actor_type_top(events, 2, **PAIR_FEED))


# Stored sums

def test_feeds_add_up_to_the_whole(spark, tmp_path, rows):
    root, data = str(tmp_path / "sums"), pair_feed(n=400)
    events = spark.createDataFrame(data, PAIR_DDL)
    for n in range(8):
        part = spark.createDataFrame(data[n * 50:n * 50 + 50], PAIR_DDL)
        assert running.add_feed(part, root, f"feed{n % 2}", n // 2, **PAIR_FEED)
    assert not running.add_feed(events, root, "feed1", 3, **PAIR_FEED)
    while running.merge_sums(spark, root):
        pass
    assert rows(running.read_sums(spark, root)) == rows(relations.relation_updates(events, **PAIR_FEED))
    names = {levels.partition_of(r.folder) for r in committed.live_folders(spark, root, "sums")}
    assert names == {"month=202401", "month=202402", "month=202403"}


def test_running_ranking_is_among_all_types_so_far(spark, tmp_path, rows):
    root, checkpoint, data = str(tmp_path / "sums"), str(tmp_path / "cp"), pair_feed(n=240, days=20)
    for batch in range(3):
        stream = deliver(spark, tmp_path / "in", [r for r in data if r[6] == batch], PAIR_DDL)
        running_relations_job(spark, stream, root, checkpoint, None, k=2, **PAIR_FEED).awaitTermination()
    tops, pairs = running.read_tops(spark, root), running.read_pairs(spark, root)
    for batch in range(3):
        so_far = spark.createDataFrame([r for r in data if r[6] <= batch], PAIR_DDL)
        now = so_far.where(F.col("batch") == batch)
        group = ["week", "c1", "c2"]
        for got, plan, columns in (
                (tops, lambda e: batch_relations.actor_type_top(e, 2, **PAIR_FEED), tops.columns[:-2]),
                (pairs, lambda e: batch_relations.bilateral_tone(
                    e, places=("a", "b"), time="day", tone="tone"), pairs.columns[:-2])):
            touched = plan(now).select(*group).distinct()
            want = plan(so_far).join(touched, group, "left_semi")
            assert rows(got.where(F.col("batch") == batch), *columns) == rows(want, *columns)


# Two outputs of one batch

@pytest.mark.parametrize("broken", ["week", "record"])
def test_a_crash_between_two_outputs_shows_neither(spark, tmp_path, rows, event_line, monkeypatch,
                                                   broken):
    source, output, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()

    def run(n):
        text = event_line(globalEventID=n, avgTone=float(n), actor1Geo_countryCode="US",
                          actor2Geo_countryCode="FR", actor1Code_type1Code="GOV")
        (source / f"{n}.csv").write_text(text + "\n")
        relations_job(spark, str(source), output, checkpoint, None).awaitTermination()

    def shown(name):
        return rows(relations.read_relation_lines(spark, output, name).select("batch", "value"))
    run(1)
    write = relations.write_text_batch

    def crash(rows_, prefix, batch_id):
        if "/week/" in prefix:
            raise RuntimeError("stopped")
        write(rows_, prefix, batch_id)
    with monkeypatch.context() as patch:
        patch.setattr(relations, *(("write_text_batch", crash) if broken == "week" else (
            "commit", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("stopped")))))
        with pytest.raises(Exception, match="stopped"):
            run(3)
    first = [(0, "FR;US;2024-01-01;1.0"), (0, "US;FR;2024-01-01;1.0")]
    assert shown("bilateral_relationships") == first and len(shown("week")) == 2
    relations_job(spark, str(source), output, checkpoint, None).awaitTermination()
    assert shown("bilateral_relationships") == first + [
        (1, "FR;US;2024-01-01;2.0"), (1, "US;FR;2024-01-01;2.0")]
    assert shown("week")[-1] == (1, "US;FR;2024-01-01;[(GOV,2,2.0)]")


def test_a_batch_recorded_before_the_crash_is_not_written_twice(spark, tmp_path, rows, event_line,
                                                                monkeypatch):
    """The query dies after its record and before its own log: state goes on, results stay."""
    source, output, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    line = event_line(avgTone=2.0, actor1Geo_countryCode="US", actor2Geo_countryCode="FR")
    (source / "0.csv").write_text(line + "\n")
    whole = relations.commit

    def crash(*args, **kwargs):
        whole(*args, **kwargs)
        raise RuntimeError("stopped")
    with monkeypatch.context() as patch:
        patch.setattr(relations, "commit", crash)
        with pytest.raises(Exception, match="stopped"):
            relations_job(spark, str(source), output, checkpoint, None).awaitTermination()
    (source / "1.csv").write_text(line.replace("2.0", "4.0") + "\n")
    relations_job(spark, str(source), output, checkpoint, None).awaitTermination()
    found = relations.read_relation_lines(spark, output, "bilateral_relationships")
    assert rows(found.where("value LIKE 'US%'"), "batch", "value") == [
        (0, "US;FR;2024-01-01;2.0"), (1, "US;FR;2024-01-01;3.0")]


# Deliveries from one file

@pytest.mark.parametrize("block_bytes", [7, 64, 1 << 20])
def test_lines_are_numbered_in_the_order_of_the_file(spark, tmp_path, rows, block_bytes):
    texts = [f"{n}\t" + "é" * (n % 13) for n in range(300)]
    (tmp_path / "a.csv").write_text("\r\n".join(texts[:200]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(texts[200:]))
    found = numbered_lines(spark, f"{tmp_path}/*.csv", block_bytes)
    assert [r.value for r in found.orderBy("line_number").collect()] == texts
    assert found.agg(F.max("line_number")).first()[0] == 299


def test_large_files_are_cut_into_larger_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(deliveries, "BLOCKS", 10, raising=False)
    texts = [f"{n}\t" + "é" * (n % 13) for n in range(2000)]
    (tmp_path / "a.csv").write_text("\n".join(texts[:1500]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(texts[1500:]))
    found = numbered_lines(spark, f"{tmp_path}/*.csv", 128)
    assert 8 <= found.select(F.spark_partition_id()).distinct().count() <= 12
    assert [r.value for r in found.orderBy("line_number").collect()] == texts
    landing = tmp_path / "landing"
    assert deliver_file(spark, f"{tmp_path}/*.csv", str(landing), 300, block_bytes=128) == 7
    assert len(list(landing.glob("delivery=*/part-*"))) <= 12 + 6
    for n in range(7):
        dealt = spark.read.text(f"{landing}/delivery={n}").collect()
        assert sorted(r.value for r in dealt) == sorted(texts[300 * n:300 * n + 300])


def test_blocks_are_cut_neither_below_the_least_nor_above_the_usual_size(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("x" * 999 + "\n")
    monkeypatch.setattr(deliveries, "BLOCKS", 10, raising=False)
    cut = lambda least: deliveries._cut(spark, str(tmp_path), least)
    assert (cut(7), cut(100), cut(5000)) == (100, 100, 5000)
    monkeypatch.setattr(deliveries, "USUAL_BLOCK", 30)
    assert (cut(7), cut(50)) == (30, 50)


def test_every_line_is_in_one_delivery(spark, tmp_path, rows):
    (tmp_path / "feed.csv").write_text("".join(f"{n}\n" for n in range(100)))
    landing = str(tmp_path / "landing")
    assert deliver_file(spark, str(tmp_path / "feed.csv"), landing, 30, block_bytes=50) == 4
    output, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def start(stream):
        return sinks.start_batches(stream, lambda df, n: sinks.write_text_batch(df, output, n),
                                   checkpoint, "append", None)
    play_deliveries(spark, landing, 2, start)
    play_deliveries(spark, landing, 4, start)  # goes on after the second
    found = sinks.read_text_batches(spark, output).collect()
    assert sorted((r.batch, int(r.value)) for r in found) == [(n // 30, n) for n in range(100)]
    (tmp_path / "empty.csv").write_text("")
    assert deliver_file(spark, str(tmp_path / "empty.csv"), str(tmp_path / "none"), 30) == 0


def test_no_file_of_a_feed_holds_all_its_lines(spark, tmp_path, monkeypatch):
    spark.range(1000).selectExpr(
        "999 - id AS event_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 30) AS ts",
        "id % 7 AS user_id", "if(id % 2 = 0, 'click', 'view') AS event_type", "id % 90 / 2.0 AS value",
        "'p' AS props").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    sizes = []

    def delivered(spark, path, *given, **named):
        sizes.extend(r.n for r in spark.read.text(path).groupBy(F.input_file_name()).agg(
            F.count("*").alias("n")).collect())
        return deliver_file(spark, path, *given, **named)
    monkeypatch.setattr(stream_queries, "deliver_file", delivered)
    monkeypatch.setattr(feeds, "FILE_LINES", 100, raising=False)
    found = stream_queries.weekly_halving_file_stream(spark, str(tmp_path)).collect()
    assert sum(sizes) == 1000 and len(sizes) > 5 and max(sizes) < 300
    want = {}
    for event in sorted(range(1000)):
        n = 999 - event
        if n % 2 == 0:
            week = D(2024, 1, 1) + dt.timedelta(days=n % 30 // 7 * 7)
            key = week, event // 167
            want[key] = want.get(key, 0.0) + n % 90 / 2.0
    average = {}
    for week, batch in sorted(want, key=lambda key: key[1]):
        average[week] = want[week, batch] = (want[week, batch] + average.get(week, 0.0)) / 2
    assert {(r.week, r.batch): r.average for r in found} == {
        key: pytest.approx(value, abs=1e-5) for key, value in want.items()}


# The halving average

def test_a_week_of_very_many_batches(spark):
    n = 1_000_000
    values = F.pmod(F.col("id") * 7919, F.lit(1000)) / 10 - 50
    sums = spark.range(n).select(F.lit("w").alias("week"), F.col("id").alias("batch"), values.alias("v"))
    got = {r.batch: r.average for r in halving_average(sums, "week", "batch", "v").where(
        f"batch % {SEGMENT * SEGMENT} IN (0, 1, {SEGMENT * SEGMENT - 1}) OR batch > {n - 3}").collect()}
    average = 0.0
    for i in range(n):
        average = ((i * 7919 % 1000) / 10 - 50 + average) / 2
        if i in got:
            assert got[i] == pytest.approx(average, abs=1e-12)
    assert len(got) > 40


@pytest.mark.parametrize("segment", [2, 5])
def test_levels_of_the_scan(spark, monkeypatch, segment):
    monkeypatch.setattr("tonescope.operators.halving.SEGMENT", segment)
    draw, want = random.Random(segment), {}
    data = [(key, b, draw.uniform(-5, 5)) for key in ("a", None)
            for b in sorted(draw.sample(range(-40, 400), 250))]
    data += [("endless", b, float("inf") if b == 9 else 1.0) for b in range(0, 9000, 9)]
    data += [("both", b, {9: float("inf"), 90: float("-inf")}.get(b, 1.0)) for b in range(0, 900, 9)]
    for key in {d[0] for d in data}:
        average = 0.0
        for _, b, v in sorted((d for d in data if d[0] == key), key=lambda d: d[1]):
            average = want[key, b] = (v + average) / 2
    frame = spark.createDataFrame(data, "w string, b int, v double").repartition(5)
    got = {(r.w, r.b): r.average for r in halving_average(frame, "w", "b", "v").collect()}
    assert got == pytest.approx(want, abs=1e-12, nan_ok=True)


def test_closed_weeks_leave_the_halving_state(spark, tmp_path, rows):
    ddl, feed = "c string, d date, v double", {"key": "c", "time": "d", "tone": "v"}
    output, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    batches = [[("USA", D(2024, 1, 3), 8.0), ("USA", D(2024, 1, 10), 4.0), ("USA", None, 1.0)],
               [("USA", D(2024, 1, 4), 8.0), ("FRA", D(2024, 3, 1), 4.0)],
               [("USA", D(2024, 1, 17), 2.0)],  # closes the first week: it ended over 3 days before
               [("USA", D(2024, 1, 5), 100.0), ("USA", D(2024, 1, 11), 6.0)],
               [("USA", D(2024, 3, 1), 2.0)], [("USA", D(2024, 3, 2), 2.0)]]
    for batch in batches:
        stream = deliver(spark, tmp_path / "in", batch, ddl)
        averages = weekly.weekly_halving_stream(stream, "USA", keep_open="3 days", **feed)
        query = sinks.start_batches(averages, lambda df, n: sinks.write_table_batch(df, output, n),
                                    checkpoint, "update", None)
        query.awaitTermination()
    got = sinks.read_table_batches(spark, output, "week date, average double").drop("batch")
    first, second, third, march = D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 15), D(2024, 2, 26)
    assert sorted(map(tuple, got.collect())) == [
        (first, 4.0), (first, 6.0), (second, 2.0), (second, 4.0), (third, 1.0), (march, 1.0), (march, 1.5)]
    state = query.recentProgress[-1].stateOperators[0]
    assert state.numRowsTotal <= 4  # the open week's number, its timer and their index


def test_state_without_end_equals_keep_open_while_open(spark, tmp_path, rows):
    ddl, feed = "c string, d date, v double, batch int", {"key": "c", "time": "d", "tone": "v"}
    draw = random.Random(1)
    data = [("USA", D(2024, 1, 1) + dt.timedelta(days=draw.randrange(30)), draw.uniform(-5, 5),
             draw.randrange(3)) for _ in range(60)]
    for batch in range(3):
        stream = deliver(spark, tmp_path / "in", [r for r in data if r[3] == batch], ddl)
        averages = weekly.weekly_halving_stream(stream, "USA", keep_open="60 days", week_start="us", **feed)
        sinks.start_batches(averages, lambda df, n: sinks.write_table_batch(df, str(tmp_path / "o"), n),
                            str(tmp_path / "cp"), "update", None).awaitTermination()
    got = sinks.read_table_batches(spark, str(tmp_path / "o"), "week date, average double")
    whole = weekly_halving_average(spark.createDataFrame(data, ddl), "batch", "USA", week_start="us", **feed)
    nine = F.round("average", 9)
    # A batch without data, which only moves time on, has a number too.
    assert rows(got.select("week", nine)) == rows(whole.select("week", nine))


# Late rows

def test_late_rows_are_dropped_but_not_those_of_a_slower_feed(spark, tmp_path, rows):
    ddl = "c string, d timestamp_ntz, v double"

    def day(n):
        return dt.datetime(2024, 1, n)
    fast = [[("USA", day(1), 1.0), ("USA", day(20), 1.0)], [("USA", day(21), 1.0)], [("USA", day(22), 1.0)]]
    slow = [[("USA", day(1), 10.0)], [("USA", day(2), 10.0)], [("USA", day(3), 10.0)]]
    for name, batches in (("fast", fast), ("slow", slow)):
        for batch in batches:
            deliver(spark, tmp_path / name, batch, ddl)
    feed = {"key": "c", "time": "d", "tone": "v"}

    def run(name, result_of):
        streams = [spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(
            str(tmp_path / x)) for x in ("fast", "slow")]
        query = sinks.start_batches(result_of(streams), lambda df, n: sinks.write_table_batch(
            df, str(tmp_path / name), n), str(tmp_path / f"{name}-cp"), "append", None)
        query.awaitTermination()
        got = sinks.read_table_batches(spark, str(tmp_path / name), (
            "c string, tone_sum double, window_start timestamp_ntz, window_end timestamp_ntz"))
        dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
                      for op in p["stateOperators"])
        return rows(got, "tone_sum", "window_start"), dropped

    both = run("both", lambda streams: daily.daily_tone_stream(streams, "USA", **feed))
    assert both == ([(10.0, day(2)), (11.0, day(1))], 0)  # closed up to the slower feed's third day
    one = run("one", lambda streams: daily.daily_tone_stream(streams[0].unionByName(streams[1]), "USA", **feed))
    assert one[1] == 1 and (1.0, day(20)) in one[0] and (10.0, day(3)) not in one[0]
