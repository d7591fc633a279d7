import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tonescope.functions.cells import READERS
from tonescope.sources import lines
from tonescope.sources.files import (read_event_files, read_event_table, read_lines,
                                     read_quarantine_table, stream_event_files, stream_event_table,
                                     stream_lines,                                     write_event_table)
from tonescope.sources.layout import FIELDS, NAMES
from tonescope.streaming.jobs import event_table_job

CELLS = [
    ("int", "7", 7), ("int", "+5", 5), ("int", "-5", -5), ("int", "2147483647", 2147483647),
    ("int", "2147483648", None), ("int", "1.0", None), ("int", "1e3", None), ("int", " 5 ", None),
    ("int", "5\r", None), ("int", "", None), ("int", "-", None),
    ("double", "-2.5", -2.5), ("double", "1e3", 1000.0), ("double", "1d", 1.0),
    ("double", " 7 ", 7.0), ("double", "abc", None), ("double", "", None),
    ("double", "Infinity", math.inf), ("double", "-Infinity", -math.inf),
    ("double", "inf", None), ("double", "infinity", None), ("double", "nan", None),
    ("double", "-INF", None), ("double", "1e400", math.inf),
    ("date", "20180101", dt.date(2018, 1, 1)), ("date", "20180230", None),
    ("date", "2018010", None), ("date", "201801011", None), ("date", "20180101x", None),
    ("date", " 20180101", None), ("date", "2018-1-1", None), ("date", "", None),
    ("boolean", "1", True), ("boolean", "0", False), ("boolean", "x", False),
    ("boolean", "true", False), ("boolean", "", None),
    ("string", '"q', '"q'), ("string", " a ", " a "), ("string", "", None),
]


@pytest.mark.parametrize("kind", READERS)
def test_cells(spark, kind):
    cases = [(text, value) for k, text, value in CELLS if k == kind]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, t string")
    got = dict(df.select("i", READERS[kind](F.col("t"))).collect())
    assert [got[i] for i in range(len(cases))] == [value for _, value in cases]


def test_nan_is_read(spark):
    df = spark.createDataFrame([("NaN",)], "t string")
    assert math.isnan(df.select(READERS["double"](F.col("t"))).first()[0])


def test_layout():
    assert len(FIELDS) == 58
    assert [NAMES.index(n) for n in ("actor1Code_countryCode", "isRoot", "avgTone",
                                     "actor1Geo_countryCode", "actor2Geo_countryCode",
                                     "dateAdded", "sourceUrl")] == [7, 25, 34, 37, 44, 56, 57]


def test_line_shapes(spark, event_line, rows):
    whole = event_line(globalEventID=1, sourceUrl="u")
    cases = [
        whole,
        "\t".join(event_line(globalEventID=2).split("\t")[:57]),   # no sourceUrl
        "\t".join(event_line(globalEventID=3).split("\t")[:40]),   # ends inside a group
        whole + "\tmore", whole + "\t\t", "", "  ",
        event_line(globalEventID=4, dateAdded="20189999"),
        event_line(globalEventID="x", avgTone="y", actor1Code_name='"q\''),
    ]
    parsed = lines.parse_lines(spark.createDataFrame([(c,) for c in cases], "value string"))
    assert rows(lines.events(parsed), "globalEventID", "avgTone", "actor1Code_name",
                "sourceUrl") == sorted([
        (1, None, None, "u"), (2, None, None, None), (1, None, None, "u"),
        (None, None, '"q\'', None)], key=repr)
    assert rows(lines.quarantine(parsed)) == sorted([
        (cases[2], "no_date"), (cases[3], "too_many_fields"), ("", "blank"), ("  ", "blank"),
        (cases[7], "no_date")], key=repr)
    assert rows(lines.quarantine_counts(parsed)) == [
        ("blank", 2), ("no_date", 2), ("too_many_fields", 1)]


def test_cell_errors(spark, event_line):
    df = spark.createDataFrame([(event_line(quadClass="x", day="2018"),),
                                (event_line(quadClass="y", goldstein="1.5"),)], "value string")
    errors = {name: n for name, n in lines.cell_errors(df).collect() if n}
    assert errors == {"quadClass": 2, "day": 1}


def test_line_ends(spark, tmp_path, rows):
    path = tmp_path / "feed.csv"
    path.write_bytes("a\r\nb\nc\rd\r\r\né".encode())
    assert rows(read_lines(spark, str(path))) == [("a",), ("b",), ("c\rd\r",), ("é",)]


def _drain(stream, spark, tmp_path, name):
    query = (stream.writeStream.format("memory").queryName(name).trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / name)).start())
    query.awaitTermination()
    return spark.table(name)


def test_stream_of_a_single_file_and_of_a_folder(spark, tmp_path, rows, event_line):
    path = tmp_path / "in" / "feed.csv"
    path.parent.mkdir()
    path.write_text("\r\n".join(event_line(globalEventID=i) for i in range(3)) + "\r\n\r\n")
    for i, source in enumerate((path, path.parent, f"{path.parent}/*.csv")):
        events = stream_event_files(spark, str(source))
        got = _drain(events, spark, tmp_path, f"single_{i}")
        assert rows(got, "globalEventID", "sourceUrl") == [(0, None), (1, None), (2, None)]
    assert read_event_files(spark, str(path)).count() == 3


def test_event_table(spark, tmp_path, rows, event_line):
    texts = [event_line(globalEventID=1, dateAdded="20240131"),
             event_line(globalEventID=2, dateAdded="20240201"), "bad"]
    parsed = lines.parse_lines(spark.createDataFrame([(t,) for t in texts], "value string"))
    table = str(tmp_path / "table")
    write_event_table(parsed, table, rebalance=True)
    events = read_event_table(spark, table)
    assert rows(events, "globalEventID", "added_month") == [(1, 202401), (2, 202402)]
    assert rows(read_quarantine_table(spark, table)) == [("bad", "no_date")]
    day = dt.date(2024, 2, 1)
    assert rows(read_event_table(spark, table, first=day), "globalEventID") == [(2,)]
    assert rows(read_event_table(spark, table, last=dt.date(2024, 1, 31)),
                "globalEventID") == [(1,)]
    some = read_event_table(spark, table, day, day).select("globalEventID")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "added_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<globalEventID:int,dateAdded:date>" in plan


def test_event_table_job_resumes_without_duplicates(spark, tmp_path, rows, event_line):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(event_line(globalEventID=i) + "\nbad\n")
        parsed = lines.parse_lines(stream_lines(spark, source, max_files=1))
        event_table_job(parsed, table, checkpoint, None).awaitTermination()
    assert rows(read_event_table(spark, table), "globalEventID") == [(0,), (1,), (2,)]
    assert read_quarantine_table(spark, table).count() == 3
    streamed = stream_event_table(spark, table, max_files=1).select("globalEventID", "dateAdded")
    assert rows(_drain(streamed, spark, tmp_path, "from_table")) == [
        (i, dt.date(2024, 1, 3)) for i in range(3)]


def test_micro_batches_by_size(spark, tmp_path, event_line):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(event_line(globalEventID=i) + "\n")
    stream = stream_event_files(spark, str(tmp_path / "in"), max_bytes=100)
    query = (stream.writeStream.format("noop").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
