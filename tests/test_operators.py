import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tonescope.functions.times import instant, wall_clock, week_monday, week_window, window_monday
from tonescope.operators.fanout import both_directions, directed, each_type
from tonescope.operators.halving import SEGMENT, halving_average
from tonescope.operators.lateness import BLOCK, mark_late
from tonescope.operators.selection import of_country, or_unknown, with_both
from tonescope.operators.topk import ranking_list, top_k
from tonescope.plans import relations
from tonescope.plans.daily_tone import daily_tone_sum
from tonescope.plans.weekly_tone import weekly_halving_average, weekly_tone_sum

D = dt.date
TYPES = [f"t{i}" for i in range(6)]
PAIR_FEED = {"places": ("a", "b"), "time": "day", "tone": "tone"}
PAIR_DDL = "day date, a string, b string, tone double, " + ", ".join(f"{t} string" for t in TYPES)


def pair_events(spark, *events):
    """(a, b, tone, types...) on Wednesday 2024-01-03."""
    padded = [(D(2024, 1, 3), a, b, tone, *types, *[None] * (6 - len(types)))
              for a, b, tone, *types in events]
    return spark.createDataFrame(padded, PAIR_DDL)


WEEKS = [  # day, iso, us
    (D(2024, 1, 6), D(2024, 1, 1), D(2024, 1, 1)),
    (D(2024, 1, 7), D(2024, 1, 1), D(2024, 1, 8)),
    (D(2024, 1, 8), D(2024, 1, 8), D(2024, 1, 8)),
    (D(2023, 12, 31), D(2023, 12, 25), D(2024, 1, 1)),
    (D(2025, 1, 1), D(2024, 12, 30), D(2024, 12, 30)),
    (D(1969, 12, 28), D(1969, 12, 22), D(1969, 12, 29)),
]


def test_weeks(spark, rows):
    days = spark.createDataFrame([(d,) for d, _, _ in WEEKS], "d date")
    plain = days.select("d", week_monday(F.col("d")), week_monday(F.col("d"), "us"))
    assert rows(plain) == sorted(WEEKS, key=repr)
    at = instant(F.col("d"))
    for i, mode in ((1, "iso"), (2, "us")):
        windowed = days.select("d", window_monday(week_window(at, mode), mode))
        assert rows(windowed) == sorted([(w[0], w[i]) for w in WEEKS], key=repr)
    with pytest.raises(ValueError):
        week_monday(F.col("d"), "fr")


def test_times_do_not_depend_on_the_session_zone(spark, rows):
    events = spark.createDataFrame([("USA", D(2024, 3, 10), 1.0), ("USA", D(2024, 3, 11), 2.0)],
                                   "c string, d date, v double")
    feed = {"key": "c", "time": "d", "tone": "v"}
    times = spark.sql("""SELECT timestamp_ntz'2024-03-10 02:30:00.000001' t, 1710037800000001L micros
        UNION ALL SELECT timestamp_ntz'2024-11-03 01:30:00', 1730597400000000L
        UNION ALL SELECT timestamp_ntz'1969-12-31 23:59:59.999999', -1L
        UNION ALL SELECT timestamp_ntz'1800-01-01 00:00:01', -5364662399000000L""")
    expected = [("USA", 1.0, dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 11)),
                ("USA", 2.0, dt.datetime(2024, 3, 11), dt.datetime(2024, 3, 12))]
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert rows(daily_tone_sum(events, "USA", **feed)) == expected
            assert rows(events.select(wall_clock(instant(F.col("d"))).cast("date"))) == [
                (D(2024, 3, 10),), (D(2024, 3, 11),)]
            at = instant(F.col("t"))
            assert rows(times.select(F.unix_micros(at) == F.col("micros"),
                                     wall_clock(at) == F.col("t"))) == [(True, True)] * 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_country_selection(spark, rows):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, None)], "a string, b string")
    assert rows(of_country(df, "A", "a")) == sorted([("A", "B"), ("A", None)], key=repr)
    assert rows(with_both(df, "a", "b")) == [("A", "B")]
    assert ("UKNOWN", "UKNOWN") in rows(or_unknown(df, "a", "b"))


def test_directions(spark, rows):
    df = spark.createDataFrame([("A", "B", 4), ("A", "A", 5)], "a string, b string, v int")
    assert rows(both_directions(df, "a", "b"), "a", "b", "v") == [
        ("A", "A", 5), ("A", "A", 5), ("A", "B", 4), ("B", "A", 4)]
    assert rows(directed(df, "a", "b"), "a", "b", "v") == [
        ("A", "A", 5), ("A", "B", 4), ("B", "A", 4)]


def test_each_type(spark, rows):
    df = spark.createDataFrame([(1, "X", None, "X"), (2, None, None, None)],
                               "i int, p string, q string, r string")
    assert rows(each_type(df, ["p", "q", "r"])) == [(1, "X"), (1, "X")]


def test_bilateral_tone(spark, rows):
    events = pair_events(spark, ("A", "B", 4.0), ("B", "A", 2.0), ("A", "A", 4.0),
                         ("A", None, 9.0), (None, None, 9.0), ("A", "B", None))
    week = D(2024, 1, 1)
    assert rows(relations.bilateral_tone(events, **PAIR_FEED)) == sorted([
        (week, "A", "B", 2, 3.0), (week, "B", "A", 2, 3.0), (week, "A", "A", 2, 4.0)], key=repr)


def test_actor_types(spark, rows):
    events = pair_events(spark, ("A", "B", 1.0, "GOV"), ("A", "B", 3.0, "GOV", "MIL"),
                         ("A", None, 5.0, "GOV"), ("A", "A", 2.0, "MIL", "MIL"), ("A", "B", 7.0))
    week = D(2024, 1, 1)
    got = rows(relations.actor_type_stats(events, types=TYPES, **PAIR_FEED))
    assert got == sorted([
        (week, "A", "B", "GOV", 2, 2.0), (week, "B", "A", "GOV", 2, 2.0),
        (week, "A", "B", "MIL", 1, 3.0), (week, "B", "A", "MIL", 1, 3.0),
        (week, "A", "UKNOWN", "GOV", 1, 5.0), (week, "UKNOWN", "A", "GOV", 1, 5.0),
        (week, "A", "A", "MIL", 4, 2.0)], key=repr)


def test_top_five(spark, rows):
    counts = {"g": 3, "a": 3, "b": 2, "c": 2, "f": 1, "d": 1, "e": 1}
    events = pair_events(spark, *[("A", "B", 1.0, t) for t, n in counts.items() for _ in range(n)])
    top = relations.actor_type_top(events, types=TYPES, **PAIR_FEED)
    for pair in (("A", "B"), ("B", "A")):
        chosen = top.where((F.col("c1") == pair[0]) & (F.col("c2") == pair[1]))
        assert sorted(rows(chosen, "rank", "actor_type", "n")) == [
            (1, "a", 3), (2, "g", 3), (3, "b", 2), (4, "c", 2), (5, "d", 1)]
    lists = relations.actor_type_top_list(events, types=TYPES, **PAIR_FEED)
    assert rows(relations.ranking_lines(lists))[0] == (
        "A;B;2024-01-01;[(a,3,1.0), (g,3,1.0), (b,2,1.0), (c,2,1.0), (d,1,1.0)]",)
    assert rows(relations.bilateral_lines(relations.bilateral_tone(events, **PAIR_FEED)))[0] == (
        "A;B;2024-01-01;1.0",)


def test_random_feed_against_plain_loops(spark):
    rng = random.Random(5)
    data = [(rng.choice(["A", "A", "B", "C", None]), rng.choice(["A", "B", None]),
             rng.randint(-9, 9) * 1.0, *rng.choices(["X", "Y", "Z", "W", "V", "U", None], k=6))
            for _ in range(400)]
    stats = {}
    for a, b, tone, *types in data:
        a, b = a or "UKNOWN", b or "UKNOWN"
        for t in filter(None, types):
            for key in ((a, b, t), (b, a, t)):
                stats.setdefault(key, []).append(tone)
    events = pair_events(spark, *data)
    got = relations.actor_type_top(events, types=TYPES, k=3, **PAIR_FEED).collect()
    expected = set()
    for pair in {key[:2] for key in stats}:
        of_pair = sorted((-len(v), key[2], sum(v)) for key, v in stats.items() if key[:2] == pair)
        expected |= {(*pair, t, -n, rank + 1) for rank, (n, t, _) in enumerate(of_pair[:3])}
    assert {(r.c1, r.c2, r.actor_type, r.n, r["rank"]) for r in got} == expected
    assert all(math.isclose(r.mean_tone, sum(stats[r.c1, r.c2, r.actor_type]) / r.n, abs_tol=1e-9)
               for r in got)


def test_top_k_and_list(spark, rows):
    df = spark.createDataFrame([("g", "b", 1), ("g", "a", 1), ("g", "c", 9), ("h", "z", 1)],
                               "grp string, item string, n int")
    top = top_k(df, ["grp"], "n", "item", k=2)
    assert rows(top, "grp", "item", "rank") == [("g", "a", 2), ("g", "c", 1), ("h", "z", 1)]
    lists = dict(ranking_list(top, ["grp"], ["item", "n"]).collect())
    assert [tuple(e) for e in lists["g"]] == [("c", 9), ("a", 1)]


def test_halving_example(spark, rows):
    day = D(2024, 1, 3)
    events = spark.createDataFrame(
        [("USA", day, 5.0, 0), ("USA", day, 3.0, 0), ("USA", day, 4.0, 1),
         ("FRA", day, 9.0, 2), ("USA", D(2024, 1, 10), 9.0, 2), ("USA", day, None, 2),
         ("USA", day, 2.0, 3)], "c string, d date, v double, batch int")
    got = weekly_halving_average(events, "batch", "USA", key="c", time="d", tone="v")
    assert rows(got, "week", "batch", "average") == sorted([
        (D(2024, 1, 1), 0, 4.0), (D(2024, 1, 1), 1, 4.0), (D(2024, 1, 1), 3, 3.0),
        (D(2024, 1, 8), 2, 4.5)], key=repr)
    sums = weekly_tone_sum(events, "USA", key="c", time="d", tone="v")
    assert rows(sums) == sorted([(D(2024, 1, 1), 14.0), (D(2024, 1, 8), 9.0)], key=repr)


def test_halving_against_plain_fold(spark):
    rng = random.Random(3)
    data = [("dense", b, rng.choice([0.0, rng.uniform(-1e3, 1e3)])) for b in range(4 * SEGMENT)]
    data += [("gaps", b, rng.uniform(-1, 1)) for b in rng.sample(range(60 * SEGMENT), 900)]
    data += [("faded", b, 1e300 if b < 300 else 0.0) for b in range(0, 12 * SEGMENT)]
    data += [("endless", b, math.inf if b == 5 else 1.0) for b in range(0, 12 * SEGMENT)]
    df = spark.createDataFrame(data, "k string, b long, v double").repartition(7)
    got = {(r.k, r.b): r.a for r in halving_average(df, "k", "b", "v", "a").collect()}
    assert len(got) == len(data)
    average = {}
    for k, b, v in sorted(data):
        average[k] = (v + average.get(k, 0.0)) / 2
        # Below the smallest normal double only the last bits can differ.
        assert math.isclose(got[k, b], average[k], rel_tol=1e-12, abs_tol=1e-321), (k, b)


def test_late_rows_of_one_row_batches(spark, rows):
    data = [(i, dt.datetime(2024, 1, d)) for i, d in enumerate([10, 5, 5, 5])]
    df = spark.createDataFrame(data, "batch long, ts timestamp_ntz")
    assert rows(mark_late(df, "ts", "batch"), "batch", "late") == [
        (0, False), (1, False), (2, True), (3, True)]
    assert rows(mark_late(df, "ts", "batch", delay="5 days"), "late") == [(False,)] * 4
    assert sorted(rows(mark_late(df, "ts", "batch", delay="4 days"), "batch", "late")) == [
        (0, False), (1, False), (2, True), (3, True)]


def test_late_rows_against_plain_loop(spark):
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    data = [(i, rng.randrange(3 * BLOCK), start + dt.timedelta(hours=rng.randrange(5000)))
            for i in range(3000)]
    df = spark.createDataFrame(data, "i int, batch long, ts timestamp_ntz")
    got = {r.i: r.late for r in mark_late(df, "ts", "batch", delay="100 days").collect()}
    latest = {}
    for _, batch, ts in data:
        latest[batch] = max(ts, latest.get(batch, ts))
    running, mark = None, {}
    for batch in range(3 * BLOCK + 2):
        mark[batch] = running if batch < 2 else max(filter(None, (running, latest.get(batch - 2))),
                                                    default=None)
        running = mark[batch]
    for i, batch, ts in data:
        end = ts.replace(hour=0) + dt.timedelta(days=1)
        late = mark[batch] is not None and end <= mark[batch] - dt.timedelta(days=100)
        assert got[i] == late
    assert 0 < sum(got.values()) < len(data)


def test_halving_keeps_tiny_and_huge_values(spark):
    values = [("tiny", b, 1e-250) for b in range(3)]
    values += [("huge", b, 1.7e308 if b == 0 else 0.0) for b in range(SEGMENT * 9)]
    values += [("sparse", b * SEGMENT, float(b)) for b in range(40)]
    df = spark.createDataFrame(values, "k string, b long, v double")
    got = {(r.k, r.b): r.a for r in halving_average(df, "k", "b", "v", "a").collect()}
    average = {}
    for k, b, v in values:
        average[k] = (v + average.get(k, 0.0)) / 2
        assert math.isclose(got[k, b], average[k], rel_tol=1e-9, abs_tol=5e-324), (k, b)
