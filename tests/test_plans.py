"""The physical plans that make the jobs scale."""

import pytest

import __spark_entry__ as entry
from verification import batch_queries, feeds

SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in batch_queries.QUERIES if n not in (
    "text_sink_roundtrip", "event_table_roundtrip", "parse_events_files")])
def test_batch_plans_stay_native(spark, name):
    text = plan(spark, name)
    for slow in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in text


def test_conditions_and_columns_reach_the_scan(spark):
    text = plan(spark, "daily_tone_sum")
    assert "EqualTo(event_type,click)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_pairs_are_aggregated_once_and_before_the_shuffle(spark):
    text = plan(spark, "bilateral_tone")
    tail = text[:text.index("Exchange hashpartitioning(week")]
    assert "Generate inline" in tail       # the second direction comes after the shuffle
    assert "partial_count" in text and text.count("Exchange hashpartitioning") == 1


def test_ranking_is_cut_before_the_shuffle(spark):
    for name in ("actor_type_top5", "actor_type_top5_list"):
        text = plan(spark, name)
        assert text.count("WindowGroupLimit") == 2 and "Partial" in text
        assert text.count("Exchange hashpartitioning") == 2


def test_halving_reads_the_feed_once_and_windows_are_slim(spark):
    averages = entry.queries()["weekly_halving_avg"](spark, SMALL)
    averages.collect()
    text = averages._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("FileScan") == 1 and "Reused" in text
    for line in text.splitlines():
        if " Window [" in line:  # maps of stretches, no rows of a segment
            assert "_rows" not in line and "_local" not in line and "value" not in line


def test_lines_are_split_once(spark):
    from tonescope.sources import lines
    events = lines.events(lines.parse_lines(feeds.event_lines(spark, SMALL)))
    text = (events.where("actor1Code_countryCode = 'click'").select("avgTone")
            ._jdf.queryExecution().executedPlan().toString())
    assert text.count("split(") == 1


def test_partial_sums_of_batches_are_those_of_gathered_pairs(spark):
    text = plan(spark, "actor_type_top5_touched")
    assert "REBALANCE_PARTITIONS_BY_COL" in text.split("partial_sum")[1]
