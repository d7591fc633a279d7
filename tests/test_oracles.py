"""Every registered query equals its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from verification.batch_queries import QUERIES as BATCH
from verification.compare import mismatch, oracle_frame
from verification.stream_queries import QUERIES as STREAMS

SMALL = "/root/testdata/sf0.001"


EVENTS = BATCH | STREAMS


def test_every_event_query_has_sql():
    assert set(EVENTS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", EVENTS)
def test_query_equals_sql(spark, name):
    result = entry.queries()[name](spark, SMALL).toPandas()
    assert len(result) > 0
    assert mismatch(result, oracle_frame(SMALL, entry.oracle_sql()[name])) is None


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns == ["week", "c1", "c2", "actor_type", "n", "mean_tone", "rank"]
    assert flagship.count() > 0
