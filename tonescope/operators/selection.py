"""Row filters and defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the label of a missing country, spelled as consumers of the results expect it.
UNKNOWN = "UKNOWN"


def of_country(events: DataFrame, country: str, column: str) -> DataFrame:
    """Rows whose country is ``country``; a missing one never matches."""
    return events.where(F.col(column) == F.lit(country))


def with_both(events: DataFrame, first: str, second: str) -> DataFrame:
    """Rows that name both countries."""
    return events.where(F.col(first).isNotNull() & F.col(second).isNotNull())


def or_unknown(events: DataFrame, *columns: str, label: str = UNKNOWN) -> DataFrame:
    """A missing country becomes ``label``."""
    return events.withColumns({c: F.coalesce(F.col(c), F.lit(label)) for c in columns})


def with_tone(events: DataFrame, tone: str) -> DataFrame:
    """Rows with a tone, so that counts and means rest on the same rows."""
    return events.where(F.col(tone).isNotNull())
