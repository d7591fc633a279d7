"""Event lines -> typed events, quarantined lines and unreadable-cell counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import READERS
from .layout import ADDED, FIELDS, NAMES

LINE = "line"
STATUS = "status"
OK = "ok"
BLANK, TOO_MANY_FIELDS, NO_DATE = "blank", "too_many_fields", "no_date"


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Type every line of ``lines`` (batch or streaming): 58 event columns, ``line``, ``status``.

    Cells are split at tabs without quoting. Missing trailing cells are null. ``status`` is ``ok``
    or the reason the line is not an event; ``line`` holds the raw text of those lines only.
    """
    # explode of a one-element array: a filter cannot move below it, so the line is split once
    # and not again for every condition on an event column.
    tokens = lines.select(
        F.col(line).alias(LINE),
        F.explode(F.array(F.split(F.col(line), "\t", -1))).alias("tokens"))
    typed = tokens.select(
        *[READERS[kind](F.get("tokens", F.lit(i))).alias(name)
          for i, (name, kind) in enumerate(FIELDS)],
        LINE, "tokens")
    status = (
        F.when(F.trim(LINE) == "", BLANK)
        .when(_has_surplus(F.col("tokens")), TOO_MANY_FIELDS)
        .when(F.col(ADDED).isNull(), NO_DATE)
        .otherwise(OK))
    return typed.select(*NAMES, status.alias(STATUS),
                        F.when(status != OK, F.col(LINE)).alias(LINE))


def events(parsed: DataFrame) -> DataFrame:
    """The readable events of ``parse_lines``."""
    return parsed.where(F.col(STATUS) == OK).select(*NAMES)


def quarantine(parsed: DataFrame) -> DataFrame:
    """The lines of ``parse_lines`` that are no events, with the reason."""
    return parsed.where(F.col(STATUS) != OK).select(LINE, F.col(STATUS).alias("reason"))


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    return quarantine(parsed).groupBy("reason").agg(F.count("*").alias("n"))


def cell_errors(lines: DataFrame, line: str = "value") -> DataFrame:
    """Per typed column, how many non-empty cells of ``lines`` could not be read."""
    tokens = lines.select(F.split(F.col(line), "\t", -1).alias("tokens"))
    typed = [(i, name, kind) for i, (name, kind) in enumerate(FIELDS)
             if kind not in ("string", "boolean")]
    counts = tokens.agg(*[
        F.count_if((F.get("tokens", F.lit(i)) != "")
                   & READERS[kind](F.get("tokens", F.lit(i))).isNull()).alias(name)
        for i, name, kind in typed])
    return counts.unpivot([], [name for _, name, _ in typed], "column_name", "n_errors")


def _has_surplus(tokens: Column) -> Column:
    """Any text after the last field; empty cells there are no harm."""
    surplus = F.slice(tokens, len(FIELDS) + 1, F.greatest(F.size(tokens), F.lit(1)))
    return (F.size(tokens) > len(FIELDS)) & (F.array_join(surplus, "") != "")
