"""One row to several: both directions of a country pair, one row per actor type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def both_directions(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Every row as (first, second) and as (second, first); a self-pair comes twice."""
    return _with_directions(rows, first, second, F.array(*_directions(first, second)))


def directed(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Results per unordered pair as results per ordered pair; a self-pair comes once."""
    there, back = _directions(first, second)
    same = F.col(first) == F.col(second)
    return _with_directions(rows, first, second,
                            F.when(same, F.array(there)).otherwise(F.array(there, back)))


def unordered(rows: DataFrame, first: str, second: str) -> DataFrame:
    """The two countries in alphabetical order: one key for both directions."""
    return rows.withColumns({first: F.least(first, second), second: F.greatest(first, second)})


def each_type(rows: DataFrame, types: Sequence[str], alias: str = "actor_type") -> DataFrame:
    """One row per non-null type column, repeated types included; the columns are dropped."""
    others = [c for c in rows.columns if c not in types]
    exploded = rows.select(*others, F.explode(F.array(*types)).alias(alias))
    return exploded.where(F.col(alias).isNotNull())


def _directions(first: str, second: str):
    return (F.struct(F.col(first).alias(first), F.col(second).alias(second)),
            F.struct(F.col(second).alias(first), F.col(first).alias(second)))


def _with_directions(rows: DataFrame, first: str, second: str, directions) -> DataFrame:
    others = [c for c in rows.columns if c not in (first, second)]
    return rows.select(*others, F.inline(directions))
