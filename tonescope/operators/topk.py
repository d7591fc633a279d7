"""The k most frequent items of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(rows: DataFrame, group: Sequence[str], count: str, item: str, k: int = 5,
          alias: str = "rank") -> DataFrame:
    """The ``k`` rows of each group with the highest count; ties go to the first item by name.

    Spark keeps at most k rows per group and task before the shuffle, so that no task ever holds
    a large group.
    """
    by_count = Window.partitionBy(*group).orderBy(F.col(count).desc(), F.col(item))
    return rows.withColumn(alias, F.row_number().over(by_count)).where(F.col(alias) <= k)


def ranking_list(ranked: DataFrame, group: Sequence[str], fields: Sequence[str],
                 rank: str = "rank", alias: str = "ranking") -> DataFrame:
    """The ranked rows of each group as one array of structs, best first: at most k of them."""
    entries = F.array_sort(F.collect_list(F.struct(rank, *fields)))
    plain = F.transform(entries, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return ranked.groupBy(*group).agg(plain.alias(alias))
