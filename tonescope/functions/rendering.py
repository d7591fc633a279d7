"""Result rows as lines of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed values in this module: signs and words of the lines, as consumers of the results expect them.
def number_text(value: Column, digits: int | None = None) -> Column:
    """The shortest text that reads back as the same double, or a fixed number of decimals."""
    if digits is None:
        return value.cast("string")
    return F.format_string(f"%.{digits}f", F.round(value, digits))


def pair_line(week: Column, first: Column, second: Column, text: Column) -> Column:
    return F.concat_ws(";", first, second, F.date_format(week, "yyyy-MM-dd"), text)


def ranking_text(ranking: Column, digits: int | None = None) -> Column:
    """``[(type,count,mean), ...]`` of an array of structs with these three fields."""
    entries = F.transform(ranking, lambda entry: F.concat(
        F.lit("("), F.concat_ws(",", entry["actor_type"], entry["n"].cast("string"),
                                number_text(entry["mean_tone"], digits)), F.lit(")")))
    return F.concat(F.lit("["), F.array_join(entries, ", "), F.lit("]"))


def weekly_line(country: Column, week: Column, average: Column,
                digits: int | None = None) -> Column:
    return F.concat(F.lit("Country("), country, F.lit("), Week("),
                    F.date_format(week, "yyyy-MM-dd"), F.lit("), AvgTone("),
                    number_text(average, digits), F.lit(")"))
