"""Text cell -> typed value. An empty or unreadable cell is null; it never fails the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_cell(token: Column) -> Column:
    return F.nullif(token, F.lit(""))


def int_cell(token: Column) -> Column:
    """Decimal digits with an optional sign; surrounding blanks make it unreadable."""
    return F.when(token.rlike(r"^[+-]?[0-9]+\z"), token.try_cast("int"))


def double_cell(token: Column) -> Column:
    """A cast, except that NaN and Infinity are read in exactly this spelling only."""
    misspelt = token.rlike(r"^\s*[+-]?(?!(NaN|Infinity)\s*\z)(?i:nan|inf|infinity)\s*\z")
    return F.when(~misspelt, token.try_cast("double"))


def date_cell(token: Column) -> Column:
    """``yyyyMMdd``, eight digits naming a day that exists."""
    iso = F.concat_ws("-", F.substring(token, 1, 4), F.substring(token, 5, 2),
                      F.substring(token, 7, 2))
    return F.when(token.rlike(r"^[0-9]{8}\z"), iso.try_cast("date"))


def bool_cell(token: Column) -> Column:
    """``1`` is true and every other non-empty cell is false."""
    return text_cell(token) == "1"


READERS = {
    "string": text_cell,
    "int": int_cell,
    "double": double_cell,
    "date": date_cell,
    "boolean": bool_cell,
}
