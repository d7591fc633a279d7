"""Sums of doubles that come out the same in whatever order, tasks and batches the rows are added.

A double is split into whole numbers: its floor and two steps of 30 bits below the point. Whole numbers
add up exactly; the sum is put together, and rounded, once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 1 << 30
#: Values from here on, and infinities and NaN, are added as they are.
LARGE = float(1 << 40)


def exact_sum(value: Column) -> Column:
    """An aggregate: the sum of a double column, null where it has no values.

    Bits below 2^-60 of a value are cut off, whatever its neighbours; the result is within 2^-53 of the sum
    of what is left, or one rounding. Values of 2^40 and more are outside: they are added as doubles,
    in the order of the rows. A sum beyond 2^63 is an error.
    """
    small = F.when(F.abs(value) < LARGE, value)
    whole, first, second = split(small)
    other = F.sum(F.when(~(F.abs(value) < LARGE), value))
    total = joined(F.sum(whole), F.sum(first), F.sum(second))
    return F.when(other.isNull(), total).otherwise(other + F.coalesce(total, F.lit(0.0)))


def split(value: Column) -> tuple[Column, Column, Column]:
    """The floor, and two whole numbers below STEP, of a double."""
    whole = F.floor(value)
    rest = (value - whole) * float(STEP)
    first = F.floor(rest)
    return whole, first, F.floor((rest - first) * float(STEP))


def joined(whole: Column, first: Column, second: Column) -> Column:
    """The double nearest to sums of split values."""
    first = first + _above(second)
    whole = whole + _above(first)
    below = F.pmod(first, F.lit(STEP)) * STEP + F.pmod(second, F.lit(STEP))
    return whole.cast("double") + below.cast("double") / float(STEP * STEP)


def _above(steps: Column) -> Column:
    return F.shiftright(steps, 30)
