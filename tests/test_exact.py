"""Sums that do not depend on the order of the rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tonescope.functions.exact import exact_sum
from tonescope.plans.daily_tone import daily_tone_sum


def totals(spark, values, partitions):
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    return frame.agg(exact_sum(F.col("v")).alias("s"), F.sum("v").alias("plain")).first()


@pytest.mark.parametrize("scale", [1e-12, 1.0, 1e6, 1e11])
def test_any_order_gives_the_same_bits(spark, scale):
    draw = random.Random(7)
    values = [draw.uniform(-1, 1) * scale for _ in range(3000)] + [0.1, -0.3, 0.0, -0.0, 1e9, None]
    found = set()
    for partitions in (1, 3, 7):
        draw.shuffle(values)
        found.add(totals(spark, values, partitions).s)
    got, = found
    whole = sum(Fraction(v) for v in values if v is not None)
    # Cut bits and one rounding.
    assert abs(Fraction(got) - whole) <= Fraction(len(values), 2**60) + Fraction(2) ** -52 * max(1, abs(whole))


def test_special_values(spark):
    inf, nan = math.inf, math.nan
    for values, want in (([], None), ([None], None), ([1.5, inf], inf), ([inf, -inf], nan), ([nan, 1.0], nan),
                         ([2.0**50, 1.0], 2.0**50 + 1), ([-2.5], -2.5), ([0.1], 0.1), ([0.1, 0.2], 0.1 + 0.2)):
        got = totals(spark, values, 2).s
        assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


def test_a_plan_over_any_partitioning(spark, rows):
    draw = random.Random(3)
    ddl = "c string, t timestamp_ntz, v double"
    import datetime as dt
    data = [("USA", dt.datetime(2024, 1, 1 + draw.randrange(3)), draw.uniform(-9, 9)) for _ in range(2000)]
    found = set()
    for n in (1, 4, 9):
        draw.shuffle(data)
        frame = spark.createDataFrame(data, ddl).repartition(n)
        found.add(tuple(rows(daily_tone_sum(frame, key="c", time="t", tone="v", exact=True))))
    assert len(found) == 1
