"""The halving average: after every batch, half of (batch sum + previous average)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Batches per segment, and segments per stretch.
SEGMENT = 256
# A share halved this often is below the smallest double, whatever it was.
VANISHED = 2200


def halving_average(sums: DataFrame, key: str, batch: str, value: str,
                    alias: str = "average") -> DataFrame:
    """Fold ``avg = (value + avg) / 2`` from 0 over the rows of each key in batch order.

    ``sums`` has one row per key and batch (an integer); batches without the key leave its average
    alone. A run of n batches maps a previous average x to x / 2^n + b, and two such maps compose
    to one again. So this is a parallel scan in two levels: the rows of each segment of batches are
    folded to a map of their own, the maps of each stretch of segments to one, and only the maps of
    stretches, a row for SEGMENT * SEGMENT batches of a key, meet in key order. What comes before a
    segment then goes back to its rows by a join of the maps, not of the rows of a key.
    """
    # At most SEGMENT rows of a segment, in order, folded as they stand.
    rows = sums.withColumn("_segment", F.floor(F.col(batch) / SEGMENT))
    rows = rows.groupBy(key, "_segment").agg(F.sort_array(F.collect_list(
        F.struct(F.col(batch).alias("batch"), F.col(value).alias("value")))).alias("_rows"))
    halve = lambda averages, row: F.concat(averages, F.array(
        (row["value"] + F.coalesce(F.try_element_at(averages, F.lit(-1)), F.lit(0.0))) / 2))
    rows = rows.withColumn("_local", F.aggregate("_rows", _no_doubles(), halve))

    carries = _carries(rows.select(
        F.col(key).alias("_key"), F.col("_segment").alias("_at"), F.size("_rows").alias("_size"),
        F.element_at("_local", -1).alias("_end")))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_segment").eqNullSafe(F.col("_at"))
    folded = rows.join(carries, same).select(
        key, "_carry", F.posexplode(F.arrays_zip("_rows", "_local")).alias("_n", "_row"))
    average = F.col("_row._local") + F.col("_carry") * F.pow(F.lit(0.5), F.col("_n") + 1)
    return folded.select(key, F.col("_row._rows.batch").alias(batch),
                         F.col("_row._rows.value").alias(value), average.alias(alias))


def _carries(maps: DataFrame) -> DataFrame:
    """``_key, _at, _carry``: the average before each segment, from ``_key, _at, _size, _end``."""
    stretches = maps.groupBy("_key", F.floor(F.col("_at") / SEGMENT).alias("_stretch")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_size", "_end"))).alias("_maps"))
    stretches = stretches.withColumns({
        "_sizes": F.aggregate("_maps", F.lit(0).cast("long"), lambda n, m: n + m["_size"]),
        "_ends": F.aggregate("_maps", F.lit(0.0), lambda average, m: _through(average, m))})

    in_order = Window.partitionBy("_key").orderBy("_stretch")
    stretches = stretches.withColumn("_start", F.sum("_sizes").over(in_order) - F.col("_sizes"))
    # Stretches near enough for a share of their last average to matter: those that start within
    # VANISHED batches before this one, and the one before them, which ends there.
    summary = F.struct((F.col("_start") + F.col("_sizes")).alias("total"), F.col("_ends").alias("end"))
    near = Window.partitionBy("_key").orderBy("_start").rangeBetween(-VANISHED, -1)
    far = F.lag(F.struct("_start", summary.alias("summary"))).over(in_order)
    stretches = stretches.withColumns({
        "_near": F.collect_list(summary).over(near), "_far": far})
    distance = lambda s: F.col("_start") - s["total"]
    share = lambda s: F.when(
        distance(s) <= VANISHED, s["end"] * F.pow(F.lit(0.5), distance(s).cast("double"))).otherwise(0.0)
    carry = F.aggregate("_near", F.lit(0.0), lambda total, s: total + share(s)) + F.when(
        F.col("_far._start") < F.col("_start") - VANISHED, share(F.col("_far.summary"))).otherwise(0.0)
    # Infinity and NaN never fade: carry them from any distance.
    endless = F.when(F.isnan("_ends") | (F.abs("_ends") == float("inf")), F.col("_ends"))
    ever = F.coalesce(F.sum(endless).over(in_order.rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0.0))
    stretches = stretches.withColumn("_ever", ever).select(
        "_key", "_maps", (carry + F.col("_ever")).alias("_before"))
    # The average before each segment of a stretch, and after the last.
    walk = F.aggregate("_maps", F.array("_before"), lambda averages, m: F.concat(
        averages, F.array(_through(F.element_at(averages, -1), m))))
    walked = stretches.select("_key", F.inline(F.arrays_zip("_maps", F.slice(
        walk, 1, F.size("_maps")).alias("_carry"))))
    return walked.select("_key", F.col("_maps._at").alias("_at"), "_carry")


def _through(average: Column, segment: Column) -> Column:
    """A segment's map. It has at most SEGMENT rows, so the power does not vanish."""
    return average * F.pow(F.lit(0.5), segment["_size"].cast("double")) + segment["_end"]


def _no_doubles() -> Column:
    return F.array().cast("array<double>")
