"""Operator 6, mixing sources to target weights by balanced sampling with the cube method.

A source that has to give t of its s words takes floor(t / s) copies of every document, and one more
of some. Each document enters with inclusion probability t / s - floor(t / s). The flight phase of
the cube method moves the probabilities along vectors that change neither the expected words nor the
expected number of documents, until all but two per block are 0 or 1. What is left of the blocks is
gathered and moved again, until one block per source remains; its last two documents land.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonescope.session import work_folder

#: Documents of one flight. Balance holds in every block, so it does not depend on this.
BLOCK_DOCS = 4096


def word_count(text: Column) -> Column:
    """Longest runs of characters other than ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0,
            weights: tuple[float, ...] = (3.0, 1.0, 2.0)) -> DataFrame:
    """Adds ``target`` to ``source, source_size``, a row per source.

    Weights repeat along the sources by code point, null last. The targets are ``share`` of all
    words by weight; none exceeds ``most`` times its source's words, and what exceeds goes to the
    others by weight until none is above. That is one level L with target = min(cap, L * weight):
    sources are full in the order of cap / weight, and L follows from the sums of the full ones.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy(F.lit(0))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("total", F.sum("source_size").over(everything) * share)
            .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(everything)
                        - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # With the sources before it full, a source is not full if this level keeps it below its cap.
    # The first such source has the greatest level of them.
    level = (F.col("total") - F.col("full")) / F.col("open")
    fits = F.col("cap") / F.col("weight") >= level
    rows = rows.withColumn("level", F.max(F.when(fits, level)).over(everything))
    bounded = F.least(F.col("cap"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return rows.select("source", "source_size", bounded.cast("double").alias("target"))


def flight(chance: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Moves inclusion probabilities until at most two are neither 0 nor 1.

    Three open units at a time: a vector u with sum(u) = 0 and sum(u * size) = 0 always exists. Which
    way to go along it is drawn, so that every probability keeps its expectation.
    """
    chance, random = chance.copy(), np.random.default_rng(7)
    draws = random.random(len(chance) + 1)
    held: list[int] = []
    for at in range(len(chance)):
        if not 0.0 < chance[at] < 1.0:
            continue
        held.append(at)
        if len(held) < 3:
            continue
        i, j, k = held
        a, b, c = float(sizes[i]), float(sizes[j]), float(sizes[k])
        u = (1.0, -1.0, 0.0) if a == b else (c - b, a - c, b - a)
        p = [float(chance[x]) for x in held]
        up = min([(1 - q if v > 0 else q) / abs(v) for q, v in zip(p, u, strict=True) if v])
        down = min([(q if v > 0 else 1 - q) / abs(v) for q, v in zip(p, u, strict=True) if v])
        step = up if draws[at] < down / (up + down) else -down
        for x, q, v in zip(held, p, u, strict=True):
            moved = q + step * v
            chance[x] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved
        held = [x for x in held if 0.0 < chance[x] < 1.0]
    return chance


def land(chance: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The landing: of the few ways to decide the open units, the one nearest the expected words."""
    left = np.flatnonzero((chance > 0) & (chance < 1))
    chance = chance.copy()
    if len(left):
        ways = [[(way >> b) & 1 for b in range(len(left))] for way in range(1 << len(left))]
        wanted = float(sizes[left] @ chance[left])
        docs = float(chance[left].sum())
        chance[left] = min(ways, key=lambda w: (abs(float(sizes[left] @ np.array(w)) - wanted),
                                                abs(sum(w) - docs), w))
    return chance


#: Rows equal in these are interchangeable.
_EQUAL = ("doc_id", "size", "hash")


def _dealt(blocks: Column, *by: str) -> Column:
    """A block of the source's, by a hash."""
    return F.pmod(F.pmod(F.xxhash64(*by), F.lit(1 << 40)), blocks).cast("long")


def _spread(rows: DataFrame, blocks: Column, most: int, folder: str) -> DataFrame:
    """``rows`` with those of blocks above ``most`` rows, where many equal rows meet, dealt once more: by
    their number among their equals too. Any numbering gives the same blocks but for equal rows.

    Equal rows are numbered within each task's part, and the parts by sums over their counts, so that no
    task holds all of them.
    """
    spark = rows.sparkSession
    (rows.groupBy("source", "block").agg(F.count("*").alias("n")).where(F.col("n") > most)
     .select(F.col("source").alias("of"), F.col("block").alias("full")).write.parquet(f"{folder}/blocks"))
    large = spark.read.parquet(f"{folder}/blocks")
    if large.isEmpty():
        return rows
    here = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("full"))
    few = rows.join(large, here, "left_anti")
    rows.join(large, here, "left_semi").write.parquet(f"{folder}/rows")
    many = spark.read.parquet(f"{folder}/rows")
    equal = ["source", *_EQUAL]
    parts = many.groupBy(*equal, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*equal).orderBy("part")) - F.col("n")
    parts.withColumn("before", before).drop("n").write.parquet(f"{folder}/parts")
    offsets = spark.read.parquet(f"{folder}/parts").alias("o")
    within = F.row_number().over(Window.partitionBy(*equal, "part").orderBy("row")) - 1
    numbered = many.withColumn("within", within).alias("m").join(offsets, F.expr(" AND ".join(
        f"m.{c} <=> o.{c}" for c in [*equal, "part"]))).select("m.*", "o.before")
    numbered = numbered.withColumn("number", F.col("before") + F.col("within"))
    spread = numbered.withColumn("block", _dealt(blocks, *_EQUAL, "number"))
    return few.unionByName(spread.drop("before", "within", "number"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0,
        weights: tuple[float, ...] = (3.0, 1.0, 2.0), doc_id: str = "doc_id", text: str = "text",
        source: str = "source", block_docs: int = BLOCK_DOCS, row: str | None = None) -> DataFrame:
    """``doc_id, row, size, source, source_size, target, taken, copies`` of every row.

    ``size`` is the number of words, ``taken`` the words that the mix takes: ``copies`` times size.
    No document has more than ``most`` (rounded up) copies. Reruns agree: rows are ordered by id, size and
    a hash of the text; rows equal in all of these are interchangeable. A null text has no words and
    a source without words a target of 0. A null source is one source, the last. A very long text is
    taken or left whole. An empty table
    gives no rows. ``row`` names a column of numbers of the caller's that tell all rows apart, which
    come back under that name; without it rows get numbers here. Other columns are not read.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "mix")
    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[source].alias("source"),
                       word_count(docs[text]).alias("size"),
                       F.xxhash64(docs[text]).alias("hash"),
                       (docs[row] if row else F.monotonically_increasing_id()).alias("row"))
    slim.withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/rows")
    slim = spark.read.parquet(f"{folder}/rows")

    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.count("*").alias("docs"))
    counted = targets(sources, share, most, weights).withColumnRenamed("source", "of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Whole numbers of copies up to rounding have no fraction left.
    whole = F.floor(ratio + 1e-12).cast("long")
    plan = counted.select("of", "source_size", "target", whole.alias("whole"),
                          F.greatest(ratio - whole, F.lit(0.0)).alias("chance"))
    sizes = sources.select(F.col("source").alias("of_"), "docs")
    plan = plan.join(sizes, F.col("of").eqNullSafe(F.col("of_"))).drop("of_")
    plan.write.parquet(f"{folder}/sources")
    plan = spark.read.parquet(f"{folder}/sources")

    joined = slim.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    joined.write.parquet(f"{folder}/joined")
    joined = spark.read.parquet(f"{folder}/joined")
    largest = plan.agg(F.max("docs")).first()[0] or 0

    schema = "source string, block long, doc_id long, hash long, row long, size long, chance double"
    names = [part.split()[0] for part in schema.split(", ")]

    def flown(last: bool):
        def run(table):
            import pyarrow as pa
            order = table.sort_by([("doc_id", "ascending"), ("size", "ascending"),
                                   ("hash", "ascending"), ("row", "ascending")])
            size = order["size"].to_numpy().astype(float)
            chance = flight(order["chance"].to_numpy(), size)
            if last:
                chance = land(chance, size)
            at = order.schema.get_field_index("chance")
            return order.set_column(at, "chance", pa.array(chance))
        return run

    blocks = F.ceil(F.col("docs") / block_docs)
    open_rows = joined.where((F.col("chance") > 0) & (F.col("size") > 0)).withColumn(
        "block", _dealt(blocks, *_EQUAL))
    open_rows = _spread(open_rows, blocks, 2 * block_docs, f"{folder}/large").select(*names)
    decided, level, most_blocks = [], 0, -(-largest // block_docs)
    while True:
        last = most_blocks <= 1
        out = open_rows.groupBy("source", "block").applyInArrow(flown(last), schema)
        out.write.parquet(f"{folder}/flight{level}")
        stored = spark.read.parquet(f"{folder}/flight{level}")
        whole_now = (F.col("chance") == 0) | (F.col("chance") == 1)
        decided.append(stored.where(whole_now).select("row", F.col("chance").cast("long")
                                                      .alias("extra")))
        if last:
            break
        # At most two documents of each block are left: so many blocks meet in one.
        wide = max(block_docs // 2, 2)
        open_rows = stored.where(~whole_now).withColumn(
            "block", F.floor(F.col("block") / wide).cast("long"))
        level, most_blocks = level + 1, -(-most_blocks // wide)
    extra = decided[0]
    for more in decided[1:]:
        extra = extra.unionByName(more)
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return (joined.join(extra, "row", "left")
            .select("doc_id", F.col("row").alias(row or "row"), "size", "source", "source_size", "target",
                    (F.col("size") * copies).alias("taken"), copies.alias("copies")))
