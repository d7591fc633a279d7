"""Operator 5, exact deduplication by Grace hashing.

1. Every task reads its rows through a bounded table and writes records: each text of a stretch of
   rows once, and for every row the number of its text. So a text that a third of all rows share
   leaves a task as one record per stretch.
2. Records are dealt into buckets by bits of a hash. Buckets that would not fit a task's table are
   dealt again by further bits, until all fit or hold one hash only.
3. Each bucket is read once into an open-addressing table that compares whole contents.
4. Rows learn the class of their record; only numbers are shuffled for that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescope.session import work_folder

#: Bytes of different texts that a task's table holds at once.
TABLE_BYTES = 32 << 20
#: Buckets that a level deals an oversized bucket into, as bits of the hash.
BITS = 4


class ContentTable:
    """Open addressing with linear probing; equal hashes are told apart by their whole contents."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[str] = []
        self.bytes = 0

    def add(self, hashed: int, content: str) -> tuple[int, bool]:
        """The number of the content, and whether it is new."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == hashed and self.contents[found] == content:
                return int(found), False
            at = (at + 1) & mask
        number = len(self.contents)
        self.slots[at] = number
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + 100
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return number, True

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for number, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def records(rows: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``doc_id, hash, record, content``: the content stands in the first row of its record only.

    ``rows`` has ``doc_id, hash, content``.
    """
    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        base, table = TaskContext.get().partitionId() << 36, ContentTable()
        for batch in batches:
            numbers, contents = [], []
            for hashed, content in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                       strict=True):
                if table.bytes > table_bytes:
                    base, table = base + len(table.contents), ContentTable()
                number, fresh = table.add(hashed, content)
                numbers.append(base + number)
                contents.append(content if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64()),
                 pa.array(contents, pa.string())], names=["doc_id", "hash", "record", "content"])

    return rows.mapInArrow(run, "doc_id long, hash long, record long, content string")


def bucket_of(sizes: DataFrame, table_bytes: int = TABLE_BYTES, bits: int = BITS,
              levels: int = 12) -> tuple[int, list[set[int]]]:
    """The depth of dealing: bits of the first level, and per level the buckets dealt again.

    ``sizes`` has ``hash, bytes``, a row per record. Only buckets that are too large come to the
    driver. There are few: the first level has as many buckets as tables would hold everything, so
    a bucket is too large only where records of few hashes gather.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    first = max(0, int(4 * total // table_bytes)).bit_length()
    again: list[set[int]] = []
    for level in range(levels):
        used = first + level * bits
        if used + bits > 62:
            break
        bucket = F.shiftrightunsigned("hash", 64 - used) if used else F.lit(0).cast("long")
        heavy = sizes.withColumn("bucket", bucket)
        if again:
            parents = sorted(again[-1])
            heavy = heavy.where(F.shiftrightunsigned("hash", 64 - used + bits).isin(parents)
                                if used > bits else F.lit(True))
        heavy = (heavy.groupBy("bucket")
                 .agg(F.sum("bytes").alias("bytes"), F.min("hash").alias("low"),
                      F.max("hash").alias("high"))
                 .where((F.col("bytes") > table_bytes) & (F.col("low") != F.col("high"))))
        found = {r[0] for r in heavy.select("bucket").collect()}
        if not found:
            break
        again.append(found)
    return first, again


def bucket_column(first: int, again: list[set[int]], bits: int = BITS) -> Column:
    """The bucket of a hash after all levels, as text."""
    def at(level: int) -> Column:
        used = first + level * bits
        bucket = F.shiftrightunsigned("hash", 64 - used) if used else F.lit(0).cast("long")
        own = F.concat(F.lit(f"{level}:"), bucket.cast("string"))
        if level == len(again):
            return own
        return F.when(bucket.isin(sorted(again[level])), at(level + 1)).otherwise(own)
    return at(0)


def same_contents(texts: DataFrame, tables: int) -> DataFrame:
    """``record, class``: equal contents get one class number. ``texts`` has ``bucket`` besides."""
    def run(batches) -> Iterator:
        import pyarrow as pa
        current, table, classes = None, ContentTable(), []
        for batch in batches:
            out = []
            for bucket, hashed, record, content in zip(
                    *(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if bucket != current:
                    current, table, classes = bucket, ContentTable(), []
                number, fresh = table.add(hashed, content)
                if fresh:
                    classes.append(record)
                out.append(classes[number])
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, pa.int64())],
                                             names=["record", "class"])

    dealt = (texts.select("bucket", "hash", "record", "content")
             .repartition(tables, "bucket").sortWithinPartitions("bucket"))
    return dealt.mapInArrow(run, "record long, class long")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal when they are identical after each run of ASCII white space became one space; a
    null text is empty. The row with the smallest ``doc_id`` stays (a null id counts as largest); of
    rows that repeat this id, one stays. ``text_sha256`` is of the normalised text. A very long text is
    compared whole; a table holds it even where it alone is above ``table_bytes``. An empty table
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       normalised(docs[text]).alias("content"))
    rows = rows.select("doc_id", F.xxhash64("content").alias("hash"), "content")
    folder = work_folder(spark, "grace")
    records(rows, table_bytes).write.option("compression", "zstd").parquet(f"{folder}/records")
    stored = spark.read.parquet(f"{folder}/records")

    texts = stored.where(F.col("content").isNotNull())
    (texts.select("hash", (F.octet_length("content") + 100).alias("bytes"))
     .write.parquet(f"{folder}/sizes"))
    first, again = bucket_of(spark.read.parquet(f"{folder}/sizes"), table_bytes)
    tables = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    classes = same_contents(texts.withColumn("bucket", bucket_column(first, again)), tables)
    classes.write.parquet(f"{folder}/classes")

    members = stored.select("doc_id", "record").join(
        spark.read.parquet(f"{folder}/classes"), "record")
    digests = texts.select(F.col("record").alias("class"), F.sha2("content", 256)
                           .alias("text_sha256"))
    groups = members.groupBy("class").agg(F.min("doc_id").alias("keep_id"),
                                          F.count("*").alias("group_size"))
    groups = groups.join(digests, "class")
    joined = members.join(groups, "class")
    # Of rows that repeat the smallest id, a number decides.
    place = F.monotonically_increasing_id()
    joined = joined.withColumn("place", place)
    joined.write.parquet(f"{folder}/joined")
    joined = spark.read.parquet(f"{folder}/joined")
    chosen = (joined.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("class")
              .agg(F.min("place").alias("place")))
    chosen = chosen.select("place", F.lit(True).alias("chosen"))
    return (joined.join(chosen, "place", "left")
            .select("doc_id", "keep_id", "group_size",
                    F.coalesce("chosen", F.lit(False)).alias("kept"), "text_sha256"))
