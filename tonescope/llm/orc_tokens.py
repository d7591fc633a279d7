"""Operator 2, token ids as ORC: run-length encoded integers, row indexes, Bloom filters on ids.

One row per document, ascending by id over the files. Spark's ORC reader takes stripes as splits, so
a large file is read by many tasks, and skips stripes and row groups whose minimum, maximum or Bloom
filter rule out the documents asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import default_tokenizer, kept_encoder, slices

STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1000
#: Bytes of text encoded at a time. A task holds some thirty times as much for their ids.
SLICE_BYTES = 2_000_000


def encode(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, tokens`` (array<int>) and ``before``, the ids that a task has written before
    it, of every row; a null text is empty. Very long texts are encoded whole, in one row each."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches) -> Iterator:
        import pyarrow as pa
        encoder, before = kept_encoder(tokenizer), 0
        for batch in batches:
            texts = batch.column(1)
            for a, b in slices(texts, SLICE_BYTES):
                ids, bounds = encoder.encode(texts.slice(a, b - a), end_id)
                tokens = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                                  pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)), tokens,
                     pa.array(before + bounds[:-1])],
                    names=["doc_id", "n_tokens", "tokens", "before"])
                before += int(bounds[-1])

    chosen = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_tokens long, tokens array<int>, before long")


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0,
                 doc_id: str = "doc_id", text: str = "text", stripe_bytes: int = STRIPE_BYTES,
                 index_rows: int = INDEX_ROWS, files: int | None = None) -> None:
    """Encode whole texts and write them as ORC in ascending ``doc_id`` order.

    The texts are dealt by range before they are encoded, as they are smaller than ids. A null text
    is its end id alone; a very long one is a row like any other. Null ids come first; rows with one id stand side by side, ordered by text.
    An empty table gives files without rows. Other columns are not read. Each row keeps how many ids its
    file has before it. ``files`` defaults to
    the session's number of shuffle partitions.
    """
    chosen = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By id alone: the bounds of the ranges are sampled, and texts would all go to the driver.
    dealt = chosen.repartitionByRange(files, order[0]).sortWithinPartitions(*order)
    (encode(dealt, tokenizer, end_id).withColumn("part", F.spark_partition_id())
     .write.mode("overwrite").option("compression", "zstd")
     .option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
     .orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The documents, or those asked for: the filter reaches the stripes' statistics."""
    rows = spark.read.schema("doc_id long, n_tokens long, tokens array<int>, before long, "
                             "part int").orc(path)
    return rows.where(F.col("doc_id").isin(doc_ids)) if doc_ids is not None else rows


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, read from the files.

    ``start`` counts the ids of all documents before it: those of the files before, summed here from
    one column, and those before it in its own file, which the file keeps. Nothing else is moved.
    """
    def run(batches) -> Iterator:
        import zlib

        import pyarrow as pa
        for batch in batches:
            tokens = batch.column(3)
            values = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            bounds = tokens.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds).astype(np.int64)),
                 pa.array(sums, pa.int64()), batch.column(1), batch.column(2)],
                names=["doc_id", "n_tokens", "ids_crc32", "part", "before"])

    rows = read_tokens(spark, path).select("doc_id", "part", "before", "tokens")
    digests = rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, part int, before long")
    parts = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    earlier = F.sum("in_part").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    return (digests.join(parts, "part")
            .select("doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens",
                    "ids_crc32"))
