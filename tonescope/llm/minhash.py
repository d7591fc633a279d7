"""Operator 4, document fingerprints by MinHash.

A fingerprint holds, for each of a number of universal hash functions, the least value over the word
shingles of the whole text, computed by numpy inside tasks. The share of equal values estimates the
Jaccard similarity of two texts. ``near_pairs`` joins bands of the fingerprints in Spark and verifies
the similarity of what meets on whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonescope.session import work_folder

from .jaccard_join import connected, shingle_arrays
from .words import WordHasher, mix, shingles

PERMUTATIONS = 128
#: Shingles looked at together: they stay in a processor's cache.
BLOCK = 8192


class Hasher:
    """Fingerprints of texts. Function i maps x to the high half of a_i x + b_i modulo 2^64."""

    def __init__(self, k: int = 5, permutations: int = PERMUTATIONS, lower: bool = True):
        numbers = mix(np.arange(1, 2 * permutations + 1, dtype=np.uint64))
        self.a, self.b = numbers[::2] | np.uint64(1), numbers[1::2]
        self.k, self.words = k, WordHasher(lower)

    def fingerprints(self, texts) -> np.ndarray:
        """One row of 32-bit values per text; all of them the greatest where there is no word."""
        values, sizes = shingles(*self.words.words(texts), self.k)
        out = np.full((len(sizes), len(self.a)), 0xFFFFFFFF, np.uint32)
        ends = np.cumsum(sizes)
        for at in range(0, len(values), BLOCK):
            block = values[at:at + BLOCK]
            first = np.searchsorted(ends, at, "right")
            last = np.searchsorted(ends, at + len(block) - 1, "right")
            rows = np.arange(first, last + 1)[sizes[first:last + 1] > 0]
            starts = np.maximum(ends[rows] - sizes[rows] - at, 0)
            for i, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
                least = np.minimum.reduceat((block * a + b) >> np.uint64(32), starts)
                out[rows, i] = np.minimum(out[rows, i], least)
        return out


def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``bucket, halo, doc_id, text, next`` in buckets of ascending ids, each sorted.

    Rows are ordered by id (null first), then text. The last row of a bucket needs the first of the
    next one, and the last of all the first of all: that row is added to the bucket as its ``halo``.
    Texts are shuffled once.
    """
    from pyspark.ml.feature import Bucketizer
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300)))
    cuts = rows.select("at").approxQuantile("at", [i / buckets for i in range(1, buckets)],
                                            1 / (4 * buckets)) if buckets > 1 else []
    # A table without rows has no cuts, and a Bucketizer wants one.
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="at", outputCol="bucket").transform(rows)
    dealt = dealt.withColumn("bucket", F.col("bucket").cast("int"))
    # One number per bucket, of a bounded number of buckets.
    firsts = sorted((r[0], r[1]) for r in dealt.groupBy("bucket").agg(F.min("at")).collect())
    halo = [(at, firsts[i - 1][0]) for i, (_, at) in enumerate(firsts)]
    halos = spark.createDataFrame(halo, "first double, before int")
    heads = (dealt.join(F.broadcast(halos), F.col("at") == F.col("first"))
             .select(F.col("before").alias("bucket"), "doc_id", "at",
                     F.struct("doc_id", "text").alias("head"))
             .groupBy("bucket", "doc_id", "at").agg(F.min("head.text").alias("text"))
             .select("bucket", F.lit(1).alias("halo"), "doc_id", "at", "text"))
    both = dealt.select("bucket", F.lit(0).alias("halo"), "doc_id", "at", "text").unionByName(heads)
    order = Window.partitionBy("bucket").orderBy("halo", "at", "doc_id", "text")
    return both.select("bucket", "halo", "doc_id", "text", F.lead("text").over(order).alias("next"))


def fingerprint(docs: DataFrame, k: int = 5, permutations: int = PERMUTATIONS,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last quarter (rounded down) replaced by as many first characters of the
    next document, ascending id; after the last comes the first. ``near_edited`` and ``near_next``
    are the shares of equal values with the edited and with the next text. A fingerprint is the
    values as hexadecimal text, eight digits each. Texts without words, null ones too, are all
    alike: their values are the greatest. Null ids come first, rows that repeat an id are ordered by
    text. A single row is its own next. A very long text is hashed whole, block by block. An empty table
    gives no rows. Other columns are not read.
    """
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter),
                      F.substring(F.coalesce("next", F.lit("")), F.lit(1), quarter))
    rows = in_order(docs, doc_id, text).withColumn(
        "edited", F.when(F.col("halo") == 0, edited).otherwise(""))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), "bucket", "halo", "text",
                       "edited")

    def run(batches) -> Iterator:
        import pyarrow as pa
        hasher = Hasher(k, permutations)
        held = None  # the last row, until the next one is known

        def finished(table, prints, other, following):
            near = (prints == other).mean(axis=1)
            width = prints.shape[1] * 8

            def text_of(x):
                flat = x.astype(">u4").tobytes().hex()
                return pa.array([flat[i:i + width] for i in range(0, len(flat), width)], pa.string())
            out = pa.RecordBatch.from_arrays(
                [*table.columns[:3], text_of(prints), text_of(other), pa.array(near),
                 pa.array((prints == following).mean(axis=1))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])
            return out.filter(pa.compute.equal(table.column(4), 0))

        for batch in batches:
            import pyarrow.compute  # noqa: F401
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                prints = hasher.fingerprints(part.column(5))
                other = hasher.fingerprints(part.column(6))
                if held is not None:
                    yield finished(*held, prints[:1])
                if len(prints) > 1:
                    yield finished(part.slice(0, len(prints) - 1), prints[:-1], other[:-1], prints[1:])
                last = len(prints) - 1
                held = part.slice(last), prints[last:], other[last:]
        if held is not None:
            yield finished(*held, held[1])

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, "
                                "fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double")


def near_pairs(docs: DataFrame, k: int = 5, similarity: float = 0.8, bands: int = 32,
               permutations: int = PERMUTATIONS, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``doc_id, class_id`` of every row: the smallest id among the near duplicates it reaches.

    Different fingerprints that agree in one of ``bands`` bands meet. Per band value the first
    fingerprint is compared with the others on whole shingle sets; then it has met them all, leaves,
    and the next one follows, as long as a band value holds texts of different classes. So a large
    group of near copies takes one comparison per text, and no pair that met is lost. Texts without
    words are near nothing. Nulls, repeated rows, very long texts and empty tables are as for
    ``fingerprint``.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "minhash")
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        hasher, at = Hasher(k, permutations), TaskContext.get().partitionId() << 36
        for batch in batches:
            prints = hasher.fingerprints(batch.column(1))
            worded = (prints != 0xFFFFFFFF).any(axis=1)
            stored = [p.tobytes() if w else None for p, w in zip(prints, worded, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at + np.arange(len(prints))), batch.column(0), batch.column(1),
                 pa.array(stored, pa.binary())], names=["row", "doc_id", "text", "print"])
            at += len(prints)

    rows.mapInArrow(run, "row long, doc_id long, text string, print binary").write.parquet(
        f"{folder}/prints")
    prints = spark.read.parquet(f"{folder}/prints")
    classes = prints.where("print is not null").groupBy("print").agg(F.min("row").alias("node"))
    members = prints.select("row", "doc_id", "print").join(classes, "print", "left")
    members = members.select("row", "doc_id", "print", F.coalesce("node", "row").alias("node"))
    members.write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")
    width = 4 * permutations // bands
    key = [F.xxhash64(F.lit(b), F.substring("print", b * width + 1, width)) for b in range(bands)]
    met = (members.where("row = node and print is not null")
           .select("node", F.explode(F.array(*key)).alias("key")))
    met.write.parquet(f"{folder}/met")
    met = spark.read.parquet(f"{folder}/met")
    shared = met.groupBy("key").count().where("count > 1").select("key")
    left = met.join(shared, "key", "left_semi")
    wanted = left.select("node").distinct()
    texts = prints.withColumnRenamed("row", "node").join(wanted, "node", "left_semi")
    shingle_arrays(texts.select("node", "text"), k, True).write.parquet(f"{folder}/arrays")
    arrays = spark.read.parquet(f"{folder}/arrays")

    def verify(batches) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(common >= similarity * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    level = 0
    while True:
        placed = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        state = placed.groupBy("key").agg(F.min("node").alias("a"), F.min("root").alias("x"),
                                          F.max("root").alias("y")).where("x <> y")
        stars = (left.join(state.select("key", "a"), "key").where("node <> a"))
        stars.write.parquet(f"{folder}/stars{level}")
        stars = spark.read.parquet(f"{folder}/stars{level}")
        if stars.isEmpty():
            break
        sides = [arrays.select(F.col("node").alias(s), F.col("elements").alias(f"{s}_elements"))
                 for s in ("a", "b")]
        pairs = stars.select("a", F.col("node").alias("b")).distinct()
        whole = pairs.join(sides[0], "a").join(sides[1], "b")
        found = whole.select("a", "b", "a_elements", "b_elements").mapInArrow(
            verify, "a long, b long")
        found.write.parquet(f"{folder}/links{level}")
        links = links.unionByName(spark.read.parquet(f"{folder}/links{level}"))
        connected(links, f"{folder}/roots{level}").write.parquet(f"{folder}/rooted{level}")
        roots = spark.read.parquet(f"{folder}/rooted{level}")
        left, level = stars.select("node", "key"), level + 1
    final = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = final.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return final.join(least, "root").select("doc_id", "class_id")
