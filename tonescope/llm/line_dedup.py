"""Operator 11, line deduplication: lines that many documents share stay in one document only.

1. Every long enough line becomes a row: its document and two 64-bit hashes of its normalised form.
2. Documents are counted per hash, each once, and the largest id is found. Lines of one document, and
   then counts of one hash, are merged before they are shuffled, so a line that a third of all
   documents hold is no heavier than others.
3. The hashes over the threshold, a slim table, meet the rows again; what each text has to drop
   comes back to it, and its other lines are joined in their old order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescope.session import work_folder

SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    """Without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _LOWER)


def _hashes(key: Column) -> Column:
    """128 bits: at 10^12 lines, different ones agree with a chance of 10^-14."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def line_keys(texts: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, t1, t2, h1, h2``: a row per line whose normalised form has ``min_chars`` code points.

    ``texts`` has ``doc_id, text, t1, t2``.
    """
    lines = texts.select("doc_id", "t1", "t2", F.explode(F.split("text", "\n", -1)).alias("line"))
    # A line is no shorter than its normalised form: most lines of prose tables end here.
    keyed = lines.where(F.length("line") >= min_chars).select(
        "doc_id", "t1", "t2", normalised(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc_id", "t1", "t2", _hashes(F.col("key")).alias("h")).select(
        "doc_id", "t1", "t2", "h.h1", "h.h2")


def shared_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """``h1, h2, n_docs, keeper`` of the lines in at least ``min_docs`` documents; the keeper is the
    largest id that holds the line (null, the smallest, only where no other does)."""
    # Two steps instead of a distinct count beside a maximum: each merges within a task first.
    held = keys.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    counted = held.groupBy("h1", "h2").agg(F.count("one").alias("n_docs"),
                                           F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def drop_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    r"""``doc_id, text, n_lines, n_dropped`` of every row, ``text`` without the dropped lines.

    Whole texts are split at ``\n``; an empty or null text is one empty line. Lines are equal when they
    agree after ASCII white space at both ends is cut and A-Z are lower-cased. A line of at least
    ``min_chars`` code points so normalised, found in at least ``min_docs`` documents, is dropped
    wherever it stands but in the document with the largest id that holds it, where it stays as often
    as it stands there. Rows that share an id are one document, and so are the rows without one, which
    come before all others. A text that loses all lines is empty. Very long texts are split whole,
    within one row. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                        F.coalesce(docs[text], F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("text").alias("t1"),
                         F.xxhash64(F.lit("text"), "text").alias("t2"))
    keys = line_keys(texts, min_chars)
    folder = work_folder(spark, "line-dedup")
    # Written, so that the joins below have plain exchanges on both sides, which AQE can split where a
    # line is hot, or broadcasts where the table turns out to be small.
    shared_lines(keys, min_docs).write.parquet(f"{folder}/shared")
    shared = spark.read.parquet(f"{folder}/shared")

    other = ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    lost = (keys.join(shared, ["h1", "h2"]).where(other).groupBy("doc_id", "t1", "t2")
            .agg(F.collect_set(F.struct("h1", "h2")).alias("lost")))
    lost.write.parquet(f"{folder}/lost")
    lost = spark.read.parquet(f"{folder}/lost").withColumnRenamed("doc_id", "lost_id")

    joined = texts.alias("a").join(lost.alias("b"), (F.col("a.t1") == F.col("b.t1")) & (
        F.col("a.t2") == F.col("b.t2")) & F.col("doc_id").eqNullSafe(F.col("lost_id")), "left")
    lines = F.split("text", "\n", -1)
    split = joined.select("doc_id", "text", "lost", lines.alias("lines"))
    kept = F.filter("lines", lambda line: ~F.array_contains(
        F.col("lost"), _hashes(normalised(line))))
    split = split.select("doc_id", "text", F.size("lines").alias("n_lines"),
                         F.when(F.col("lost").isNotNull(), kept).alias("kept"))
    return split.select(
        "doc_id", F.coalesce(F.array_join("kept", "\n"), "text").alias("text"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"))


def line_sql(min_chars: int = 40, min_docs: int = 5) -> str:
    """The digests of ``op11_line_dedup`` in DuckDB's SQL."""
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS place,
             unnest(string_split(text, chr(10))) AS line FROM t),
k AS (SELECT *, translate(trim(line, {spaces}), '{_UPPER}', '{_LOWER}') AS key FROM l),
shared AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {min_chars}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
j AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
      FROM k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
       AS kept_sha256
FROM j GROUP BY doc_id"""
