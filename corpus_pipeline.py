"""The corpus pipeline: quality, exact copies, near copies, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
one's documents. All but the last return the columns of ``documents``.

In every stage a null text counts as empty, nulls in other columns stay, a null id is an id like any other,
very long texts are read whole, rows that repeat are rows of their own (told apart by a number of this
module's), an empty table gives an empty one, and further columns of the documents, whatever their
names, are dropped. Reruns give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescope.llm import exact_dedup, jaccard_join, mixing, packing, quality
from tonescope.session import collected_folders, remove_folders, work_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Work folders of the stage before, by session.
_left_over: dict[int, list[str]] = {}


def _stage(function: Stage) -> Stage:
    """A stage whose work folders go when the next stage starts from its written result."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _left_over.pop(id(spark), [])
        read = docs.inputFiles() if before else []
        # A caller that has not written the result still needs them. Their last names are unique.
        if not any(folder.rsplit("/", 1)[-1] in path for path in read for folder in before):
            remove_folders(spark, before)
        with collected_folders() as folders:
            result = function(spark, docs, sf_dir)
        _left_over[id(spark)] = folders
        return result
    return run_stage


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with a number each that later reads repeat: rows may share an id."""
    path = work_folder(spark, "numbered")
    docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' vote does not reject. Without a labelled document every score is
    0.5 (or the share of label 1), which is accepted."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.accepted(docs.select(*COLUMNS), model)


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id; of those that share it, any one, a null
    id only among null ids. Documents without text are equal."""
    numbered = _numbered(spark, docs)
    keyed = exact_dedup.deduplicate(numbered, doc_id="_row").select(
        F.col("doc_id").alias("_row"), F.col("keep_id").alias("_class"))
    best = (numbered.select("_row", "doc_id").join(keyed, "_row").groupBy("_class")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("best")))
    return (numbered.join(best.select("best._row"), "_row", "left_semi").select(*COLUMNS))


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: five words, 0.8 or more. Documents without words
    are similar to nothing and stay."""
    numbered = _numbered(spark, docs)
    parts = jaccard_join.similar_components(numbered, k=5, percent=80, doc_id="_row")
    kept = parts.where("doc_id = component_id").select(F.col("doc_id").alias("_row"))
    return numbered.join(kept, "_row", "left_semi").select(*COLUMNS)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it; none of a document without words, as it adds
    none. Of equal documents it does not matter which one is taken."""
    numbered = _numbered(spark, docs)
    copies = mixing.mix(numbered, row="_row").select("_row", "copies")
    return (numbered.join(copies, "_row")
            .withColumn("_copy", F.explode(F.expr("sequence(1, greatest(copies, 0) + 1)")))
            .where("_copy <= copies").select(*COLUMNS))


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, with their ids; a document without text is its end id."""
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("exact_dedup", without_copies),
          ("near_dedup", without_near_copies), ("mixing", mixed), ("packing", packed)]

#: SQL can express neither the classifier nor the sampling; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    remove_folders(spark, _left_over.pop(id(spark), []))
    return docs
