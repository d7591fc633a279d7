"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescope.session import work_folder

from . import (chat, conversation_repair, exact_dedup, jaccard_join, licenses, line_dedup, lm_scoring,
               minhash, mixing, orc_tokens, packing, periodic_runs, quality)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op2_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "orc-tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return orc_tokens.token_digests(spark, path)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    path = work_folder(spark, "chat")
    chat.format_turns(given.unionByName(extra)).write.parquet(path)
    return chat.conversation_digests(spark.read.parquet(path))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"), k=3,
                                           percent=90).drop("row")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_digests(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic_runs.find_runs(planted).withColumn(
        "best", periodic_runs.strongest(F.col("runs")))
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", milli.alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_orc_tokens, op3_chat, op4_minhash, op5_exact_dedup, op6_mixing, op7_lm_scoring,
    op8_licenses, op9_jaccard_join, op10_quality, op11_line_dedup, op12_conversation_repair,
    op13_periodic_runs)}
ORACLES = {"op8_licenses": licenses.scan_sql(), "op11_line_dedup": line_dedup.line_sql(),
           "op12_conversation_repair": conversation_repair.repair_sql(),
           "op13_periodic_runs": periodic_runs.runs_sql()}
