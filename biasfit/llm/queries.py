"""Queries of the operators over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (fingerprints, hard_negatives, lexical, licenses, lines, mixing, neighbours, packing, pii, rules, simhash, tokens,
               toxicity)
from .common import read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_documents(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: Hosts made by rule: documents by length in code points, in steps of so many, up to a last host.
LENGTH_STEP, LAST_HOST = 150, 20


def quality_rules_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules with hosts made by rule, of which the one of the shortest
    texts is rejected with its good documents; verdicts joined, not broadcast."""
    docs = read(spark, sf_dir, "documents")
    step = F.floor(F.length(F.coalesce("text", F.lit(""))) / LENGTH_STEP).cast("int")
    return rules.quality(docs.withColumn("source", F.least(step, F.lit(LAST_HOST))), broadcast_rows=0)


def mixing_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix with the sources' plan joined, not broadcast."""
    return mixing.mix(read(spark, sf_dir, "documents"), broadcast_rows=0).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_pii, op3_quality_rules, op4_toxicity, op5_simhash, op6_license_scan, op7_neighbours, op8_line_dedup,
    op9_token_counts, op10_mixing, op11_fingerprints, op12_hard_negatives, op13_lexical_search, quality_rules_by_length,
    mixing_joined)}
ORACLE = {"op3_quality_rules": rules.ORACLE, "op8_line_dedup": lines.ORACLE, "op10_mixing": mixing.ORACLE,
          "op12_hard_negatives": hard_negatives.ORACLE, "op13_lexical_search": lexical.ORACLE,
          "quality_rules_by_length": rules.ORACLE.replace(
              "doc_id, source, coalesce(text", f"doc_id, least(length(coalesce(text, '')) // {LENGTH_STEP}, {LAST_HOST}) as source, coalesce(text", 1),
          "mixing_joined": mixing.ORACLE}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
