"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm import decontaminate, language, lines, mixing, simhash
from tellerlake.llm.tables import store, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter to tell a language by go; those that state no language get the one they are in."""
    return language.with_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go from their texts; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, words=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot, in the order of the mixture."""
    return mixing.mix(docs, mixing.SHARES).orderBy("slot", "place")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: Fitted models and fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
