"""The corpus pipeline: five stages over ``documents``, and all queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwright.llm import language_id, line_alignment, packing, queries, signature_join, toxicity
from rollwright.llm.common import BYTE_VOCABULARY, tokenizer_path
from rollwright.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar, fitted on the labels of this folder, predicts as toxic go."""
    labels = queries.table(spark, sf_dir, "labels")
    gone = toxicity.toxicity(docs, labels).where("predicted = 1").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def in_declared_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose declared language the fused evidence refutes go."""
    return language_id.documents_in_language(docs).select(COLUMNS)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are cut from later ones; one that keeps no word goes."""
    cut = line_alignment.without_aligned_lines(docs)
    emptied = F.coalesce(F.size("_removed") > 0, F.lit(False)) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    return cut.where(~emptied).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8) the one with the smallest id stays."""
    gone = signature_join.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, and their places in sequences of 2048 ids."""
    pieces = packing.token_pieces(docs, tokenizer_path(BYTE_VOCABULARY), capacity=2048, end_id=0).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(pieces, 2048)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("language", in_declared_language),
    ("line_dedup", without_shared_lines),
    ("near_dedup", one_of_each_group),
    ("packing", packed),
]

ORACLE_SQL = None  # tokenizing and the fitted stages cannot be said in SQL; tests use plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = queries.QUERIES | {"pipeline": run}
ORACLES = queries.ORACLES
