"""Corpus cleaning as a chain of stages: each takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and reread as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm import decontaminate, exact_dedup, piece_codec, quality, simhash
from hearthlake.llm.common import stage
from hearthlake.llm.queries import PIECE_MODEL
from hearthlake.session import let_workers_import


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts go on. It learns from the labels of the
    documents, but for those that are held out."""
    let_workers_import(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    weights = quality.train(docs, labels, ~quality.held_out(F.col("doc_id")))
    scored = quality.score(docs, weights, score_col="__quality")
    return scored.filter(F.col("__quality") >= quality.THRESHOLD).drop("__quality")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (the largest id) goes on."""
    let_workers_import(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints (the smallest id) goes on."""
    let_workers_import(spark)
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item go on."""
    let_workers_import(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.find_leaks(docs, benchmark, matches_col="__leaks")
    return found.filter(F.size("__leaks") == 0).drop("__leaks")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each kept document, and the text decoded from them."""
    let_workers_import(spark)
    return piece_codec.encode_decode(docs, PIECE_MODEL)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # model training and multi-index hashing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
