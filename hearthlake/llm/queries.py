"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame, and their SQL.

Each query applies its operator to its whole table with production parameters and derives the
columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm import (
    ctw,
    decontaminate,
    exact_dedup,
    language_id,
    packing,
    periodic_runs,
    personal_data,
    piece_codec,
    quality,
    records,
    simhash,
    spelling,
    url_filter,
)

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds; clean documents have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", F.lit(True).alias("contaminated"), "leak.cosine", "leak.share", "leak.first_word")


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_codec.encode_decode(docs, PIECE_MODEL).select("doc_id", *piece_codec.digests())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    return quality.score(docs, weights, score_col="score").select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(personal_data.KINDS)],
        F.sha2(personal_data.written("base"), 256).alias("base_sha256"), personal_data.written("all").alias("spans"))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(table(spark, sf_dir, "documents"))


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = records.records_folder(docs)
    index = records.write_records(docs, folder, WORD_MODEL, end_id=1)
    return records.read_records(index, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    found = periodic_runs.find_runs(docs)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), periodic_runs.longest_run().alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_MODEL)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), drop_letter_of=97)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_exact_dedup, op2_simhash, op3_decontaminate, op4_piece_codec, op5_language_id, op6_url_filter, op7_quality,
        op8_personal_data, op9_ctw, op10_records, op11_periodic_runs, op12_packing, op13_spelling)}


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
}
