"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a reliable copy: a lost executor costs a reread, not
    a recomputation, and later readers prune columns."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, size: int, *key: str) -> DataFrame:
    """About ``size`` of the rows that differ in ``key`` (which must say all that is learnt from),
    picked by its hash. The share comes from the number of distinct hashes (estimated to about 5 %),
    so rows that repeat count once and no key can fill the sample. The rows left out are dropped
    where they are read; nothing is sorted."""
    rows = rows.withColumn("__h", F.xxhash64(*key))
    n = rows.agg(F.approx_count_distinct("__h")).first()[0]
    if n > size:
        rows = rows.filter(F.pmod("__h", F.lit(1 << 30)) < int(size / n * (1 << 30)))
    return rows.dropDuplicates(["__h"]).drop("__h")


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id and text hash are in ``keys`` (__id, __hash, __copies: how many
    rows have that key), one row for each key. Columns and names of ``docs`` stay as they are."""
    d = docs.withColumn("__h", F.xxhash64(F.col(text_col)))

    def pick(k: DataFrame) -> DataFrame:
        on = d[id_col].eqNullSafe(k["__id"]) & (d["__h"] == k["__hash"])
        return d.join(k.select("__id", "__hash"), on, "left_semi")
    out = pick(keys)
    repeated = keys.filter("__copies > 1")
    if not repeated.isEmpty():  # rows that agree in id and text: any one of them stays
        out = pick(keys.filter("__copies = 1")).unionByName(pick(repeated).dropDuplicates([id_col, "__h"]))
    return out.drop("__h")


def fold_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v: long, u != v) as (u, root), root the smallest
    vertex reachable; roots themselves are not listed.

    Alternates large-star and small-star steps (each vertex hands its smallest neighbour to
    the others), which needs a number of rounds logarithmic in the longest chain. Every step
    is a grouped minimum (combined map-side) joined back to the edges, so a vertex with very
    many neighbours is a hot join key, which adaptive execution splits. Each round is staged.
    """
    def step(e: DataFrame, small: bool) -> DataFrame:
        if not small:  # every edge in both directions
            e = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        if small:  # u > v in every row
            moved = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            return moved.union(low.select("u", F.col("m").alias("v"))).distinct()
        low = low.withColumn("m", F.least("u", "m"))
        return e.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = mark(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        e = stage(step(step(e, small=False), small=True), name)
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select("u", F.col("v").alias("root"))
