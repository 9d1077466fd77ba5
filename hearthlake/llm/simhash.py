"""Near-duplicate detection: SimHash fingerprints linked through multi-index hashing.

A fingerprint has 64 bits: bit b is set if more than half of the text's shingle hashes have it.
Two fingerprints that differ in at most two bits agree up to one bit in the upper half or
exactly in the lower half, so the index has one table for each half: a fingerprint probes the
upper table with the ball of radius one around its upper half (33 keys) and the lower table
with its lower half, and every match is verified by the distance over all 64 bits. Links
are folded into components.

Equal fingerprints are one class, indexed once, so a group of copies costs one row. A table
bucket that holds more classes than a whole ball of radius two has members (2,081) is not
compared pair by pair: its classes look the members of their ball up directly. Both ways are
exact and nothing is capped. Spark takes exploded rows for no more than the rows they come from,
so the joins of keys and balls are sort-merge joins by hint: never a broadcast through the driver.

Defined cases: a null or empty text, or one without words, has the fingerprint zero and is
linked like any other; a text of one or two words has one shingle, the whole sequence; rows
with a null id are linked too, but never name a component unless all its ids are null; rows
that repeat join the same component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.common import fold_components, keep_rows, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CROWDED = 2_081  # classes of a bucket from which the ball around a fingerprint is smaller


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text (A-Z lower-cased) as an unsigned 64-bit number."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    flat = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = max(1, len(tokens) - words + 1)
    ends = ends[words - 1:] if len(tokens) >= words else ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    counts, n = np.zeros(64, np.int64), len(ends)
    for at in range(0, n, 8192):
        piece = [digest(flat[i:j], seed) for i, j in zip(starts[:last][at:at + 8192].tolist(),
                                                         ends[at:at + 8192].tolist(), strict=True)]
        bits = np.unpackbits(np.array(piece, ">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, hash of the text, fp): fp is the fingerprint as a signed long."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"),
                         F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("hash", T.LongType()),
                           T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py() or "", words) for x in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("hash"), pa.array(fps.view(np.int64))],
                                             names=["id", "hash", "fp"])
    return source.mapInArrow(run, schema)


def links(classes: DataFrame) -> DataFrame:
    """Pairs (u, v) of different fingerprints (column fp, distinct) at most two bits apart."""
    upper, lower = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)
    flips32 = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(32)])
    table = classes.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), upper.alias("key")),
        F.struct(F.lit(1).alias("part"), lower.alias("key")))).alias("at")).select("at.part", "at.key", "fp")
    probes = classes.select("fp", F.explode(F.concat(
        F.transform(flips32, lambda f: F.struct(F.lit(0).alias("part"), upper.bitwiseXOR(f).alias("key"))),
        F.array(F.struct(F.lit(1).alias("part"), lower.alias("key"))))).alias("at")).select("at.part", "at.key", "fp")
    crowded = stage(table.groupBy("part", "key").count().filter(F.col("count") > CROWDED)
                    .select("part", "key"), "simhash-crowded")
    parted = not crowded.isEmpty()
    calm = table.join(crowded, ["part", "key"], "left_anti") if parted else table
    t, p = calm.withColumnRenamed("fp", "u").hint("merge"), probes.withColumnRenamed("fp", "v")
    near = (F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS)
    found = t.join(p, (t["part"] == p["part"]) & (t["key"] == p["key"]) & near).select("u", "v")
    if parted:
        busy = table.join(crowded, ["part", "key"], "left_semi").select("fp").distinct()
        flips = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
        ball = (busy.withColumn("a", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)))
                .withColumn("b", F.explode(flips)).filter("a <> b")
                .select(F.col("fp").alias("u"), F.expr("fp ^ a ^ b").alias("w")))
        whole = classes.select(F.col("fp").alias("v")).hint("merge")
        found = found.union(ball.join(whole, F.col("w") == F.col("v")).select("u", "v"))
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def components(marks: DataFrame) -> DataFrame:
    """(fp, component_id): the smallest id reachable over links, from ``marks`` (id, fp)."""
    classes = stage(marks.groupBy("fp").agg(F.min("id").alias("low")), "simhash-classes")
    roots = fold_components(links(classes.select("fp")), "simhash-links")
    joined = classes.join(roots, classes["fp"] == roots["u"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    return stage(joined.join(lowest, "root").select("fp", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS) -> DataFrame:
    """One row for each row of ``docs``: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``. Only id and text are read, so other columns cannot clash."""
    marks = stage(fingerprints(docs, id_col, text_col, words).select("id", "fp"), "simhash-marks")
    return marks.join(components(marks), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (of equal ids, the
    one with the smallest text hash)."""
    marks = stage(fingerprints(docs, id_col, text_col, words), "simhash-marks")
    named = marks.join(components(marks), "fp")
    first = named.groupBy("id", "hash", "component_id").agg(F.count("*").alias("n")).groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "hash", "n")).alias("first"))
    keys = stage(first.select(F.col("first.id").alias("__id"), F.col("first.hash").alias("__hash"),
                              F.col("first.n").alias("__copies")), "simhash-kept")
    return keep_rows(docs, keys, id_col, text_col)
