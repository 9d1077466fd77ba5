"""Exact deduplication with a minimal perfect hash over historical digests.

The distinct text digests of a *history* are spread over shards of bounded size by their
leading bits. Each shard gets a minimal perfect hash: every digest owns one slot, and the slot
holds the full 32-byte digest and the locator of the winning row (its id). A later batch looks
its distinct digests up; the hash sends a digest to one slot, and comparing all 32 bytes tells
members (repeats of the history) from nonmembers, which are grouped among themselves.

Copies of one text are combined before any shuffle (grouped maximum and count), so a text that
holds a third of all rows reaches a shard as one row for each map task.

Defined cases: a null text counts as empty; a null id sorts below every other id (a group of
null ids only has a null winner); rows that repeat with the same id and text are one group, and
one of them stays; an empty table or an empty history gives an empty result or no members.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.common import ascii_lower, id_crc32, stage

SHARD_DIGESTS = 50_000  # digests of a shard: about 4 MB in a task
LEVEL_LOAD = 2  # bits of a level for each key not yet placed


def text_sha256(text: Column) -> Column:
    """Digest of the normalised text (A-Z lower-cased), lowercase hex."""
    return F.sha2(ascii_lower(text), 256)


class PerfectHash:
    """Minimal perfect hash of distinct 32-byte keys, given as rows of four 64-bit words.

    Level by level, the keys still to be placed are hashed into a bit vector; a key alone on its
    bit is placed there, the others go on to the next level. A key's slot is the number of
    placed bits before its own, over all levels."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.rank = np.cumsum(self.bits) - 1

    @staticmethod
    def spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = np.full(len(keys), (level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for word in range(keys.shape[1]):
            x = (x ^ keys[:, word]) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = max(64, -(-len(left) * LEVEL_LOAD // 8) * 8)
            at = cls.spot(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone))
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        return cls(sizes, b"".join(x.tobytes() for x in levels))

    def dump(self) -> bytes:
        return np.packbits(self.bits).tobytes()

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key, -1 where no level has its bit. A key that is not in the set may
        get any slot: compare what the slot holds."""
        out, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + self.spot(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, start = left[~hit], start + size
        return out


def digest_words(hexes: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Hex digests as rows of four 64-bit words."""
    return np.frombuffer(bytes.fromhex("".join(hexes.to_pylist())), ">u8").astype(np.uint64).reshape(-1, 4)


def _grouped(keys: DataFrame) -> DataFrame:
    """For each digest: the largest id, the rows, and the rows that have that id."""
    per_id = keys.groupBy("digest", "id").agg(F.count("*").alias("n"))
    return per_id.groupBy("digest").agg(F.max("id").alias("id"), F.sum("n").alias("rows"),
                                        F.max_by("n", F.struct(F.col("id").isNotNull(), "id")).alias("top"))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row for each shard: the perfect hash and, in slot order, digests, winners and counts.
    ``history``: digest, id, rows, top, one row for each digest."""
    id_type = history.schema["id"].dataType
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("bits", T.BinaryType()), T.StructField("digests", T.BinaryType()),
        T.StructField("id", T.ArrayType(id_type)), T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("top", T.ArrayType(T.LongType()))])

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        words = digest_words(table["digest"])
        mph = PerfectHash.build(words)
        order = np.argsort(mph.slots(words))
        t = table.take(order)
        return pa.table({
            "shard": [t["shard"][0].as_py()], "sizes": [mph.sizes], "bits": [mph.dump()],
            "digests": [words[order].astype(">u8").tobytes()],
            **{c: pa.array([t[c].to_pylist()], pa.list_(t[c].type)) for c in ("id", "rows", "top")}})
    return with_shard(history, shards).groupBy("shard").applyInArrow(build, schema)


def with_shard(keys: DataFrame, shards: int) -> DataFrame:
    lead = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")
    return keys.select(F.pmod(lead, F.lit(shards)).alias("shard"), "digest", "id", "rows", "top")


def probe(index: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """Merge a batch (digest, id, rows, top; one row for each digest) into the index: one row for
    each digest of either, with ``member`` true where a digest of the batch was in the history."""
    id_type = batch.schema["id"].dataType
    schema = T.StructType([T.StructField("digest", T.StringType()), T.StructField("id", id_type),
                           T.StructField("rows", T.LongType()), T.StructField("top", T.LongType()),
                           T.StructField("member", T.BooleanType())])

    def merge(new: pa.Table, idx: pa.Table) -> pa.Table:
        new = new.combine_chunks()
        words, parts = digest_words(new["digest"]), []
        found = np.full(new.num_rows, -1, np.int64)
        if idx.num_rows:
            row = idx.slice(0, 1).to_pylist()[0]
            held = np.frombuffer(row["digests"], ">u8").astype(np.uint64).reshape(-1, 4)
            slot = PerfectHash(row["sizes"], row["bits"]).slots(words)
            same = (slot >= 0) & (held[np.maximum(slot, 0)] == words).all(1)  # all 32 bytes agree
            found = np.where(same, slot, -1)
            back = np.full(len(held), -1, np.int64)
            back[found[found >= 0]] = np.flatnonzero(found >= 0)
            old = pa.table({c: pa.array(row[c], new[c].type) for c in ("id", "rows", "top")})
            hit = pa.array(back, mask=back < 0)
            add = new.select(["id", "rows", "top"]).take(hit)
            member = pa.array(back >= 0)
            first = pc.max_element_wise(old["id"], add["id"])
            hits = lambda t: pc.if_else(pc.or_(pc.equal(t["id"], first).fill_null(False),
                                               pc.and_(pc.is_null(t["id"]), pc.is_null(first))),
                                        t["top"].fill_null(0), 0)
            parts.append(pa.table({
                "digest": pa.array([w.tobytes().hex() for w in held.astype(">u8")], pa.string()), "id": first,
                "rows": pc.add(old["rows"], add["rows"].fill_null(0)),
                "top": pc.add(hits(old), hits(add)), "member": member}))
        rest = new.filter(pa.array(found < 0))
        parts.append(pa.table({"digest": rest["digest"], "id": rest["id"], "rows": rest["rows"], "top": rest["top"],
                               "member": pa.array(np.zeros(rest.num_rows, bool))}))
        return pa.concat_tables(parts).cast(pa.schema([(f.name, parts[-1].schema.field(f.name).type)
                                                       for f in parts[-1].schema]))
    return (with_shard(batch, shards).groupBy("shard")
            .cogroup(index.groupBy("shard")).applyInArrow(merge, schema))


def first_half(id_col: Column) -> Column:
    """Default split of one table into history and batch: half of the ids by their hash. Every
    row is judged either way; the split only says which side is indexed and which is looked up."""
    return id_crc32(id_col) % 2 == 0


def text_groups(keys: DataFrame, is_history: Callable[[Column], Column] = first_half) -> DataFrame:
    """Groups of equal texts from (id, digest): digest, id (winner), rows, top, member."""
    history = stage(_grouped(keys.filter(is_history(F.col("id")))), "dedup-history")
    batch = stage(_grouped(keys.filter(~is_history(F.col("id")))), "dedup-batch")
    shards = max(1, -(-max(history.count(), batch.count()) // SHARD_DIGESTS))  # either may be the larger
    index = stage(build_index(history, shards), "dedup-index")
    return stage(probe(index, batch, shards), "dedup-groups")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     is_history: Callable[[Column], Column] = first_half) -> DataFrame:
    """One row for each row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``. Only id and text are read, so other columns of ``docs`` cannot clash."""
    keys = docs.select(F.col(id_col).alias("id"), text_sha256(F.col(text_col)).alias("digest"))
    keys = stage(keys.withColumn("row", F.monotonically_increasing_id()), "dedup-keys")  # staged: row numbers stay
    groups = text_groups(keys, is_history).withColumnRenamed("id", "keep_id")
    marked = keys.join(groups, "digest").withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    if not groups.filter("top > 1").isEmpty():  # the winning id repeats: its first row stays
        firsts = marked.filter("kept AND top > 1").groupBy("digest").agg(F.min("row").alias("first"))
        marked = marked.join(firsts, "digest", "left").withColumn("kept", F.expr("kept AND (first IS NULL OR row = first)"))
    return marked.select(F.col("id").alias(id_col), "keep_id", F.col("rows").alias("group_size"), "kept",
                         F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one with the largest id."""
    digest = text_sha256(F.col(text_col))
    keys = stage(docs.select(F.col(id_col).alias("id"), digest.alias("digest")), "dedup-keys")
    groups = text_groups(keys).select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), "top")
    d = docs.withColumn("__d", digest)
    on = lambda g: (d["__d"] == g["__digest"]) & d[id_col].eqNullSafe(g["__id"])
    out = d.join(groups, on(groups), "left_semi")
    repeated = groups.filter("top > 1")
    if not repeated.isEmpty():
        single = groups.filter("top = 1")
        out = (d.join(single, on(single), "left_semi")
               .unionByName(d.join(repeated, on(repeated), "left_semi").dropDuplicates(["__d"])))
    return out.drop("__d")
