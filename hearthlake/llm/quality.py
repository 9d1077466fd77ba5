"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates and scored as sparse dot products.

Words and runs of punctuation are tokens; a token equal to the one before it becomes a repeat
mark, so stuttering text has features of its own. One- and two-token grams are hashed into
``2**BITS`` coordinates, counted over the whole text and scaled to length one.

Training takes every distinct labelled row (unless a caller sets ``TRAIN_ROWS``). The rows are dealt
by a hash over shards of about ``SHARD_ROWS``, at least ``SHARDS``, and their features are written
once, by shard. In every round each shard runs FTRL from the common state over its rows, row by row
as they are read; the shards' states are averaged by parts of the coordinates, as grouped sums, so
that what reaches the driver is one state however many shards there are.

Defined cases: a null or empty text has the bias as its only feature and gets a score as any
other; labels that are null are ignored, and of repeated labels for one id the smallest counts;
without any labelled row, or for an empty table, every score is 1.0 (nothing is rejected);
extra columns are passed on, except that the score replaces a column of its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.common import bounded_sample, id_crc32, stage

BITS = 18
GRAMS = 2
TRAIN_ROWS = None  # about so many rows are learnt from, all of them without a number
SHARDS, SHARD_ROWS = 8, 16_384
SHARED_KEYS = 1_000_000  # keys of labelled rows (about 130 bytes each) that are shared with the tasks; beyond, a join
PART = 2048  # coordinates of a part of a state
ROUNDS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
THRESHOLD = 0.7
BIAS = 0  # coordinate of the bias

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_REPEAT = np.uint64(0x5851F42D4C957F2D)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates and values of a text, the bias first."""
    hash32 = xxhash.xxh32_intdigest
    tokens = _TOKEN.findall(text)
    h = np.fromiter(map(hash32, tokens), np.uint64, len(tokens))
    if len(h) > 1:
        h[1:][h[1:] == h[:-1]] = _REPEAT
    rows = []
    for n in range(1, GRAMS + 1):
        if len(h) < n:
            break
        x = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            x = (x ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
        rows.append(x >> np.uint64(64 - BITS))
    if not rows:
        return np.array([BIAS]), np.ones(1, np.float32)
    at, counts = np.unique(np.concatenate(rows), return_counts=True)
    counts = counts[at != BIAS].astype(np.float32)
    at = at[at != BIAS].astype(np.int64)
    norm = float(np.sqrt((counts * counts).sum())) or 1.0
    return np.concatenate([[BIAS], at]), np.concatenate([np.ones(1, np.float32), counts / norm])


class Ftrl:
    """FTRL-proximal state: per coordinate the shifted gradient sum z and the squared gradients n."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    @classmethod
    def empty(cls) -> Ftrl:
        return cls(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)).astype(np.float32)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - y) * x
        before = self.n[at]
        after = before + g * g
        self.z[at] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
        self.n[at] = after


def sigmoid(v: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(v, -35, 35))))


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column | None, id_col: str, text_col: str,
                  label_col: str) -> DataFrame:
    """The labelled rows that differ in id or text, dealt over shards of about SHARD_ROWS."""
    one = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        one = one.filter(usable)
    one = one.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("double").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = texts.withColumn("h", F.xxhash64("id", "text"))
    keys = stage(texts.select("id", "h").join(one, "id"), "quality-keys")
    repeated = not keys.groupBy("id", "h").count().filter("count > 1").isEmpty()
    if TRAIN_ROWS is not None:  # an id may have many texts: rows are bounded, not ids
        keys = bounded_sample(keys, TRAIN_ROWS, "id", "h")
    n = keys.count()
    shards = max(SHARDS, -(-n // SHARD_ROWS))
    keys = keys.dropDuplicates(["id", "h"])
    # up to SHARED_KEYS no text is shuffled for the join
    rows = texts.join(F.broadcast(keys) if n <= SHARED_KEYS else keys, ["id", "h"])
    if repeated:  # rows that agree in id and text: any one of them
        rows = rows.dropDuplicates(["id", "h"])
    return rows.select(F.pmod("h", F.lit(shards)).alias("shard"), "h", "id", "text", "y")


def packed(at: np.ndarray) -> bytes:
    """Sorted coordinates as their differences, the first bytes of all, then the second ones, and so
    on, which compresses well."""
    return np.diff(at, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel())


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their features in place of the text."""
    for b in batches:
        found = [features(text.as_py()) for text in b.column("text")]
        kept = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in kept), pa.array([packed(at) for at, _ in found], pa.binary()),
             pa.array([x.tobytes() for _, x in found], pa.binary())], names=[*kept, "at", "x"])


def _shard_round(shared):
    """One pass of FTRL over the rows of each shard, from the common state; rows come shard by shard."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = shared.value
        shard, first, rows, own = None, None, 0, None

        def states() -> Iterator[pa.RecordBatch]:
            for part in range(len(z) // PART):
                here = slice(part * PART, (part + 1) * PART)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in ((part, pa.int64()), (shard, pa.int64()), (first, pa.int64()), (rows, pa.int64()),
                                                   (own.z[here].tobytes(), pa.binary()), (own.n[here].tobytes(), pa.binary()))],
                    names=["part", "shard", "first", "n_rows", "z", "n"])
        for b in batches:
            for s, h, y, at, x in zip(*(b.column(c) for c in ("shard", "h", "y", "at", "x")), strict=True):
                if s.as_py() != shard:
                    if own is not None:
                        yield from states()
                    shard, first, rows, own = s.as_py(), h.as_py(), 0, Ftrl(z.copy(), n.copy())
                own.learn(unpacked(at.as_buffer()), np.frombuffer(x.as_buffer(), np.float32), y.as_py())
                rows += 1
        if own is not None:
            yield from states()
    return fit


def _averaged(table: pa.Table) -> pa.Table:
    """The mean of the shards' states for one part, each shard counted by its rows."""
    t = table.sort_by([("shard", "ascending"), ("first", "ascending")])
    share = np.array(t["n_rows"].to_pylist(), np.float32)
    share /= share.sum()
    mean = lambda c: sum(s * np.frombuffer(x.as_buffer(), np.float32) for s, x in zip(share, t[c], strict=True))
    return pa.table({"part": [t["part"][0].as_py()], "z": pa.array([mean("z").tobytes()], pa.binary()),
                     "n": pa.array([mean("n").tobytes()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> np.ndarray | None:
    """Weights of the classifier, or None where there is no labelled row. ``usable`` picks the
    rows of ``labels`` that may be learnt from."""
    rows = training_rows(docs, labels, usable, id_col, text_col, label_col)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("at", T.BinaryType()), T.StructField("x", T.BinaryType())])
    rows = rows.mapInArrow(_encode, schema).repartition("shard").sortWithinPartitions("shard", "h", "id")
    rows = stage(rows, "quality-train")
    spark = docs.sparkSession
    state = Ftrl.empty()
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((state.z, state.n))
        states = rows.mapInArrow(_shard_round(shared), "part long, shard long, first long, n_rows long, z binary, n binary")
        got = states.groupBy("part").applyInArrow(_averaged, "part long, z binary, n binary").collect()  # one state
        if not got:
            return None
        got.sort(key=lambda r: r.part)
        state = Ftrl(*(np.concatenate([np.frombuffer(r[c], np.float32) for r in got]) for c in ("z", "n")))
        shared.unpersist()
    return state.weights()


def score(docs: DataFrame, weights: np.ndarray | None, text_col: str = "text",
          score_col: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text."""
    plain = docs.drop(score_col)
    if weights is None:
        return plain.withColumn(score_col, F.lit(1.0))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([*plain.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            out = np.empty(b.num_rows)
            for i, text in enumerate(b.column(text_col)):
                at, x = features(text.as_py() or "")
                out[i] = sigmoid(float(w[at] @ x))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, score_col])
    return plain.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return id_crc32(doc_id) % 4 == 2
