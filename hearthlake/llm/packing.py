"""Best-two-fit packing of tokenised documents into sequences of a fixed capacity.

Documents are encoded once; each task cuts them into pieces of at most ``capacity`` tokens and
numbers its pieces of each length. How documents fit together depends on their lengths alone, and
there are at most ``capacity`` of those, so the packing is planned over the counts of lengths, however
many documents there are:

* a sequence is filled greedily, always with the longest unpacked piece that fits;
* then its smallest piece is put back if two unpacked pieces fill the gap that it leaves more tightly;
* the same filling serves as many sequences as the counts allow, until one of its lengths runs short.

So a plan is a short list of fillings with a number of sequences each. A piece finds its place by its
number among all pieces of its length: the pieces of that length in earlier tasks (a running sum
over one row for each task and length) and its number in its own task. No row is sorted or gathered;
a length that a third of all pieces share is numbered like any other.

Defined cases: a null text counts as empty and holds the end id alone; rows that repeat are packed
each for itself; a null id stays null; an empty table gives an empty result; other columns of the
table are not read, so their names do not matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm.common import stage
from hearthlake.llm.records import word_encoder

CAPACITY = 2048
END_ID = 0
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, tokens binary, task int, number long")
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                  vocabulary: int = 49_408, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut where they are more than
    ``capacity``. ``tokens`` holds little-endian ids of two bytes where the vocabulary allows it, else
    four; ``number`` counts the pieces of a length within a task. To be staged before it is read twice."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    width = 2 if vocabulary <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder = word_encoder(tokenizer_path, width)
        end = encoder.pack([end_id])
        made = [0] * (capacity + 1)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                b = batch.slice(first, 1024)
                rows = []
                for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text"), end), strict=True):
                    for piece, at in enumerate(range(0, len(ids), capacity * width)):
                        part = ids[at:at + capacity * width]
                        size = len(part) // width
                        crc = zlib.crc32(np.frombuffer(part, encoder.kind).astype("<u4").tobytes())
                        rows.append((doc_id, piece, at // width, size, crc, part, task, made[size]))
                        made[size] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else
                    [pa.array([], k) for k in kinds],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "tokens", "task", "number"])
    return source.mapInArrow(run, PIECES)


def best_pair(free: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths a >= b with the greatest sum of at most ``room``, of those that ``free`` counts
    (ties: the greater a); (0, 0) if there are none."""
    lengths = np.arange(len(free))
    fit = np.maximum.accumulate(np.where(free > 0, lengths, 0))
    a = np.flatnonzero(free[:room])
    if not len(a):
        return 0, 0
    b = fit[np.minimum(a, room - a)]
    alone = (b == a) & (free[a] < 2)  # the same piece cannot be taken twice
    b = np.where(alone, fit[a - 1], b)
    total = np.where(b > 0, a + b, 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(a[best]), int(b[best])) if total[best] else (0, 0)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(sequences, lengths in them) for all pieces, given the number of pieces of each length.

    Each step uses up a length, or leaves fewer pieces of it than a filling takes, so the number of
    steps depends on ``capacity``, not on how many pieces there are."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        fit = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))
        filling: Counter[int] = Counter()
        gap, length = capacity, int(fit[capacity])
        while length:
            filling[length] = int(min(gap // length, left[length]))
            gap -= filling[length] * length
            length = int(fit[min(gap, length - 1)])
        need, final = Counter(filling), Counter(filling)
        if gap:
            free = left.copy()
            for length, n in filling.items():
                free[length] -= n
            smallest = min(filling)
            pair = best_pair(free, gap + smallest)
            if sum(pair) > smallest:
                final[smallest] -= 1
                final.update(pair)
                need |= final
        times = min(int(left[length]) // n for length, n in need.items() if n)
        plan.append((times, sorted((+final).elements(), reverse=True)))
        for length, n in final.items():
            left[length] -= times * n
    return plan


def places(plan: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """The plan by length: from which number on pieces of a length go to which sequences and offset.
    One row for each filling and length in it, sorted by length and number."""
    rows, taken, base = [], Counter(), 0
    for times, lengths in plan:
        offset = 0
        for length, n in Counter(lengths).items():
            rows.append((length, taken[length], base, n, offset))
            taken[length] += times * n
            offset += length * n
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": table[:, 0] << 44 | table[:, 1], "first": table[:, 1], "sequence": table[:, 2], "each": table[:, 3],
            "offset": table[:, 4]}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         vocabulary: int = 49_408, id_col: str = "doc_id", text_col: str = "text", tokens: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with
    ``tokens`` also the packed ids, from which ``sequences`` makes whole sequences."""
    pieces = stage(cut_documents(docs, tokenizer_path, capacity, end_id, vocabulary, id_col, text_col), "packing-pieces")
    made = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "packing-counts")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity
    table = docs.sparkSession.sparkContext.broadcast(places(plan_sequences(counts, capacity)))  # bounded by capacity alone
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = made.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    more = ["tokens"] if tokens else []
    numbered = (pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "task", "number", *more)
                .join(before, ["length", "task"])
                .select("doc_id", "piece", "start", "length", "ids_crc32",
                        (F.col("before") + F.col("number")).alias("number"), *more))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for b in batches:
            length, number = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            row = np.searchsorted(t["key"], length << 44 | number, "right") - 1
            nth = number - t["first"][row]
            each = t["each"][row]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(t["sequence"][row] + nth // each), pa.array(t["offset"][row] + nth % each * length),
                 *(b.column(c) for c in more)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *more])
    return numbered.mapInArrow(place, PLACED + (", tokens binary" if tokens else ""))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, doc_ids): each whole sequence of ``pack(..., tokens=True)``, and the documents in it in
    their order. A sequence holds at most ``capacity`` pieces, so no group is large."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "tokens", "doc_id")))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["tokens"]))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", joined.alias("tokens"), F.col("parts.doc_id").alias("doc_ids")))
