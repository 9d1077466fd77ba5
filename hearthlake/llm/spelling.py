"""Groups of spelling variants: words one inserted, deleted or replaced letter apart.

A word is a vector of letter counts. One edit changes the squared distance of two such vectors to 1
(insertion, deletion) or 2 (replacement), and the length by at most one. So words are dealt into
blocks, each block meets itself and its neighbours, and the squared distances of two blocks come
from one matrix product of their counts. Pairs at most two apart are then checked letter by letter.

A block is a length, divided further by how many of its letters fall into each of CLASSES classes:
an edit moves one letter into, out of or between classes, so the blocks that can hold a partner are
known (7 classes or lengths for an insertion, and so on) and no pair is lost. Blocks above
TILE_WORDS words or TILE_LETTERS letters are split into tiles, which meet tile by tile: each tile
pair is a row, dealt over the tasks, so a length that holds a third of all words is spread. The number of
products grows with the square of the words of a block; corpus vocabularies grow far slower than
corpora, and the classes divide them by a constant (25 on the words of the 0.1 GB test table).

Defined cases: a null text has no words; letters outside A-Z, a-z and U+00C0 to U+00FF end a word;
rows that repeat count each time; a null id counts as empty where letters are dropped; an empty table
gives an empty result; other columns of the table are not read, so their names do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.common import LOWER, UPPER, stage

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2  # a form is at least so many times as frequent
CLASSES = 6
TILE_WORDS = 2048
TILE_LETTERS = 1 << 22
FLUSH_WORDS = 400_000  # distinct words that a task holds before it hands them on
LONG_TEXT = 1 << 20  # letters of a long text taken at once
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))
_RUN = re.compile(rb"[a-z\xc0-\xff]+")
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_NUMBER = np.zeros(256, np.int64)
_NUMBER[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def letter_runs(text: bytes) -> Iterator[list[bytes]]:
    """The letter runs of a Latin-1 text in lower case, some at a time."""
    if len(text) <= LONG_TEXT:
        yield _RUN.findall(text)
        return
    some, size = [], 0
    for m in _RUN.finditer(text):
        some.append(m.group())
        size += len(some[-1])
        if size > LONG_TEXT:
            yield some
            some, size = [], 0
    yield some


def count_words(docs: DataFrame, drop_letter_of: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n): how often each lower-cased letter run occurs in whole texts.

    For trials, ``drop_letter_of`` plants misspellings: where it divides h, the crc32 of
    ``<id>:<run>``, the run loses its letter number h % length."""
    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        crc32, every = zlib.crc32, drop_letter_of

        def rows() -> pa.RecordBatch:
            words = pa.array(list(total), pa.binary())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                latin = (text.as_py() or "").encode("latin-1", "replace").translate(_LOWERED)  # "?" is no letter
                base = crc32(f"{doc_id or ''}:".encode())
                for runs in letter_runs(latin):
                    total.update(runs)
                    if not every:
                        continue
                    hit = {r: h for r in set(runs) if not (
                        h := crc32(r if r.isascii() else r.decode("latin-1").encode(), base)) % every}
                    for r in runs if hit else ():
                        if r in hit:
                            at = hit[r] % len(r)
                            total[r] -= 1
                            total[r[:at] + r[at + 1:]] += 1
                if len(total) > FLUSH_WORDS:
                    yield rows()
                    total.clear()
        yield rows()
    counted = source.mapInArrow(run, "word binary, n long")
    return (counted.groupBy(F.decode("word", "ISO-8859-1").alias("word")).agg(F.sum("n").alias("n"))
            .filter("n > 0 and word <> ''"))


def _steps() -> list[list[int]]:
    """Changes of the class counts from a block to those it meets: none, one letter more, and one
    letter of another class (one of the two directions)."""
    one = [[int(i == j) for i in range(CLASSES)] for j in range(CLASSES)]
    swaps = [[x - y for x, y in zip(one[a], one[b], strict=True)] for a in range(CLASSES) for b in range(a)]
    return [[0] * CLASSES, *one, *swaps]


def _matrix(words: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters, letter counts and squared norms of words of one length, written without a gap."""
    letters = np.frombuffer(words, np.uint8).reshape(-1, length)
    n = len(ALPHABET)
    at = _NUMBER[letters] + np.arange(len(letters))[:, None] * n
    # sums of two norms must be exact
    counts = np.bincount(at.ravel(), minlength=len(letters) * n).reshape(-1, n).astype(
        np.float32 if length < 2000 else np.float64)
    return letters, counts, np.einsum("ij,ij->i", counts, counts)


def near_in_tiles(a: bytes, a_length: int, b: bytes, b_length: int, same: bool) -> tuple[np.ndarray, ...]:
    """(letters of a's tile, of b's, i, j): all pairs one edit apart. ``b_length`` is ``a_length`` or one more;
    ``same``: the tile meets itself, each pair once."""
    x, cx, nx = _matrix(a, a_length)
    y, cy, ny = (x, cx, nx) if same else _matrix(b, b_length)
    distance = nx[:, None] + ny[None, :] - 2 * (cx @ cy.T)
    i, j = np.nonzero(distance <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    near = np.empty(len(i), bool)
    step = max(1, (1 << 22) // b_length)
    for at in range(0, len(i), step):
        p, q = x[i[at:at + step]], y[j[at:at + step]]
        if a_length == b_length:
            near[at:at + step] = (p != q).sum(1) == 1
        else:  # letters before the inserted one agree, and those after it
            head = np.logical_and.accumulate(p == q[:, :-1], axis=1).sum(1)
            tail = np.logical_and.accumulate((p == q[:, 1:])[:, ::-1], axis=1).sum(1)
            near[at:at + step] = head + tail >= a_length
    return x, y, i[near], j[near]


def _words(letters: np.ndarray) -> pa.Array:
    offsets = np.arange(len(letters) + 1, dtype=np.int64) * letters.shape[1]
    return pa.Array.from_buffers(pa.large_binary(), len(letters), [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(letters))]).cast(pa.binary())


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair of words that are one edit apart, once. ``words`` is a staged table of
    distinct ``word`` (of ALPHABET's letters, not empty) and ``n``."""
    spark = words.sparkSession
    parts = [ALPHABET[c::CLASSES] for c in range(CLASSES)]
    keyed = words.select("word", "n", F.length("word").alias("length"), F.array(
        *[F.length("word") - F.length(F.translate("word", p, "")) for p in parts]).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("words"), F.first("length").alias("length"))
    tiles = F.ceil(F.greatest(F.col("words") / TILE_WORDS, F.col("words") * F.col("length") / TILE_LETTERS))
    dealt = (keyed.join(sizes.select("key", tiles.alias("tiles")), "key")
             .withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles"))))
    listed = F.sort_array(F.collect_list(F.struct("word", "n")))
    tile = stage(
        dealt.groupBy("key", "tile", "length").agg(listed.alias("list"))
        .select("key", "tile", "length", F.encode(F.array_join("list.word", ""), "ISO-8859-1").alias("letters"),
                F.col("list.n").alias("ns")), "spelling-tiles")
    steps = F.explode(F.array(*[F.array(*[F.col("key")[c] + s[c] for c in range(CLASSES)]) for s in _steps()]))
    ids = tile.select(F.col("key").alias("a_key"), F.col("tile").alias("a_tile"), steps.alias("b_key"))
    pairs = ids.join(tile.select(F.col("key").alias("b_key"), F.col("tile").alias("b_tile")), "b_key").filter(
        "a_key <> b_key or a_tile <= b_tile")

    def side(s: str) -> DataFrame:
        return tile.select(F.col("key").alias(f"{s}_key"), F.col("tile").alias(f"{s}_tile"),
                           F.col("length").alias(f"{s}_length"), F.col("letters").alias(f"{s}_letters"),
                           F.col("ns").alias(f"{s}_ns"))
    met = (pairs.join(side("a"), ["a_key", "a_tile"]).join(side("b"), ["b_key", "b_tile"])
           .withColumn("same", F.expr("a_key = b_key and a_tile = b_tile"))
           .select("same", *[f"{s}_{c}" for s in "ab" for c in ("length", "letters", "ns")],
                   F.xxhash64("a_key", "a_tile", "b_key", "b_tile").alias("pair")))
    parts_n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (row for at in range(0, batch.num_rows, 64) for row in batch.slice(at, 64).to_pylist()):
                x, y, i, j = near_in_tiles(r["a_letters"], r["a_length"], r["b_letters"], r["b_length"], r["same"])
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [_words(x[i]), pa.array(np.array(r["a_ns"], np.int64)[i]), _words(y[j]),
                         pa.array(np.array(r["b_ns"], np.int64)[j])], names=["word", "n", "other", "other_n"])
    # products take longer than their rows are large: dealt anew into a fixed number of parts
    found = met.repartition(parts_n, "pair").drop("pair").mapInArrow(run, "word binary, n long, other binary, other_n long")
    text = lambda c: F.decode(c, "ISO-8859-1").alias(c)
    return found.select(text("word"), "n", text("other"), "other_n")


def follow_forms(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(word, root) for a staged table (word, form): the end of the chain from each word. Chains double the
    count with each link, so they are short; every round halves them by a join on the form (a hot form is a hot
    key of the larger side, which adaptive execution splits)."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(max_rounds):
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(at.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at
    raise RuntimeError("chains of forms did not end")


def group_variants(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                   ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word with at least ``min_letters`` letters and ``min_count``
    occurrences in ``words`` (word, n; see ``count_words``). ``form`` is the most frequent near word (ties: the
    smallest) if it is ``ratio`` times as frequent; ``root`` is where the forms lead, the word itself if it has none."""
    kept = stage(words.filter((F.length("word") >= min_letters) & (F.col("n") >= min_count)).select("word", "n"),
                 "spelling-words")
    near = near_words(kept)
    both = near.union(near.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                                  F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    judged = stage(kept.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.form")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = follow_forms(judged.filter("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
