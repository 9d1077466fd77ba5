"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of at most PASSAGE words. Passages and windows of documents
are TF-IDF vectors over the terms of the benchmark, with document frequencies counted over all
documents. A randomised singular value decomposition, whose products are summed over Spark tasks,
gives a latent space in which near wordings meet. Every window of every document is projected
into it; where its cosine with a passage reaches COSINE, the longest common subsequence of words
decides: a document is contaminated if it holds at least STRONG of a passage's words in order, or
at least WEAK of them together with the passage's answer (its last words).

The decomposition is fitted on all passages and all windows of all documents, and all windows are
searched. The benchmark is the stated query set and is taken in blocks of at most BLOCK_PASSAGES
passages and BLOCK_TERMS terms, so what is shared with the tasks has a fixed bound and nothing is
paired document with document. For each block the texts are read once: the places of its terms are
written as numbers, and counting, fitting and searching read those.

Defined cases: a null or empty document has no match; a null or wordless item matches nothing;
items that repeat match alike; rows that repeat are judged each; an empty benchmark or an empty
table gives no matches; extra columns are passed on, except that the match column replaces a
column of its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hearthlake.llm.common import stage

PASSAGE = 64  # words of a passage; longer items give several, half overlapping
STEP, SPAN = 12, 3  # words of a step, steps of a window; a window begins at every step
COMMON, LEAST_TERMS = 0.2, 4  # terms in more documents only count where a passage has few others
RANK, EXTRA, POWER = 96, 16, 2
FIT_WINDOWS, SEARCH_WINDOWS, SEARCH_DOCS = 128, 1024, 64  # windows and documents taken at once
PART_TERMS = 256  # terms of a part of a sum
BLOCK_PASSAGES, BLOCK_TERMS = 2_048, 40_000
COSINE = 0.5
STRONG, WEAK, ANSWER_WORDS, ANSWER_SHARE = 0.7, 0.6, 5, 0.8
FEW_WORDS, FEW_SHARE = 8, 1.0  # shorter passages must be there whole

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def lcs(masks: dict[str, int], size: int, words: list[str]) -> int:
    """Length of the longest common subsequence of ``words`` and a passage given as the positions
    of each of its words, one bit each."""
    row = full = (1 << size) - 1
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


def masks_of(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def least_found(size: int, share: float) -> int:
    """Fewest positions of a passage that are this share of it."""
    return next(k for k in range(size + 1) if k / size >= share)


@dataclass
class Block:
    """Passages of a block of items, their terms, and (once fitted) the latent space."""
    item_ids: list
    passages: list[list[str]]
    terms: dict[str, int]
    space: np.ndarray | None = None  # terms by rank, each row scaled by the term's idf
    vectors: np.ndarray | None = None  # rank by passages, unit columns
    used: np.ndarray | None = None  # which terms have a place in the space; one more, never used, for other words

    def __post_init__(self):
        self.words = list(self.terms)
        self.masks = [masks_of(p) for p in self.passages]
        # positions of a passage that must be found, and those that do without its answer
        self.least = [least_found(len(p), FEW_SHARE if len(p) < FEW_WORDS else WEAK) for p in self.passages]
        self.enough = [least_found(len(p), STRONG) for p in self.passages]
        self.answers = [(masks_of(p[-ANSWER_WORDS:]), len(p[-ANSWER_WORDS:])) for p in self.passages]
        # how often each word stands in a passage and in its answer, by the word and by its number
        self.counts = [tuple({w: x.bit_count() for w, x in m.items()} for m in (mask, answer))
                       for mask, (answer, _) in zip(self.masks, self.answers, strict=True)]
        self.numbered = [tuple({self.terms.get(w): n for w, n in c.items()} for c in both) for both in self.counts]

    def term_ids(self, words: list[str]) -> np.ndarray:
        get = self.terms.get
        return np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))

    def matches(self, texts: list[np.ndarray]) -> list[list[tuple[int, float, float, int]]]:
        """For each document (the numbers of its words, -1 for those that are no terms) the passages
        it holds, as (passage, cosine, share of its words in order, first word) of the best window."""
        steps = np.array([-(-len(w) // STEP) for w in texts], np.int64)
        rows = steps + SPAN - 1  # empty steps after each document, so that no window reaches into the next
        ends = np.cumsum(rows)
        starts = ends - rows
        found: list[dict[int, tuple[int, float, float, int]]] = [{} for _ in texts]
        ids = np.concatenate([np.zeros(0, np.int32), *texts])
        known = np.flatnonzero(self.used[ids])  # the last place, of those that are no terms, is never used
        if not len(known):
            return [[] for _ in texts]
        place = np.concatenate([np.arange(len(w)) // STEP + a for w, a in zip(texts, starts, strict=True)])
        at = place[known]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        sums = np.zeros((ends[-1] + SPAN - 1, self.space.shape[1]), np.float32)
        term, size = ids[known], np.diff(np.r_[first, len(known)])
        for k in range(size.max()):  # the k-th term of each step; a step has few
            some = first[size > k]
            sums[at[some]] += self.space[term[some + k]]
        doc = np.repeat(np.arange(len(texts)), rows)
        window = sums[:ends[-1]].copy()
        for k in range(1, SPAN):  # the steps that follow
            window += sums[k:ends[-1] + k]
        norm = np.sqrt(np.einsum("ij,ij->i", window, window))
        full = np.flatnonzero((norm > 1e-6) & (np.arange(ends[-1]) < (starts + steps)[doc]))
        tried: set[tuple[int, int, int]] = set()
        around, here = None, set()
        sizes = np.array([len(p) for p in self.passages])
        for a in range(0, len(full), SEARCH_WINDOWS):
            some = full[a:a + SEARCH_WINDOWS]
            near = (window[some] / norm[some, None]) @ self.vectors
            i, p = np.nonzero(near >= COSINE)
            d = doc[some[i]]
            begin = (some[i] - starts[d]) * STEP
            part = begin // np.maximum(STEP, sizes[p])  # windows nearly the same are looked at once
            once = np.unique((d * len(sizes) + p) * (int(steps.max()) + 1) + part, return_index=True)[1]
            once.sort()
            for at, p, d, begin, part in zip(*(x[once].tolist() for x in (i, p, d, begin, part)), strict=True):
                if (d, p, part) in tried:
                    continue
                if (d, begin) != around:
                    around = (d, begin)
                    here = set(texts[d][max(0, begin - PASSAGE):begin + SPAN * STEP + PASSAGE].tolist())
                if not self.possible(p, here, self.numbered):
                    continue
                tried.add((d, p, part))
                # the passage may begin before the window or go on after it
                size = len(self.passages[p])
                start, stop = max(0, begin - size), begin + SPAN * STEP + size
                share = self.verdict(p, self.known(texts[d][start:stop]))
                if share and (p not in found[d] or found[d][p][2] < share):
                    found[d][p] = (p, float(near[at, p]), share, start)
        return [list(f.values()) for f in found]

    def known(self, ids: np.ndarray) -> list[str]:
        """The terms at these places, in order; a passage has no other words."""
        return [self.words[i] for i in ids[ids >= 0].tolist()]

    def possible(self, p: int, here: set, counts: list[tuple[dict, dict]]) -> bool:
        """Whether the passage can be found among these words (or numbers of words, as ``counts`` has them): a
        position whose word is not there at all is never found. Loses nothing that the verdict would find."""
        count, answer = counts[p]
        n = sum(map(count.__getitem__, count.keys() & here))
        if n < self.least[p] or n >= self.enough[p]:
            return n >= self.least[p]
        return sum(map(answer.__getitem__, answer.keys() & here)) >= ANSWER_SHARE * self.answers[p][1]

    def verdict(self, p: int, words: list[str]) -> float:
        """Share of the passage's words found in order, 0 where that is no contamination."""
        masks, size = self.masks[p], len(self.passages[p])
        held = [w for w in words if w in masks]
        if not self.possible(p, set(held), self.counts):
            return 0.0
        need = FEW_SHARE if size < FEW_WORDS else WEAK
        share = lcs(masks, size, held) / size
        if share < need:
            return 0.0
        if share < STRONG:
            answer, n = self.answers[p]
            if lcs(answer, n, held) < ANSWER_SHARE * n:
                return 0.0
        return share


def blocks(items: Iterator[tuple[object, str | None]]) -> Iterator[Block]:
    """Passages of the items in blocks of bounded size."""
    ids, passages, terms = [], [], {}
    for item_id, text in items:
        words = words_of(text)
        for at in range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2):
            piece = words[at:at + PASSAGE]
            if not piece:
                continue
            if len(passages) >= BLOCK_PASSAGES or len(terms) + len(piece) > BLOCK_TERMS:
                yield Block(ids, passages, terms)
                ids, passages, terms = [], [], {}
            ids.append(item_id)
            passages.append(piece)
            for w in piece:
                terms.setdefault(w, len(terms))
    if passages:
        yield Block(ids, passages, terms)


def term_places(texts: DataFrame, block: Block) -> DataFrame:
    """(id, hash, ids): for each row of ``texts`` the numbers of its words as 32-bit integers, -1 for
    words that are no terms of the block. The only step that reads the texts."""
    shared = texts.sparkSession.sparkContext.broadcast(block.terms)
    kept = texts.select("id", F.xxhash64("text").alias("hash"), "text")
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for b in batches:
            ids = []
            for text in b.column("text"):
                words = words_of(text.as_py())
                ids.append(np.fromiter(map(get, words, repeat(-1)), np.int32, len(words)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("hash"), pa.array(ids, pa.binary())],
                                             names=["id", "hash", "ids"])
    return stage(kept.mapInArrow(run, schema), "decontaminate-places")


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.int32) for x in column]


def document_frequencies(places: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """In how many documents each term of the block occurs, and the documents."""
    size = len(block.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(size, np.int64), 0
        here = np.zeros(size + 1, bool)  # the last place: words that are no terms
        for b in batches:
            for ids in _ids(b.column("ids")):
                here[ids] = True
                here[size] = False
                at = np.flatnonzero(here)
                counts[at] += 1
                here[at] = False
            rows += b.num_rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[counts[at], rows])], names=["term", "n"])
    out, n = np.zeros(size, np.int64), 0
    found = places.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in found.collect():  # one row a term
        if r.term < 0:
            n = r.n
        else:
            out[r.term] = r.n
    return out, n


def _tf_idf(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique(ids[ids >= 0], return_counts=True)
    x = n * idf[at]
    return at, x / max(1e-9, float(np.sqrt((x * x).sum())))


def fit(block: Block, places: DataFrame) -> Block:
    """The latent space of a block: TF-IDF weights and a randomised singular value decomposition of the
    passages and all windows of all documents. Each product with the matrix is a sum of (terms by
    RANK + EXTRA) tables that the tasks make and Spark adds up."""
    df, n = document_frequencies(places, block)
    idf = np.log((n + 1) / (df + 1)) + 0.05
    rare = df <= COMMON * n
    kept = rare.copy()
    for p in block.passages:
        at = np.unique(block.term_ids(p))
        if rare[at].sum() < LEAST_TERMS:
            kept[at] = True
    idf *= kept
    spark = places.sparkSession
    width = min(RANK + EXTRA, len(idf))
    own = np.zeros((len(block.passages), len(idf)))
    for i, p in enumerate(block.passages):
        at, x = _tf_idf(block.term_ids(p), idf)
        own[i, at] = x
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((len(idf), width)))[0]
    for _ in range(POWER):
        shared = spark.sparkContext.broadcast((idf, basis.astype(np.float32)))
        total, windows = np.zeros(basis.shape), 0
        parts = places.select("ids").mapInArrow(_products(shared), "part long, task long, windows long, sums binary")
        for r in parts.groupBy("part").applyInArrow(_added, "part long, windows long, sums binary").collect():  # one table
            sums = np.frombuffer(r.sums, np.float64).reshape(-1, width)
            total[r.part * PART_TERMS:r.part * PART_TERMS + len(sums)] = sums
            windows = r.windows
        weight = max(1.0, windows / len(own))  # passages count as much as the windows together
        basis = np.linalg.qr(total + weight * own.T @ (own @ basis))[0]
    # the leading directions within the basis, by the passages' own spread
    _, _, turn = np.linalg.svd(own @ basis, full_matrices=False)
    space = (basis @ turn[:RANK].T).astype(np.float32)
    vectors = own.astype(np.float32) @ space
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(1)), 1e-9)[:, None]
    block.space = (space * idf[:, None]).astype(np.float32)
    block.used = np.r_[idf > 0, False]
    block.vectors = np.ascontiguousarray(vectors.T)
    return block


def _windows(texts: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of some documents that hold terms, as a sparse matrix of unit TF-IDF vectors:
    (rows, terms, values), ordered by row."""
    rows = [-(-len(x) // (STEP * SPAN)) for x in texts]
    before = np.r_[0, np.cumsum(rows)]
    ids = np.concatenate([np.zeros(0, np.int32), *texts])
    known = np.flatnonzero(np.r_[idf > 0, False][ids])
    place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) // (STEP * SPAN) + a for x, a in zip(texts, before[:-1], strict=True))])
    entry, n = np.unique(place[known] * len(idf) + ids[known], return_counts=True)
    row, term = np.divmod(entry, len(idf))
    row = np.unique(row, return_inverse=True)[1]
    x = n * idf[term]
    return row, term, (x / np.sqrt(np.bincount(row, x * x))[row]).astype(np.float32)


def _products(shared):
    """Sums of A'(A B) over the windows of a task, for the shared basis B, in parts of PART_TERMS terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = shared.value
        out, windows = np.zeros(basis.shape), 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                row, term, x = _windows(_ids(b.column("ids").slice(at, 256)), idf)
                if not len(row):
                    continue
                windows += int(row[-1]) + 1
                # some windows at a time, as a matrix of the terms that they hold
                for here in np.split(np.arange(len(row)), np.searchsorted(row, range(FIT_WINDOWS, row[-1] + 1, FIT_WINDOWS))):
                    held, column = np.unique(term[here], return_inverse=True)
                    matrix = np.zeros((FIT_WINDOWS, len(held)), np.float32)
                    matrix[row[here] % FIT_WINDOWS, column] = x[here]
                    out[held] += matrix.T @ (matrix @ basis[held])
        task = TaskContext.get().partitionId()
        for part in range(-(-len(out) // PART_TERMS)):
            sums = out[part * PART_TERMS:(part + 1) * PART_TERMS].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([task]), pa.array([windows]), pa.array([sums], pa.binary())],
                                             names=["part", "task", "windows", "sums"])
    return run


def _added(table: pa.Table) -> pa.Table:
    """The tables of all tasks for one part, added in the order of the tasks."""
    table = table.sort_by("task")
    total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table["sums"])
    return pa.table({"part": [table["part"][0].as_py()], "windows": [sum(table["windows"].to_pylist())],
                     "sums": pa.array([total.tobytes()], pa.binary())})


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", matches_col: str = "leaks") -> DataFrame:
    """``docs`` with an array of (item_id, cosine, share, first_word), one for each benchmark item
    that the whole text holds, best first."""
    out = docs.drop(matches_col)
    item_type = benchmark.schema[item_col].dataType
    kind = T.ArrayType(T.StructType([T.StructField("item_id", item_type), T.StructField("cosine", T.DoubleType()),
                                     T.StructField("share", T.DoubleType()), T.StructField("first_word", T.LongType())]))
    out = out.withColumn(matches_col, F.array().cast(kind))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text")).orderBy("id", "text")
    found = None
    for i, block in enumerate(blocks((r.id, r.text) for r in items.toLocalIterator())):  # one partition at a time
        places = term_places(texts, block)
        shared = docs.sparkSession.sparkContext.broadcast(fit(block, places))
        schema = T.StructType([*places.schema.fields[:2], T.StructField("block", T.IntegerType()), T.StructField("hits", kind)])
        hits = stage(places.mapInArrow(_search(shared, i, schema), schema), "decontaminate-hits")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return out
    # rows that agree in id and text have the same hits
    found = found.dropDuplicates(["id", "hash", "block"]).groupBy(F.col("id").alias("__id"), F.col("hash").alias("__hash")).agg(
        F.sort_array(F.collect_list(F.struct("block", "hits"))).alias("__hits"))
    schema = T.StructType([*found.schema.fields[:2], T.StructField("__found", kind)])
    found = stage(found.mapInArrow(_merge(schema), schema), "decontaminate-found")
    out = out.withColumn("__h", F.xxhash64(F.col(text_col).cast("string")))
    out = out.join(found, out[id_col].eqNullSafe(found["__id"]) & (out["__h"] == found["__hash"]), "left")
    return out.withColumn(matches_col, F.coalesce("__found", matches_col)).drop("__h", "__id", "__hash", "__found")


def _search(shared, number: int, schema: T.StructType):
    """The documents that hold passages of the block, with their hits in the order of the windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, names = shared.value, schema.names
        kind = to_arrow_type(schema["hits"].dataType)
        for b in batches:
            for at in range(0, b.num_rows, SEARCH_DOCS):
                part = b.slice(at, SEARCH_DOCS)
                found = block.matches(_ids(part.column("ids")))
                rows = [i for i, hits in enumerate(found) if hits]
                if not rows:
                    continue
                hits = [[{"item_id": block.item_ids[p], "cosine": cosine, "share": share, "first_word": first}
                         for p, cosine, share, first in found[i]] for i in rows]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(rows)), part.column("hash").take(pa.array(rows)),
                                                  pa.array([number] * len(rows), pa.int32()), pa.array(hits, kind)], names=names)
    return run


def _merge(schema: T.StructType):
    """The best hit of each item over all blocks (the first of equals), best first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_type(schema["__found"].dataType)
        for b in batches:
            rows = []
            for blocks_hits in b.column("__hits").to_pylist():
                best: dict = {}
                for x in (x for hits in blocks_hits for x in hits["hits"]):
                    if x["item_id"] not in best or best[x["item_id"]]["share"] < x["share"]:
                        best[x["item_id"]] = x
                rows.append(sorted(best.values(), key=lambda x: (-x["share"], x["first_word"], str(x["item_id"]))))
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__hash"), pa.array(rows, kind)], names=schema.names)
    return run
