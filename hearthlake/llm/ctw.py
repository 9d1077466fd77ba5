"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions. Each decision has a node for every context: the last
0 to DEPTH bytes before it. A node estimates its bit by Krichevsky and Trofimov's rule from its
counts, and its weighted probability is half its own estimate and half the product of the nodes
one byte deeper, so the tree mixes the estimates of all depths. After training, the chance of a
bit is the mixture, along the path of its contexts, of the estimates weighted by what each depth
has earned.

Texts are read in chunks. A chunk sends each group of contexts one packed row: its distinct
(context, byte) grams in order and how often training texts hold them. Contexts are dealt to groups
of about GROUP_GRAMS distinct grams by their nearest NEAR bytes, so every node at least that deep
lies within one group; the nodes above, whose number depends on the alphabet and not on the number
of documents, are summed once more and shared. A group then answers each chunk's row with the
scores of its grams in the same order, and the chunk adds them up by text. With at most
``SHARED_GRAMS`` distinct grams the chunks read a shared table of all scores instead; both give the
same sums. Rows of a group beyond ASKED_GRAMS are dealt to several tasks, merged in each before they
meet, and answered from copies of the group's scores.

Besides, every text gets the plain unigram score of its words. Counts of at most
``HEAD_WORDS`` of the most frequent words are shared, the others are joined.

Texts are UTF-8 with A-Z lower-cased, preceded by zero bytes and ended by one, which is scored.
Scores of grams have single precision; sums over a text have double.
Defined cases: a null text counts as empty (only its end is scored); rows that repeat are scored
each; with no training text every bit has probability one half; an empty table gives an empty
result; only id and text are read, so other columns cannot clash. A very long text is a chunk of
its own: its grams are taken by SLICES slices of the groups, so that a task needs some 10 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.common import id_crc32, stage

DEPTH = 7  # at most 7: a gram, with its byte, is one long
NEAR = 3
GROUP_GRAMS = 1 << 18
ASKED_GRAMS = 1 << 24  # grams in the rows of one group that one task reads, about 2 bytes each
CHUNK_BYTES = 1 << 25  # texts whose grams are counted and scored together
WINDOW = 1 << 19
SLICES = 16  # a chunk's grams are counted and scored by slices of the groups
HELD_GRAMS = 1 << 21  # grams of rows that wait to be merged
SAMPLE_BITS = 10  # one gram in 2**SAMPLE_BITS, by its hash, tells how many there are
SHARED_GRAMS = 2_000_000  # 12 bytes each
HEAD_WORDS = 1 << 18
FLUSH = 750_000  # distinct words a task holds before it hands them on
HALF = math.log(0.5)
END = b""  # the end token: no word is empty
_MIX = np.uint64(0x9E3779B97F4A7C15)


def raw_text(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


# ---- grams of texts


class Grams:
    """The grams of some texts, window by window. A gram is a number: the nearest context byte
    first, then the farther ones, the byte itself last."""

    def __init__(self, texts: list[bytes], depth: int):
        self.depth, self.texts = depth, len(texts)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1  # with the end
        self.buf = bytes(depth).join([bytes(7 - depth), *texts, b""])  # seven zero bytes first; made at once, held once
        apart = self.sizes + depth - 1  # the zero bytes between texts, but for the end of each, are no grams
        self.starts = np.cumsum(apart) - apart

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(grams, their texts' numbers, where each of these texts starts among the grams)."""
        n = len(self.buf) - 7
        eights = np.ndarray((max(n, 0),), "<u8", self.buf, strides=(1,)) if n else np.zeros(0, np.uint64)
        keep_depth = np.uint64(8 * (8 - self.depth))
        for at in range(0, n, WINDOW):
            to = min(n, at + WINDOW)
            first = int(np.searchsorted(self.starts, at, "right")) - 1
            texts = np.arange(first, int(np.searchsorted(self.starts, to, "left")))
            start = np.maximum(self.starts[texts], at) - at
            end = np.minimum(self.starts[texts] + self.sizes[texts], to) - at
            some = end > start
            texts, start, end = texts[some], start[some], end[some]
            if not len(texts):
                continue
            eight = eights[at:to].copy()
            if len(texts) > 1 or end[0] - start[0] < len(eight):
                edge = np.zeros(len(eight) + 1, np.int8)
                edge[start] += 1
                edge[end] -= 1
                eight = eight[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
            gram = (eight << np.uint64(8) >> keep_depth << np.uint64(8)) | (eight >> np.uint64(56))
            size = end - start
            yield gram, texts, np.cumsum(size) - size


    def slices(self, groups: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each slice of the groups (at most ``most``): its grams in the order of the texts, and how
        many of them each text has."""
        n = len(self.buf) - 7
        eights = np.ndarray((max(n, 0),), "<u8", self.buf, strides=(1,)) if n else np.zeros(0, np.uint64)
        keep_depth, count = np.uint64(8 * (8 - self.depth)), min(most, groups)
        slice_of = np.zeros(n, np.uint8)
        for at in range(0, n, WINDOW) if count > 1 else ():
            near = eights[at:at + WINDOW] << np.uint64(8) >> np.uint64(8 * (8 - min(NEAR, self.depth)))
            slice_of[at:at + WINDOW] = group_of(near, groups) % np.uint64(count)
        for gap in range(self.depth - 1):  # the zero bytes between texts, but for the end of each, are no grams
            slice_of[self.starts + self.sizes + gap] = count
        for part in range(count):
            at = np.concatenate([np.zeros(0, np.int64), *(
                np.flatnonzero(slice_of[i:i + WINDOW] == part) + i for i in range(0, n, WINDOW))])
            eight = eights[at]
            bounds = np.append(np.searchsorted(at, self.starts), len(at))
            del at
            gram = eight << np.uint64(8)
            gram >>= keep_depth
            gram <<= np.uint64(8)
            eight >>= np.uint64(56)
            gram |= eight
            del eight
            yield gram, np.diff(bounds)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of sorted arrays, and their counts added up. Merged range by range, so
    that little is held twice."""
    some = [i for i, k in enumerate(keys) if len(k)]
    if not some:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    keys, counts = [keys[i] for i in some], [counts[i] for i in some]
    if len(keys) == 1:
        return keys[0], counts[0]
    longest = max(keys, key=len)
    bounds = longest[:: 1 << 17][1:]
    cuts = [[0, *np.searchsorted(k, bounds).tolist(), len(k)] for k in keys]
    out = []
    for r in range(len(bounds) + 1):
        key = np.concatenate([k[c[r]:c[r + 1]] for k, c in zip(keys, cuts, strict=True)])
        if len(key):
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.concatenate([n[c[r]:c[r + 1]] for n, c in zip(counts, cuts, strict=True)])
            out.append((key[first], np.add.reduceat(n[order], first)))
    key = np.concatenate([k for k, _ in out])
    out = [n for _, n in out]
    return key, np.concatenate(out)


def counted(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams and how often they occur."""
    gram = np.sort(gram)
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[:len(gram)])
    n = np.diff(np.append(first, len(gram)))
    return gram[first], n.astype(np.int32)  # a chunk has fewer than 2**31 bytes


def group_of(near: np.ndarray, groups: int) -> np.ndarray:
    """The group of contexts, from their nearest bytes."""
    return ((near * _MIX) >> np.uint64(32)) % np.uint64(groups)


def deal(keys: np.ndarray, groups: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of sorted grams by their group, the groups, and where each starts (with the end)."""
    near = keys >> np.uint64(8 * (depth + 1 - min(NEAR, depth)))
    starts = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))  # stretches of one context
    near = near[starts]
    group = group_of(near, groups)
    by_group = np.argsort(group, kind="stable")
    group, size = group[by_group].astype(np.int64), np.diff(np.append(starts, len(keys)))[by_group]
    at = np.cumsum(size) - size
    order = np.repeat((starts[by_group] - at).astype(np.int32), size)
    order += np.arange(len(keys), dtype=np.int32)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    return order, group[first], np.append(at[first], len(keys))


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes: all first bytes, all second ones and so on, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, "zstd"), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


# ---- the tree


_SMALL = 4096
_LGAMMA = {shift: np.array([math.lgamma(k + shift) for k in range(_SMALL)]) for shift in (0.5, 1.0)}


def _lgamma(n: np.ndarray, shift: float) -> np.ndarray:
    """Logarithm of the gamma function at counts plus a shift."""
    out = _LGAMMA[shift][np.minimum(n, _SMALL - 1).astype(np.int64)]
    big = np.flatnonzero(n >= _SMALL)
    out[big] = [math.lgamma(x + shift) for x in n[big].tolist()]
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _lgamma(zeros, 0.5) + _lgamma(ones, 0.5) - _lgamma(zeros + ones, 1.0) - 2 * math.lgamma(0.5)


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes and the weight of their own estimates. ``below``: the sum
    over the nodes one byte deeper, None for the deepest."""
    own = log_kt(zeros, ones)
    if below is None:
        return own, np.ones(len(own))
    log_pw = np.logaddexp(HALF + own, HALF + below)
    return log_pw, np.exp(HALF + own - log_pw)


class TopNodes:
    """Shared nodes of one depth: sorted ids (context * 256 + decision), counts and weights."""

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        self.ids, self.zeros, self.ones = ids.astype(np.uint64), zeros, ones
        self.log_pw, self.weight = weigh(zeros, ones, below)

    def chances(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own estimates of a zero and a one at nodes, and their weight; one half where never seen."""
        if not len(self.ids):
            return tuple(np.full(len(ids), 0.5) for _ in range(3))
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        seen = self.ids[at] == ids
        zeros, ones = np.where(seen, self.zeros[at], 0), np.where(seen, self.ones[at], 0)
        total = zeros + ones + 1.0
        return (zeros + 0.5) / total, (ones + 0.5) / total, np.where(seen, self.weight[at], 0.5)

    def above(self) -> TopNodes:
        """The nodes one byte nearer."""
        ids, at = np.unique((self.ids >> np.uint64(16) << np.uint64(8)) | (self.ids & np.uint64(255)), return_inverse=True)
        return TopNodes(ids, *(np.bincount(at, x, len(ids)) for x in (self.zeros, self.ones, self.log_pw)))


class Contexts:
    """All contexts of one group's grams, of each depth. At a depth the grams are sorted, so the
    nodes of a decision (context and the bits before it) are stretches of them."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int):
        self.depth, self.low = depth, min(NEAR, depth)
        self.keys, self.n, self.up = {depth: grams}, {depth: n.astype(float)}, {}
        for d in range(depth, 0, -1):
            key = self.keys[d]
            self.keys[d - 1], self.up[d] = np.unique((key >> np.uint64(16) << np.uint64(8)) | (key & np.uint64(255)), return_inverse=True)
            self.n[d - 1] = np.bincount(self.up[d], self.n[d], len(self.keys[d - 1]))

    def nodes(self, step: int, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the nodes of a decision start among the grams of a depth, and the node of each gram."""
        node = self.keys[d] >> np.uint64(8 - step)
        new = np.concatenate([[True], node[1:] != node[:-1]])
        return np.flatnonzero(new), np.cumsum(new) - 1

    def counts(self, step: int, d: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the decision was zero, and one, at each node."""
        one = self.n[d] * (self.keys[d] >> np.uint64(7 - step) & np.uint64(1))
        ones = np.add.reduceat(one, starts)
        return np.add.reduceat(self.n[d], starts) - ones, ones

    def ids(self, step: int, d: int, starts: np.ndarray) -> np.ndarray:
        key = self.keys[d][starts]
        decision = np.uint64(1 << step) | ((key & np.uint64(255)) >> np.uint64(8 - step))
        return (key >> np.uint64(8) << np.uint64(8)) | decision

    def weighted(self, step: int) -> tuple[dict, np.ndarray, tuple]:
        """For each depth of the group the counts and weights of its nodes; what the nodes above them
        get from below; and those nodes' stretches."""
        out, nodes, sums = {}, None, None
        for d in range(self.depth, self.low - 2, -1):
            below, nodes_below = sums, nodes
            nodes = self.nodes(step, d)
            if nodes_below is not None:  # each node adds to the one of its first gram's shorter context
                below = np.bincount(nodes[1][self.up[d + 1][nodes_below[0]]], sums, len(nodes[0]))
            if d >= self.low:
                zeros, ones = self.counts(step, d, nodes[0])
                sums, weight = weigh(zeros, ones, below)
                out[d] = nodes, zeros, ones, weight
        return out, below, nodes

    def top_rows(self) -> tuple[np.ndarray, ...]:
        """(ids, zeros, ones, log weighted probability from below) just above the group."""
        rows = []
        for step in range(8):
            _, below, (starts, _) = self.weighted(step)
            rows.append((self.ids(step, self.low - 1, starts), *self.counts(step, self.low - 1, starts), below))
        return tuple(np.concatenate(x) for x in zip(*rows, strict=True))

    def scores(self, top: dict[int, TopNodes]) -> np.ndarray:
        """log10 of the probability of the byte of each gram after its context."""
        total = np.zeros(len(self.keys[self.depth]))
        for step in range(8):
            own, _, _ = self.weighted(step)
            p0 = p1 = left = last = None  # chances so far, and the weight left for deeper nodes
            for d in range(self.depth + 1):
                if d < self.low:
                    nodes = self.nodes(step, d)
                    zero, one, weight = top[d].chances(self.ids(step, d, nodes[0]))
                else:
                    nodes, zeros, ones, weight = own[d]
                    zero = (zeros + 0.5) / (zeros + ones + 1.0)
                    one = (ones + 0.5) / (zeros + ones + 1.0)
                if d == 0:
                    p0, p1, left = weight * zero, weight * one, 1 - weight
                else:
                    parent = last[1][self.up[d][nodes[0]]]
                    left = left[parent]
                    p0, p1 = p0[parent] + left * weight * zero, p1[parent] + left * weight * one
                    left = left * (1 - weight)
                last = nodes
            bit = (self.keys[self.depth] >> np.uint64(7 - step) & np.uint64(1)).astype(bool)
            total += np.log10(np.where(bit, p1[last[1]], p0[last[1]]))
        return total


def top_levels(ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray, depth: int) -> dict[int, TopNodes]:
    """The shared nodes of all depths from those just above the groups."""
    top = min(NEAR, depth) - 1
    levels = {top: TopNodes(ids, zeros, ones, below)}
    for d in range(top - 1, -1, -1):
        levels[d] = levels[d + 1].above()
    return levels


# ---- words


def word_counts(chunks: DataFrame) -> DataFrame:
    """(word, n) over the training texts of chunks, the end token included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                           names=["word", "n"])
            counts.clear()
            return b
        for b in batches:
            for train, sizes, text in zip(*(b.column(c) for c in ("train", "size", "text")), strict=True):
                for side, x in zip(train.as_py(), _texts(sizes.as_py(), text.as_py()), strict=True):
                    if side:
                        counts.update(bytes(x).split())
                        counts[END] += 1
                        if len(counts) > FLUSH:
                            yield out()
        if counts:
            yield out()
    return (chunks.select("train", "size", "text").mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(words: DataFrame, most: int) -> dict[bytes, float]:
    """log10(n + 0.1) of the most frequent words: all with a count above a limit that at most
    ``most`` words exceed. The limit comes from a histogram of the counts' logarithms, so the
    driver gets no more than those words."""
    words = words.withColumn("size", F.floor(16 * F.log2("n")))
    limit, held = None, 0
    for r in words.groupBy("size").agg(F.count("*").alias("k")).orderBy(F.desc("size")).collect():  # at most 1,024 rows
        if held + r.k > most:
            break
        limit, held = r["size"], held + r.k
    if limit is None:
        return {}
    t = words.filter(F.col("size") >= limit).select("word", F.log10(F.col("n") + 0.1).alias("v")).toArrow()
    return dict(zip(t["word"].to_pylist(), t["v"].to_pylist(), strict=True))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 10, is 0."""
    return id_crc32(doc_id) % 10 == 0


def text_scores(raw: list[bytes], depth: int, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values of each text's grams, from sorted keys that hold all of them."""
    total = np.zeros(len(raw))
    for gram, texts, starts in Grams(raw, depth).windows():
        order = np.argsort(gram)
        key = gram[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        value = np.empty(len(gram))
        value[order] = values[np.searchsorted(keys, key[new])][np.cumsum(new) - 1]
        total[texts] += np.add.reduceat(value, starts)
    return total


def slice_scores(gram: np.ndarray, sizes: np.ndarray, values_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over each text of the values of one slice's grams; ``values_of`` gives those of sorted
    distinct grams."""
    if not len(gram):
        return np.zeros(len(sizes))
    order = np.argsort(gram).astype(np.int32)
    gram = gram[order]
    new = np.concatenate([[True], gram[1:] != gram[:-1]])
    gram = gram[new]
    values = values_of(gram)
    del gram
    value = np.empty(len(order), np.float32)
    value[order] = values[np.cumsum(new, dtype=np.int32) - 1]
    return np.bincount(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), value, len(sizes))


def unigrams(texts: pa.Array, known: dict[bytes, float]) -> list[pa.Array]:
    """For each lower-cased text its tokens, those that the head knows, the share of its score that the
    head gives, and the words that the head lacks. Each distinct word is looked up once."""
    cut = pc.ascii_split_whitespace(texts)
    found = cut.flatten().dictionary_encode()
    words = found.dictionary.cast(pa.large_binary())
    value = np.array([math.nan if v is None else v for v in map(known.get, words.to_pylist())], float)
    number, text = found.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    blank = pc.index(words, pa.scalar(b"", pa.large_binary())).as_py()  # beside white space at the ends of a text
    if blank >= 0:
        word = number != blank
        number, text = number[word], text[word]
    count, got, end = np.bincount(text, minlength=len(texts)), value[number], known.get(END)
    lacking = np.isnan(got)
    rare, lacked = np.bincount(text[lacking], minlength=len(texts)), number[lacking]
    part = np.bincount(text, np.where(lacking, 0.0, got), len(texts)) + (end or 0.0)
    n_known = count - rare + (end is not None)
    if end is None:  # one more for each text
        lacked, rare = np.insert(lacked, np.cumsum(rare), len(words)), rare + 1
        words = pa.concat_arrays([words, pa.array([END], pa.large_binary())])
    offsets = np.append(0, np.cumsum(rare)).astype(np.int32)
    missing = pa.ListArray.from_arrays(offsets, words.take(pa.array(lacked)).cast(pa.binary()))
    return [pa.array(count + 1), pa.array(n_known), pa.array(part), missing]


# ---- Spark steps


def _chunked(rows: DataFrame, depth: int) -> DataFrame:
    """One row for each chunk, some CHUNK_BYTES of the texts of ``rows`` that a task reads together:
    its first row number, the rows, ids and sides of its texts, their sizes, their bytes (compressed)
    and a sample of their grams, picked by the grams' hash."""
    fields = ("row", T.LongType()), ("id", rows.schema["id"].dataType), ("train", T.BooleanType()), ("size", T.LongType())
    schema = T.StructType([T.StructField("chunk", T.LongType()), *[T.StructField(f, T.ArrayType(t)) for f, t in fields],
                           T.StructField("text", T.BinaryType()), T.StructField("sample", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kind = [], 0, None

        def out() -> pa.RecordBatch:
            row, ids, train, raw = (list(x) for x in zip(*held, strict=True))
            few = [np.zeros(0, np.uint64)]
            for gram, _, _ in Grams(raw, depth).windows():
                few.append(np.unique(gram[(gram * _MIX) < np.uint64((1 << 64 - SAMPLE_BITS) - 1)]))
            cells = [(pa.int64(), row[0]), (pa.list_(pa.int64()), row), (pa.list_(kind), ids), (pa.list_(pa.bool_()), train),
                     (pa.list_(pa.int64()), [len(x) for x in raw]), (pa.binary(), pa.compress(b"".join(raw), "zstd", asbytes=True)),
                     (pa.list_(pa.int64()), np.unique(np.concatenate(few)).astype(np.int64))]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], t) for t, x in cells], names=schema.names)
        for b in batches:
            kind = b.schema.field("id").type
            columns = (b.column(c).to_pylist() for c in ("row", "id", "train"))
            for *cells, x in zip(*columns, b.column("text"), strict=True):
                raw = raw_text(x.as_py())
                if held and size + len(raw) > CHUNK_BYTES:
                    yield out()
                    size = 0
                held.append((*cells, raw))
                size += len(raw) + 1
        if held:
            yield out()
    return rows.select("row", "id", "train", "text").mapInArrow(run, schema)


def _texts(sizes: list[int], data: bytes) -> list[memoryview]:
    """The texts of a chunk."""
    whole, out, at = memoryview(pa.decompress(data, sum(sizes), "zstd", asbytes=True) if sum(sizes) else b""), [], 0
    for size in sizes:
        out.append(whole[at:at + size])
        at += size
    return out


def _pieces(chunks: DataFrame, groups: int, salts: int, depth: int) -> DataFrame:
    """(near, salt, chunk, size, grams, n): the grams of each chunk, one row for each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, train, sizes, text in zip(*(b.column(c) for c in ("chunk", "train", "size", "text")), strict=True):
                chunk, sides = chunk.as_py(), {True: [], False: []}
                for side, x in zip(train.as_py(), _texts(sizes.as_py(), text.as_py()), strict=True):
                    sides[side].append(x)
                both = [Grams(sides.pop(side), depth).slices(groups, SLICES) for side in (True, False)]
                salt = (chunk * int(_MIX) >> 32) % salts
                for (trained, _), (held, _) in zip(*both, strict=True):
                    own, count = counted(trained)
                    keys = counted(np.concatenate([own, held]))[0]
                    del trained, held
                    if not len(keys):
                        continue
                    n = np.zeros(len(keys), np.int32)  # 0 where only held-out texts have a gram
                    n[np.searchsorted(keys, own)] = count
                    del own, count
                    order, near, cuts = deal(keys, groups, depth)
                    cells = [(g, salt, chunk, stop - start, pack_keys(keys[order[start:stop]]), pack(n[order[start:stop]].astype(np.int64)))
                             for g, start, stop in zip(near.tolist(), cuts.tolist(), cuts[1:].tolist())]
                    del keys, n, order
                    for at in range(0, len(cells), 4096):
                        cols = zip(*cells[at:at + 4096], strict=True)
                        kinds = (pa.int64(),) * 4 + (pa.binary(),) * 2
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                         names=["near", "salt", "chunk", "size", "grams", "n"])
    return chunks.select("chunk", "train", "size", "text").mapInArrow(
        run, "near long, salt long, chunk long, size long, grams binary, n binary")


def _merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of packed rows, with their counts."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for size, grams, n in zip(*(table[c] for c in ("size", "grams", "n")), strict=True):
        keys.append(unpack_keys(grams.as_py(), size.as_py()))
        counts.append(unpack(n.as_py(), size.as_py(), np.int64))
        if sum(map(len, keys)) > max(8 * len(keys[0]), HELD_GRAMS):  # what is held stays near the distinct grams
            key, count = merged(keys, counts)
            keys, counts = [key], [count]
    return merged(keys, counts)


def _groups(pieces: DataFrame) -> DataFrame:
    """One row for each group (and salt): its distinct grams with their counts, and the grams that
    each chunk asks for."""
    def run(table: pa.Table) -> pa.Table:
        key, count = _merge(table)
        one = {"near": pa.int64(), "salt": pa.int64()}
        cells = {c: pa.array([table[c][0].as_py()], t) for c, t in one.items()} | {
            "size": pa.array([len(key)], pa.int64()), "grams": pa.array([pack_keys(key)], pa.binary()), "n": pa.array([pack(count)], pa.binary())}
        asked = {"chunks": ("chunk", pa.int64()), "sizes": ("size", pa.int64()), "asked": ("grams", pa.binary())}
        return pa.table(cells | {name: pa.array([table[c].to_pylist()], pa.list_(t)) for name, (c, t) in asked.items()})
    return pieces.groupBy("near", "salt").applyInArrow(
        run, "near long, salt long, size long, grams binary, n binary, chunks array<long>, sizes array<long>, asked array<binary>")


def _whole(groups: DataFrame) -> DataFrame:
    """Groups whose rows were dealt by salts, as one row each."""
    def run(table: pa.Table) -> pa.Table:
        key, count = _merge(table)
        return pa.table({"near": pa.array([table["near"][0].as_py()], pa.int64()), "size": pa.array([len(key)], pa.int64()),
                         "grams": pa.array([pack_keys(key)], pa.binary()), "n": pa.array([pack(count)], pa.binary())})
    return (groups.select("near", "size", "grams", "n").groupBy("near")
            .applyInArrow(run, "near long, size long, grams binary, n binary"))


def _unpacked(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for size, grams, n in zip(*(rows.column(c) for c in ("size", "grams", "n")), strict=True):
        yield unpack_keys(grams.as_py(), size.as_py()), unpack(n.as_py(), size.as_py(), np.int64)


def _top(groups: DataFrame, depth: int) -> dict[int, TopNodes]:
    """Nodes above those of the groups, from one pass over the groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, counts in _unpacked(b):
                if counts.any():
                    ids, *sums = Contexts(keys[counts > 0], counts[counts > 0], depth).top_rows()
                    yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), *map(pa.array, sums)],
                                                     names=["id", "zeros", "ones", "log_pw"])
    rows = (groups.select("size", "grams", "n").mapInArrow(run, "id long, zeros double, ones double, log_pw double")
            .groupBy("id").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log_pw")])
            .orderBy("id").toArrow())  # for each pair of bytes that text can have, at most 255 rows
    return top_levels(*(rows[c].to_numpy() for c in ("id", "zeros", "ones", "log_pw")), depth)


def _scored(groups: DataFrame, top, depth: int) -> DataFrame:
    """(near, size, grams, scores): the scores of each group's grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [pack(Contexts(keys, counts, depth).scores(top.value).astype(np.float32)) for keys, counts in _unpacked(b)]
            yield pa.RecordBatch.from_arrays([b.column("near"), b.column("size"), b.column("grams"), pa.array(scores, pa.binary())],
                                             names=["near", "size", "grams", "scores"])
    return groups.select("near", "size", "grams", "n").mapInArrow(run, "near long, size long, grams binary, scores binary")


ANSWER = "chunk long, near long, size long, scores binary"


def _answer(near: int, asked: pa.RecordBatch, row: int, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The scores of the grams that chunks ask a group for, in their order."""
    cells = [asked.column(c)[row].values for c in ("chunks", "sizes", "asked")]
    for chunk, size, grams in zip(*cells, strict=True):
        scores = pack(values[np.searchsorted(keys, unpack_keys(grams.as_py(), size.as_py()))])
        yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()], pa.int64()), pa.array([near], pa.int64()),
                                          pa.array([size.as_py()], pa.int64()), pa.array([scores], pa.binary())],
                                         names=["chunk", "near", "size", "scores"])


def _answers(groups: DataFrame, top, depth: int) -> DataFrame:
    """(chunk, near, size, scores) from groups that are whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (keys, counts) in enumerate(_unpacked(b)):
                scores = Contexts(keys, counts, depth).scores(top.value).astype(np.float32)
                yield from _answer(b.column("near")[i].as_py(), b, i, keys, scores)
    return groups.mapInArrow(run, ANSWER)


def _answers_by_salt(groups: DataFrame, scores: DataFrame) -> DataFrame:
    """(chunk, near, size, scores) from groups dealt by salts and the scores of the whole ones."""
    def run(asked: pa.Table, own: pa.Table) -> pa.Table:
        size = own["size"][0].as_py()
        keys, values = unpack_keys(own["grams"][0].as_py(), size), unpack(own["scores"][0].as_py(), size, np.float32)
        asked = asked.combine_chunks().to_batches()[0]
        return pa.Table.from_batches(list(_answer(own["group"][0].as_py(), asked, 0, keys, values)))
    asked = groups.select("near", "salt", "chunks", "sizes", "asked")
    copies = asked.select(F.col("near").alias("group"), F.col("salt").alias("slot")).join(scores.withColumnRenamed("near", "group"), "group")
    return (asked.groupBy("near", "salt").cogroup(copies.groupBy("group", "slot"))
            .applyInArrow(run, ANSWER))


def _scores_by_table(chunks: DataFrame, table, depth: int) -> DataFrame:
    """(row, score) from a shared table (grams, scores)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, sizes, text in zip(*(b.column(c) for c in ("row", "size", "text")), strict=True):
                scores = text_scores(_texts(sizes.as_py(), text.as_py()), depth, *table.value)
                yield pa.RecordBatch.from_arrays([row.values, pa.array(scores)], names=["row", "score"])
    return chunks.select("row", "size", "text").mapInArrow(run, "row long, score double")


def _scores_by_answers(chunks: DataFrame, answers: DataFrame, groups: int, depth: int) -> DataFrame:
    """(row, score) from the answers to each chunk."""
    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        grams = Grams(_texts(own["size"][0].as_py(), own["text"][0].as_py()), depth)
        total, answered = np.zeros(grams.texts), got["near"].to_numpy()
        count = min(SLICES, groups)
        for part, (gram, sizes) in enumerate(grams.slices(groups, SLICES)):
            def values_of(keys: np.ndarray, part: int = part) -> np.ndarray:
                order, near, cuts = deal(keys, groups, depth)
                values = np.empty(len(keys), np.float32)
                for i in np.flatnonzero(answered % count == part).tolist():
                    at = int(np.searchsorted(near, answered[i]))
                    values[order[cuts[at]:cuts[at + 1]]] = unpack(got["scores"][i].as_py(), got["size"][i].as_py(), np.float32)
                return values
            total += slice_scores(gram, sizes, values_of)
        return pa.table({"row": own["row"][0].values, "score": total})
    return (chunks.select("chunk", "row", "size", "text").groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(run, "row long, score double"))


def _unigrams(chunks: DataFrame, head) -> DataFrame:
    """The row, id, size and ``unigrams`` of each text."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", chunks.schema["id"].dataType.elementType),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("part", T.DoubleType()), T.StructField("rare", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, ids, sizes, text in zip(*(b.column(c) for c in ("row", "id", "size", "text")), strict=True):
                size = sizes.values.to_numpy()
                whole = pa.decompress(text.as_py(), int(size.sum()), "zstd") if size.any() else pa.py_buffer(b"")
                bounds = np.concatenate([[0], np.cumsum(size)])
                row, ids = row.values, ids.values
                for at in range(0, len(row), 2048):  # the words of some texts at a time
                    to = min(len(row), at + 2048)
                    some = pa.LargeStringArray.from_buffers(to - at, pa.py_buffer(bounds[at:to + 1]), whole)
                    cells = unigrams(some, head.value)
                    yield pa.RecordBatch.from_arrays([row[at:to], ids[at:to], pa.array(size[at:to]), *cells], names=schema.names)
    return chunks.select("row", "id", "size", "text").mapInArrow(run, schema)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shared_grams: int = SHARED_GRAMS, head_words: int = HEAD_WORDS, depth: int = DEPTH) -> DataFrame:
    """One row for each row of ``docs``: the id, held_out, n_tokens, n_known, train_tokens,
    base_score (unigram), score (log10 probability of the text) and bits_per_byte. ``depth``: bytes
    of the longest context, 1 to 7."""
    if not 1 <= depth <= 7:
        raise ValueError("depth is 1 to 7")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        (~held_out(F.col(id_col))).alias("train"))
    # staged once: row numbers and chunks stay as they are for all readers
    chunks = stage(_chunked(texts.withColumn("row", F.monotonically_increasing_id()), depth), "ctw-chunks")
    distinct = chunks.select(F.explode("sample").alias("gram")).distinct().count() << SAMPLE_BITS
    count = max(1, -(-distinct // GROUP_GRAMS))
    size = chunks.agg(F.sum(F.expr("aggregate(size, 0L, (a, x) -> a + x + 1)"))).first()[0] or 0
    salts = max(1, -(-size // (count * ASKED_GRAMS)))  # no more grams are asked for than there are bytes
    groups = stage(_groups(_pieces(chunks, count, salts, depth)), "ctw-groups")
    whole = groups if salts == 1 else stage(_whole(groups), "ctw-whole")
    top = spark.sparkContext.broadcast(_top(whole, depth))
    if (whole.agg(F.sum("size")).first()[0] or 0) <= shared_grams:
        t = _scored(whole, top, depth).toArrow()
        sizes = t["size"].to_pylist()
        keys = np.concatenate([np.zeros(0, np.uint64), *(unpack_keys(x, k) for x, k in zip(t["grams"].to_pylist(), sizes, strict=True))])
        values = np.concatenate([np.zeros(0, np.float32), *(unpack(x, k, np.float32) for x, k in zip(t["scores"].to_pylist(), sizes, strict=True))])
        order = np.argsort(keys)
        scores = _scores_by_table(chunks, spark.sparkContext.broadcast((keys[order], values[order])), depth)
    else:
        answers = _answers(groups, top, depth) if salts == 1 else _answers_by_salt(groups, _scored(whole, top, depth))
        scores = _scores_by_answers(chunks, answers, count, depth)
    scores = stage(scores, "ctw-scores")  # before the words, so that a task does not hold both
    words = stage(word_counts(chunks), "ctw-words")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    first = stage(_unigrams(chunks, spark.sparkContext.broadcast(frequent_words(words, head_words))), "ctw-rows")
    rare = first.select("row", F.explode("rare").alias("word"))
    c = F.coalesce(F.col("n"), F.lit(0))
    tail = rare.join(words, "word", "left").select(
        "row", F.log10(c + 0.1).alias("part"), F.when(c > 0, 1).otherwise(0).alias("n_known"))
    tail = tail.groupBy("row").agg(F.sum("part").alias("more"), F.sum("n_known").alias("known"))
    base = math.log10(n + 0.1 * (v + 1))
    zero = F.lit(0)
    return first.join(scores, "row").join(tail, "row", "left").select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", zero)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(base)).alias("base_score"), "score",
        (-F.col("score") / (F.col("n_bytes") + 1) / math.log10(2)).alias("bits_per_byte"))
