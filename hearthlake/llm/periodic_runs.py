"""Maximal periodic runs of words (the same few words over and over) in each text.

Texts become numbers, one for each distinct word, and many short texts are sorted at once: numbers
of different texts differ, so no suffix ever matches one of another text. By numpy:

* the suffix array and its inverse (ISA) by prefix doubling; only suffixes that still share a
  group are sorted again, and each round keeps what it changed, so that the ranks of any
  power-of-two length can be brought back;
* the LCP of neighbours by going back through those rounds;
* each LCP interval as its bounds in the array (no tree nodes): at a boundary of depth d it falls
  into two sides, and for each suffix i of the smaller side ISA[i+d] and ISA[i-d] are looked up. If
  one lies in the other side, two suffixes d apart agree in exactly d words: a square that cannot
  be rotated to the right;
* that square is rotated to the left as far as words d apart agree, which gives the whole run. Runs
  of the same stretch are merged into the one of the smallest period.

A text of n words takes O(n log n) time. Short texts are handled in slices of SLICE_WORDS words;
the memory of a task grows with its longest text alone (about 150 bytes a word).

Defined cases: a null text counts as empty; an empty one has no runs and an empty collapsed text;
rows that repeat are judged each for itself; a null id stays null; an empty table gives an empty
result; other columns of the table are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.common import id_crc32

MIN_WORDS = 12  # words of a run at least
SLICE_WORDS = 1 << 17  # words sorted at once, where texts are shorter
CHUNK = 1 << 21  # suffixes looked up at once
SPACES = r"[\x20\x09-\x0D]+"
RESULT = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Suffix array, its inverse and the rounds of doubling: round k holds the suffixes that it
    sorted and their ranks by the first 2**k numbers. Every shared stretch must end before a
    number that occurs once."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    fresh = np.r_[True, codes[order][1:] != codes[order][:-1]]
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, at, 0))
    slots = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
    active, step, rounds = order[slots], 1, []
    while len(slots):
        key = rank[active] << 32 | rank[active + step]
        dealt = np.argsort(key, kind="stable")
        active, key = active[dealt], key[dealt]
        order[slots] = active
        fresh = np.r_[True, key[1:] != key[:-1]]
        rounds.append((active, key >> 32))
        rank[active] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))]
        rest = ~(fresh & np.r_[fresh[1:], True])
        active, slots, step = active[rest], slots[rest], step * 2
    return order, rank, rounds


def coarser(rank: np.ndarray, rounds: list) -> Iterator[tuple[int, np.ndarray]]:
    """(length, ranks by that many numbers), from the longest length to one."""
    rank = rank.copy()
    for k in range(len(rounds) - 1, -1, -1):
        suffixes, before = rounds[k]
        rank[suffixes] = before
        yield 1 << k, rank


def interval_sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each boundary k with lcp[k] > 0: k, and the bounds of the interval's sides [low, k) and
    [k, high), where lcp is above lcp[k] within the left side and at least lcp[k] in the right."""
    where = np.flatnonzero(lcp)
    if not len(where):
        return where, where, where
    depth, place = lcp[where].tolist(), where.tolist()
    low, high = [0] * len(place), [0] * len(place)
    stack: list[int] = []
    last = -2
    for j, (k, d) in enumerate(zip(place, depth, strict=True)):
        if k != last + 1:  # a boundary of depth 0 lies before: all open intervals end there
            for o in stack:
                high[o] = last + 1
            stack = []
            low[j] = k - 1
        else:
            while stack and depth[stack[-1]] > d:
                high[stack.pop()] = k
            low[j] = place[stack[-1]] if stack else start
        if not stack:
            start = low[j]
        stack.append(j)
        last = k
    for o in stack:
        high[o] = last + 1
    return where, np.array(low), np.array(high)


def squares(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, d) whose suffixes i and i+d agree in exactly d numbers."""
    k, low, high = interval_sides(lcp)
    left = k - low <= high - k
    size = np.where(left, k - low, high - k)
    first = np.where(left, low, k)
    other_low, other_high = np.where(left, k, low), np.where(left, high, k)
    ends = np.cumsum(size)
    found_i, found_d = [], []
    cuts = np.searchsorted(ends, np.arange(CHUNK, ends[-1] if len(ends) else 0, CHUNK), "right")
    bounds = np.unique(np.r_[0, cuts, len(k)])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        n = size[a:b]
        node = np.repeat(np.arange(a, b), n)
        within = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)
        i, d = order[first[node] + within], lcp[k[node]]
        for partner, begin in ((i + d, i), (i - d, i - d)):
            p = rank[np.maximum(partner, 0)]
            hit = (p >= other_low[node]) & (p < other_high[node]) & (partner >= 0)
            found_i.append(begin[hit])
            found_d.append(d[hit])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_d)


def runs_of(codes: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period."""
    order, rank, rounds = suffix_order(codes)
    a, b = order[:-1], order[1:]
    shared = np.flatnonzero(codes[a] == codes[b])
    a, b = a[shared], b[shared]
    agree = np.zeros(len(a), np.int64)
    for length, ranks in coarser(rank, rounds):
        agree += length * (ranks[a + agree] == ranks[b + agree])
    lcp = np.zeros(len(codes), np.int64)
    lcp[shared + 1] = agree
    i, d = squares(order, rank, lcp)
    start = i.copy()
    for length, ranks in coarser(rank, rounds):  # rotate left, the longest steps first
        back = start - length
        start -= length * ((back >= 0) & (ranks[np.maximum(back, 0)] == ranks[np.maximum(back, 0) + d]))
    length = i + 2 * d - start
    long = length >= np.maximum(min_words, 2 * d)
    start, length, d = start[long], length[long], d[long]
    by = np.lexsort((d, length, start))
    start, length, d = start[by], length[by], d[by]
    if len(by):  # of equal stretches the smallest period
        one = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])]
        start, length, d = start[one], length[one], d[one]
        by = np.lexsort((d, start))
        start, length, d = start[by], length[by], d[by]
    return start, length, d


def _slice(ids: list, texts: list[list[bytes]], min_words: int) -> pa.RecordBatch:
    sizes = np.array([len(t) + 1 for t in texts], np.int64)  # each text is closed by a number of its own
    begins = np.cumsum(sizes) - sizes
    known: dict[bytes, int] = {}
    numbers = [known.setdefault(w, len(known) + 1) for t in texts for w in (*t, b"")]
    codes = np.array(numbers, np.int64)
    codes[begins + sizes - 1] = 0
    codes += np.repeat(np.arange(len(texts)), sizes) * (len(known) + 1)
    start, length, period = runs_of(codes, min_words)
    doc = np.searchsorted(begins, start, "right") - 1
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    keep = np.cumsum(gone)[:-1] == 0
    collapsed = []
    for n, (words, at) in enumerate(zip(texts, begins.tolist(), strict=True)):
        if not keep[at:at + len(words)].all():
            words = [w for w, k in zip(words, keep[at:at + len(words)].tolist(), strict=True) if k]
        collapsed.append(b" ".join(words))
    rows = pa.StructArray.from_arrays([pa.array(start - begins[doc]), pa.array(length), pa.array(period)],
                                      names=["start", "length", "period"])
    offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), rows),
         pa.array(collapsed, pa.binary()).view(pa.string())], names=["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) of each row: its runs of at least ``min_words`` words and two
    periods, by start, then period; and its words, joined by one space, without those that a run
    contains after its first period. One pass, nothing is shuffled."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                words = (text.as_py() or b"").split()  # bytes split at ASCII white space
                if texts and size + len(words) > SLICE_WORDS:
                    yield _slice(ids, texts, min_words)
                    ids, texts, size = [], [], 0
                ids.append(doc_id.as_py())
                texts.append(words)
                size += len(words) + 1
            if texts:
                yield _slice(ids, texts, min_words)
    return source.mapInArrow(run, RESULT)


def longest_run() -> Column:
    """The run of greatest length (ties: smallest start, then period) of ``runs``; null without runs."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.struct(best["start"].alias("start"), (-best["size"]).alias("length"), best["period"].alias("period"))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A trial's texts: where h, the crc32 of the id, is a multiple of 10, the words from a = g % n
    on (g = h // 10, n words) repeat the first 1 + (n-a) // (3 + g%8) of them to the end."""
    h = id_crc32(F.col(id_col))
    words = F.array_remove(F.split(F.col(text_col), SPACES), "")
    n = F.size(words)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.withColumn(text_col, F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col(text_col)))
