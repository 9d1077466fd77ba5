"""Periodic runs, packing and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import ROWS, documents, empty, lowered
from hearthlake.llm import packing, periodic_runs, queries, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- periodic runs -------------------------------------------------------

def plain_runs(words, min_words=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_words, 2 * q):
                out.setdefault((i, j + q - i), q)  # periods rise: the smallest is met first
            i = j
    return sorted((s, length, q) for (s, length), q in out.items())


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def plain_periodic(doc_id, text):
    words = planted(doc_id, text)
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repetitive(rng):
    words = []
    while len(words) < rng.choice([5, 20, 60, 150]):
        block = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        words += block * rng.randint(1, 6)
    return " ".join(words[:rng.randint(0, len(words))])


def test_runs_of_numbers_equal_plain_search():
    rng = random.Random(5)
    for _ in range(400):
        words = repetitive(rng).split()
        codes = np.array([1 + "abc".index(w) for w in words] + [0], np.int64)
        for least in (2, 12):
            got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(codes, least)), strict=True))
            assert got == plain_runs(words, least), words


def test_lookups_in_chunks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 7)
    words = ("a b a b a c " * 30).split()
    codes = np.array([ord(w) for w in words] + [0], np.int64)
    got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(codes, 12)), strict=True))
    assert got == plain_runs(words)


def write(spark, tmp_path, df, name="documents"):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_periodic_query_equals_plain_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", 500)  # several slices, texts that fill one alone
    rng = random.Random(3)
    rows = ROWS + [(100 + i, repetitive(rng)) for i in range(150)] + [(7, "x\x0by\x1cz w " * 9), (300, "a " * 700)]
    got = queries.op11_periodic_runs(spark, write(spark, tmp_path, documents(spark, rows)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = str
    assert sorted(map(tuple, got.collect()), key=key) == sorted((plain_periodic(i, t) for i, t in rows), key=key)
    assert sum(r["n_runs"] > 0 for r in got.collect()) > 50
    assert periodic_runs.find_runs(empty(spark)).count() == 0


def test_one_long_text_of_one_word():
    codes = np.array([1] * 200_000 + [0], np.int64)
    assert [x.tolist() for x in periodic_runs.runs_of(codes)] == [[0], [200_000], [1]]


# --- packing -------------------------------------------------------------

def plain_fillings(lengths, capacity):
    """Best-two-fit, one sequence after another."""
    left, out = Counter(lengths), []
    while +left:
        bin_, gap = [], capacity
        for x in sorted(left, reverse=True):
            while left[x] and x <= gap:
                bin_.append(x)
                left[x] -= 1
                gap -= x
        if gap:
            room, best = gap + min(bin_), (0, 0, 0)
            free = sorted(x for x in left if left[x])
            for a in free:
                for b in free:
                    if b <= a and a + b <= room and (a != b or left[a] > 1):
                        best = max(best, (a + b, a, b))
            if best[0] > min(bin_):
                left[min(bin_)] += 1
                bin_.remove(min(bin_))
                for x in best[1:]:
                    bin_.append(x)
                    left[x] -= 1
        out.append(tuple(sorted(bin_, reverse=True)))
    return Counter(out)


def test_plan_equals_one_sequence_after_another():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([10, 30, 64])
        lengths = [rng.randint(1, capacity) if rng.random() < .7 else rng.randint(1, 4) for _ in range(rng.randint(0, 120))]
        plan = packing.plan_sequences(Counter(lengths), capacity)
        got = Counter()
        for times, filling in plan:
            got[tuple(filling)] += times
        assert got == plain_fillings(lengths, capacity)


def test_plan_is_short_whatever_the_counts():
    rng = random.Random(2)
    counts = {length: rng.randint(1, 10**9) for length in range(1, 2049)}
    plan = packing.plan_sequences(counts)
    assert len(plan) < 4 * 2048
    total = sum(times * sum(filling) for times, filling in plan)
    assert total == sum(length * n for length, n in counts.items())
    bound = max(-(-total // 2048), sum(n for length, n in counts.items() if length > 1024))
    assert sum(times for times, _ in plan) <= 1.02 * bound


def test_two_fit_is_tighter():
    # greedy: 6 + 3, gap 1; the 3 leaves room for 2 + 2
    assert (1, [6, 4]) in packing.plan_sequences({6: 1, 4: 1}, 10)
    plan = packing.plan_sequences({7: 1, 5: 3, 2: 1, 1: 1}, 10)
    assert sum(t for t, _ in plan) == 3


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    rng = random.Random(8)
    vocabulary = "the of and a thing other words number people by first water call who oil sit now find long".split()
    rows = ROWS + [(50 + i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 50, 400, 1500, 5000])))) for i in range(120)]
    rows += [(200 + i, "") for i in range(80)]  # a third of the rows has one length
    df = documents(spark, rows).repartition(5)
    folder = write(spark, tmp_path_factory.mktemp("packing"), df)
    return rows, queries.op12_packing(spark, folder).collect()


def test_packing_places_every_piece(packed):
    rows, got = packed
    tokenizer = Tokenizer.from_file(queries.WORD_MODEL)
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], "<u4")
            want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():  # gapless from 0, within the capacity
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert Counter(tuple(sorted((n for _, n in p), reverse=True)) for p in by_sequence.values()) == plain_fillings(
        [r["length"] for r in got], 2048)
    assert len(by_sequence) <= 1.05 * sum(r["length"] for r in got) / 2048


def test_whole_sequences(spark):
    docs = documents(spark, [(i, "one two three " * i) for i in range(30)] + [(None, None)])
    placed = packing.pack(docs, queries.WORD_MODEL, capacity=64, tokens=True)
    rows = {r["sequence_id"]: r for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        whole = np.frombuffer(rows[r["sequence_id"]]["tokens"], "<u2")
        assert len(whole) <= 64 and r["doc_id"] in rows[r["sequence_id"]]["doc_ids"]
        part = whole[r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(part.astype("<u4").tobytes()) == r["ids_crc32"]
    assert packing.pack(empty(spark), queries.WORD_MODEL).count() == 0


# --- spelling ------------------------------------------------------------

def plain_counts(rows):
    total = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lowered(w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            total[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    return total


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in kept if v != w and one_edit(w, v)] for w in kept}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-kept[v], v), default=None)
        form[w] = best if best and kept[best] >= 2 * kept[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), kept[w], len(near[w]), kept[form[w]] if form[w] else None) for w in kept}


def misspelt(rng, words):
    w = rng.choice(words)
    i = rng.randrange(len(w))
    kind = rng.randrange(6)
    return (w[:i] + w[i + 1:], w[:i] + rng.choice("abcéß") + w[i:], w[:i] + rng.choice("abÉé") + w[i + 1:], w, w, w.upper())[kind]


def test_spelling_query_equals_plain_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_WORDS", 20)  # several tiles in a block
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 300)
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeéàz", k=rng.randint(4, 9))) for _ in range(60)] + ["straße", "ÉCOLE", "aaaaa", "x" * 3000]
    rows = [(i, rng.choice([" ", "-", "1", "ﬁ", "Ÿ", "_"]).join(misspelt(rng, words) for _ in range(80))) for i in range(120)]
    rows += ROWS + [(1, "Hello, hello HELLO hellp hellp hellp hello hello hello hello")] * 3
    got = queries.op13_spelling(spark, write(spark, tmp_path, documents(spark, rows)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_counts(rows))
    assert sum(1 for r in want if r[1]) > 20 and max(r[4] for r in want) > 4
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)


def test_counts_of_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONG_TEXT", 50)
    rows = [(1, "some words here and there " * 40), (None, "Some İ words")]
    got = {r["word"]: r["n"] for r in spelling.count_words(documents(spark, rows)).collect()}
    assert got == Counter(w for _, t in rows for w in re.findall("[a-zà-ÿ]+", lowered(t)))
    assert spelling.group_variants(spelling.count_words(empty(spark))).count() == 0


def test_blocks_hold_every_partner():
    """Insertions and replacements lead to a block that the steps name, in one direction."""
    steps = spelling._steps()
    key = lambda w: [sum(c in spelling.ALPHABET[k::spelling.CLASSES] for c in w) for k in range(spelling.CLASSES)]
    rng = random.Random(6)
    for _ in range(500):
        w = "".join(rng.choices(spelling.ALPHABET, k=6))
        i, c = rng.randrange(6), rng.choice(spelling.ALPHABET)
        longer, other = w[:i] + c + w[i:], w[:i] + c + w[i + 1:]
        assert [a - b for a, b in zip(key(longer), key(w), strict=True)] in steps
        there = [a - b for a, b in zip(key(other), key(w), strict=True)]
        assert (there in steps) + ([-x for x in there] in steps) == (2 if not any(there) else 1)


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    got = spelling.follow_forms(chain).where(F.col("root") == "w11").count()
    assert got == 11
