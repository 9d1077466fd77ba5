"""Personal data by weak supervision.

Base spans (e-mail, ip, card, phone) come from fixed patterns and checks and always stay. Wider
patterns propose further candidates: written-out addresses, phone numbers without a plus sign,
card-like digit groups whose check digit fails or whose separators differ. Regex, gazetteer and
context labelers vote on every candidate (yes, no, or abstain). Expectation-maximisation over the
counts of vote patterns estimates how often each labeler is right, for each kind: a labeler that
abstains (as it does where the pattern of a candidate already decides its vote) says nothing, base spans count as true and candidates that fail their check as false, and a
prior takes each labeler to be better than chance. Its posteriors train a logistic classifier over
features of the span and its surroundings, and candidates it is sure of are added.

Texts are read once. The votes are counted by a grouped aggregation into at most
8 * 3**6 patterns; the classifier learns from about ``TRAIN_SPANS`` distinct candidates
(picked by a hash, a documented bound). Every candidate is scored.

Defined cases: a null text counts as empty; rows that repeat are searched each; added spans never
overlap base spans or each other (the surer one stays, then the earlier); with no candidates
nothing is added; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.common import bounded_sample, stage

# Kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Gazetteers: address suffixes, calling codes, leading digits of card issuers.
SUFFIXES = frozenset("com org net edu gov int info biz io app dev de fr es it uk us eu ch at nl be pl se no dk fi pt ie cz hu ro "
                     "gr ru ua tr il ca mx br ar cl co pe au nz jp cn kr in id sg hk tw th vn za eg ng ke".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49",
                 "52", "55", "61", "64", "65", "81", "82", "86", "90", "91")
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65", "67")

# Context words before a span that speak for a kind, and words that speak against any.
HINTS = (re.compile(r"(?i)\b(e-?mail|mail|contact|write|address|reach)\b"), re.compile(r"(?i)\b(ip|host|server|address|from|login)\b"),
         re.compile(r"(?i)\b(card|visa|master|amex|credit|debit|payment|account)\b"),
         re.compile(r"(?i)\b(phone|tel|call|mobile|cell|fax|contact|dial)\b"))
AGAINST = re.compile(r"(?i)\b(version|licen[sc]e|isbn|issn|order|invoice|item|id|serial|ref|token|key|page|chapter|section|article)\W*\Z")

WRITTEN = re.compile(r"(?i)[a-z0-9._%+-]{1,64}(?: ?[\[(]at[\])] ?| at )[a-z0-9-]{1,63}(?:(?: ?[\[(]dot[\])] ?| dot |\.)[a-z0-9-]{1,63}){1,6}")
# What stands between name and host in a written-out address begins and ends so; and the characters
# of its name: without regard to case, the letters also match these four.
AT = re.compile(r"(?i)[ \[(]at[ \])]")
WRITTEN_LOCAL = LOCAL | frozenset("\u0130\u0131\u017f\u212a")
BRACKETED = re.compile(r"(?i)[\[(](at|dot)[\])]| dot ")
LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
DOTTED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])")

LABELERS = ("shape", "check", "gazetteer", "context", "against", "edges")
WINDOW = 48  # characters of context on either side
TRAIN_SPANS = 20_000
FEATURE_BITS = 12
SURE = 0.8
CHECK = LABELERS.index("check")
EM_ROUNDS = 50
PRIOR = (18.0, 2.0)  # votes that were right and wrong before any is counted
SHARE = (0.1, 0.5)  # bounds of the share of true spans among those that are neither base nor failed
FAILED = 0.02  # belief in a candidate that fails its check


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What the base pattern finds, in one pass: each @ takes the run of address characters before
    it (not before the end of the last match), whose first character is the leftmost start."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def written_addresses(text: str) -> Iterator[tuple[int, int]]:
    """What WRITTEN finds, tried only where an "at" of its kinds stands: from the leftmost of the 64
    name characters before it (not before the end of the last match)."""
    done, m = 0, AT.search(text)
    while m:
        stop = m.start()
        if text[stop] != " " and text[stop - 1:stop] == " ":  # a blank may stand before a bracket
            stop -= 1
        start = stop
        while start > max(done, stop - 64) and text[start - 1] in WRITTEN_LOCAL:
            start -= 1
        found = WRITTEN.match(text, start) if start < stop else None
        if found:
            done = found.end()
            yield start, done
        m = AT.search(text, max(done, m.start() + 1))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the base spans, and of matches that failed their check."""
    kept: list[tuple[int, int, int]] = []
    failed: list[tuple[int, int, int]] = []
    if "@" in text:
        kept += [(0, *span) for span in emails(text)]
    if not any(c in text for c in "0123456789"):
        return kept, failed
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        ok = all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
        (kept if ok else failed).append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        d = m.group().replace(" ", "").replace("-", "")
        ok = 13 <= len(d) <= 19 and luhn(d)
        if ok or 13 <= len(d) <= 19:
            (kept if ok else failed).append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            ok = 9 <= len(digits_of(m.group())) <= 15
            (kept if ok else failed).append((3, m.start(), m.end()))
    return kept, failed


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """Base spans and wider candidates, which overlap no base span."""
    kept, failed = base_spans(text)
    wide = list(failed)
    wide += [(0, *span) for span in written_addresses(text)]
    if any(c in text for c in "0123456789"):
        wide += [(3, m.start(), m.end()) for m in LOCAL_PHONE.finditer(text)]
        wide += [(2, m.start(), m.end()) for m in DOTTED_CARD.finditer(text)]
    taken = sorted((a, b) for _, a, b in kept)
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    starts = [a for a, _ in taken]
    out = [(*s, True) for s in kept]
    for kind, a, b in sorted(set(wide)):
        i = bisect_left(starts, b) - 1
        if i < 0 or ends[i] <= a:
            out.append((kind, a, b, False))
    return out


def votes(text: str, kind: int, start: int, end: int) -> list[int]:
    """One vote for each labeler: 1 yes, -1 no, 0 abstains."""
    span, d = text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    shape = check = gazetteer = 0
    if kind == 0:
        name, _, host = span.partition("@")
        if host:
            shape = 1 if 1 <= len(name) <= 64 and ".." not in span else -1
        else:  # "at" and "." are also words and full stops; brackets or a written "dot" are not
            shape = 1 if BRACKETED.search(span) else -1
        check = 1 if host and not host.startswith("-") else 0
        last = re.split(r"[^A-Za-z]+", span)[-1].lower()
        gazetteer = 1 if last in SUFFIXES else -1
    elif kind == 1:
        parts = span.split(".")
        shape = 1 if all(p == "0" or not p.startswith("0") for p in parts) else -1
        check = 1 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        gazetteer = -1 if parts[0] in ("0", "127", "255") or all(len(p) == 1 for p in parts) else 1
    elif kind == 2:
        shape = 1 if len(d) in (15, 16) and len(set(re.sub("[0-9]", "", span))) <= 1 else -1
        check = 1 if luhn(d) else -1
        gazetteer = 1 if d.startswith(ISSUERS) else -1
    else:
        if span[0] == "+":  # without a plus the pattern sees to shape and length, so only words speak
            shape = 1 if re.fullmatch(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}", span) else 0
            check = 1 if 9 <= len(d) <= 15 else -1
            gazetteer = 1 if d.startswith(CALLING_CODES) else -1
    context = 1 if HINTS[kind].search(before) else 0
    against = -1 if AGAINST.search(before) else 0
    edges = -1 if before[-1:].isalnum() or after[:1].isalnum() else 0  # most spans stand alone, true or not
    return [shape, check, gazetteer, context, against, edges]


def span_features(text: str, kind: int, start: int, end: int, vote: list[int]) -> list[int]:
    """Hashed features of a span and its surroundings; the first is the bias of the kind."""
    span = text[start:end]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[0-9]", "9", span.lower()))[:40]
    words = re.findall(r"\w+", text[max(0, start - WINDOW):start].lower())[-3:]
    names = [f"bias{kind}", f"{kind}shape{shape}", f"{kind}len{min(end - start, 40) // 4}",
             f"{kind}left{text[start - 1:start] if start else '^'}", f"{kind}right{text[end:end + 1] or '$'}",
             *(f"{kind}word{w}" for w in words), *(f"{kind}{n}{v}" for n, v in zip(LABELERS, vote, strict=True) if v)]
    return [xxhash.xxh32_intdigest(x) >> (32 - FEATURE_BITS) for x in dict.fromkeys(names)]


def find_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans): for each row its base spans and candidates with votes and features."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    span = "struct<kind:int,begin:long,stop:long,base:boolean,votes:array<int>,features:array<int>>"
    kind_type = pa.struct([("kind", pa.int32()), ("begin", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()),
                           ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))])
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType),
                           T.StructField("spans", T._parse_datatype_string(f"array<{span}>"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column("text"):
                text, found = x.as_py() or "", []
                for kind, start, end, base in candidates(text):
                    v = votes(text, kind, start, end)
                    found.append((kind, start, end, base, v, span_features(text, kind, start, end, v)))
                rows.append([dict(zip(("kind", "begin", "stop", "base", "votes", "features"), f, strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, pa.list_(kind_type))], names=["id", "spans"])
    return source.mapInArrow(run, schema)


def estimate(patterns: list[tuple[int, list[int], int, bool]]) -> dict[tuple[int, tuple[int, ...]], float]:
    """Expectation-maximisation for each kind over (kind, votes, count, base): the chance that a candidate
    with these votes is true. Each labeler is right with a chance of its own, the same for both truths,
    whenever it votes; votes are independent given the truth. Base spans are held at 1, candidates whose
    check says no at ``FAILED``."""
    out = {}
    for kind in range(len(KINDS)):
        rows = [(v, n, base) for k, v, n, base in patterns if k == kind]
        if not rows:
            continue
        v = np.array([r[0] for r in rows])
        n = np.array([r[1] for r in rows], float)
        base = np.array([r[2] for r in rows], bool)
        failed = ~base & (v[:, CHECK] < 0) if v.shape[1] == len(LABELERS) else np.zeros(len(rows), bool)
        free = ~(base | failed)
        held = np.where(base, 1.0, FAILED)
        q = np.where(free, 1 / (1 + np.exp(-v.sum(1))), held)
        for _ in range(EM_ROUNDS):
            right = (n * q) @ (v > 0) + (n * (1 - q)) @ (v < 0)
            chance = (right + PRIOR[0]) / (n @ (v != 0) + sum(PRIOR))
            share = np.clip((n * q)[free].sum() / max(n[free].sum(), 1.0), *SHARE)
            q = np.where(free, 1 / (1 + np.exp(-np.clip(
                v @ np.log(chance / (1 - chance)) + np.log(share / (1 - share)), -30, 30))), held)
        out |= {(kind, tuple(x)): float(p) for (x, _, true), p in zip(rows, q, strict=True) if not true}
    return out


def fit(rows: list[list[int]], truth: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Logistic weights for hashed features against probabilities, by adaptive gradient steps."""
    w, seen = np.zeros(1 << FEATURE_BITS), np.full(1 << FEATURE_BITS, 1e-6)
    if not rows:
        return w
    at = np.concatenate([np.asarray(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at], len(rows)), -30, 30)))
        g = np.bincount(at, (p - truth)[row], len(w)) / len(rows) + 1e-5 * w
        seen += g * g
        w -= 0.3 * g / np.sqrt(seen)
    return w


def train(found: DataFrame) -> np.ndarray:
    """Weights of the span classifier from the staged spans."""
    spans = found.select(F.explode("spans").alias("s"), "id").select("s.*", "id")
    patterns = spans.groupBy("kind", "votes", "base").agg(F.count("*").alias("n")).orderBy("kind", "votes", "base").collect()
    belief = estimate([(r.kind, list(r.votes), r.n, r.base) for r in patterns])
    some = bounded_sample(spans, TRAIN_SPANS, "id", *spans.drop("id").columns).select("kind", "votes", "features", "base").collect()
    some.sort()  # the same sums whatever task is first
    return fit([list(r.features) for r in some], np.array(
        [1.0 if r.base else belief[r.kind, tuple(r.votes)] for r in some]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, ``base`` and ``all``: arrays of (kind, begin, stop,
    chance), ordered by kind, then begin. The chance of a base span is 1."""
    found = stage(find_spans(docs, id_col, text_col), "personal-spans")
    weights = docs.sparkSession.sparkContext.broadcast(train(found))
    span = "array<struct<kind:int,begin:long,stop:long,chance:double>>"
    schema = T.StructType([T.StructField(id_col, found.schema["id"].dataType),
                           T.StructField("base", T._parse_datatype_string(span)), T.StructField("all", T._parse_datatype_string(span))])
    kind_type = pa.list_(pa.struct([("kind", pa.int32()), ("begin", pa.int64()), ("stop", pa.int64()), ("chance", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            base, both = [], []
            for spans in b.column("spans").to_pylist():
                fixed = [(s["kind"], s["begin"], s["stop"], 1.0) for s in spans if s["base"]]
                added: list[tuple[int, int, int, float]] = []  # by begin; they do not overlap
                starts: list[int] = []
                scored = [(float(1 / (1 + np.exp(-w[s["features"]].sum()))), s) for s in spans if not s["base"]]
                for p, s in sorted(scored, key=lambda x: (-x[0], x[1]["begin"], x[1]["kind"])):
                    if p < SURE:
                        break
                    i = bisect_left(starts, s["stop"])  # those before i begin before this one ends
                    if i == 0 or added[i - 1][2] <= s["begin"]:
                        added.insert(i, (s["kind"], s["begin"], s["stop"], p))
                        starts.insert(i, s["begin"])
                base.append(sorted(fixed))
                both.append(sorted(fixed + added))
            keys = ("kind", "begin", "stop", "chance")
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array([[dict(zip(keys, s, strict=True)) for s in r] for r in rows], kind_type) for rows in (base, both))],
                names=[id_col, "base", "all"])
    return found.mapInArrow(run, schema)


def written(spans: str) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["begin"].cast("string"), s["stop"].cast("string"))), ",")
