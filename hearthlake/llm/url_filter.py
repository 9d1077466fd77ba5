"""URL filter: host rules, and for the rest a naive Bayes verdict over segmented host words.

Host labels are often several words run together. Each distinct label is split by unigram
Viterbi: of all ways to cut it, the one whose words are likeliest under word counts of the
corpus, where a piece the corpus lacks costs more the longer it is. A word has at most 63 letters,
as many as a label may have in the domain name system; longer ones only add to the total. The lexicon is not shared
whole: the substrings of the distinct labels are joined with the word counts, so a label only
meets its own candidates.

A multinomial naive Bayes model over host words and path words learns from the URLs that a rule
decides, and judges those that no rule fits. Counts are grouped sums over all URLs; URLs
add up their words' weights by a join on the word.

Defined cases: a null URL, or one without ``://``, has empty host and path, no words and no rule;
then, and where no rule fits any URL, the prior decides (allow where the sides are equal); rows
that repeat are judged each; an empty table gives an empty result; only id and URL are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.common import LOWER, UPPER, stage

# The rules, as (verdict, host and path prefix).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
LONGEST_WORD = 63  # letters of the longest label that DNS allows
SMOOTHING = 1.0
FLUSH = 500_000  # distinct words a task holds before it hands them on
_LETTERS = re.compile(r"[a-z]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: then up to ``?``, ``#`` or the end."""
    after = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1), F.lit(""))
    host = F.regexp_extract(after, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule whose host is the URL's or a parent of it and whose path begins the
    URL's, and its verdict; both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        at, slash, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def lexicon(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): words of a-z of all texts, A-Z lower-cased. Counted in the task first. Words that
    no label can hold are counted together, as the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                           names=["word", "n"])
            counts.clear()
            return b
        for b in batches:
            for text in b.column("text"):
                counts.update(w if len(w) <= LONGEST_WORD else "" for w in _LETTERS.findall((text.as_py() or "").lower()))
            if len(counts) > FLUSH:
                yield out()
        if counts:
            yield out()
    return (docs.select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def best_split(label: str, known: dict[str, int], total: int) -> list[str]:
    """The likeliest cut of a label into words. Of equal cuts, the one with the longer last word."""
    base = math.log(max(total, 1))
    best, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    for end in range(1, len(label) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            n = known.get(label[start:end], 0)
            gain = math.log(n) - base if n else math.log(10) - base - (end - start) * math.log(10)
            if best[start] + gain > best[end]:
                best[end], back[end] = best[start] + gain, start
    words, end = [], len(label)
    while end:
        words.append(label[back[end]:end])
        end = back[end]
    return words[::-1]


def segment(labels: DataFrame, words: DataFrame) -> DataFrame:
    """(label, words) for a table of distinct labels, from a lexicon (word, n)."""
    total = words.agg(F.sum("n")).first()[0] or 0
    pieces = labels.select("label", F.explode(F.expr(
        f"flatten(transform(sequence(1, length(label)), i -> transform(sequence(1, least({LONGEST_WORD}, "
        "length(label) - i + 1)), k -> substring(label, i, k))))")).alias("word")).distinct()
    found = pieces.join(words, "word").groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))  # a label's own substrings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [best_split(label, dict(known or ()), total)
                     for label, known in zip(b.column("label").to_pylist(), b.column("known").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(split, pa.list_(pa.string()))], names=["label", "words"])
    return labels.join(found, "label", "left").select("label", "known").mapInArrow(run, "label string, words array<string>")


def host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, words): the segmented words of each distinct host."""
    labels = stage(hosts.select("host", F.filter(F.split("host", r"[^a-z]+"), lambda x: x != "").alias("all"))
                   .select("host", F.size("all").alias("n"), F.posexplode("all").alias("at", "label")), "url-labels")
    inner = (F.col("at") < F.col("n") - 1) | (F.col("n") == 1)  # the address suffix is a word of its own
    split = stage(segment(labels.filter(inner).select("label").distinct(), words), "url-words")
    whole = labels.filter(~inner).select("host", "at", F.array("label").alias("words"))
    return (labels.filter(inner).join(split, "label").select("host", "at", "words").union(whole).groupBy("host")
            .agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))  # of one host
            .select("host", F.expr("flatten(parts.words)").alias("words")))


def judge(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "text",
          rules=RULES) -> DataFrame:
    """One row for each row of ``pages``: the id, host, path, rule, verdict, the segmented
    ``host_words`` and ``log_odds`` of block against allow. ``docs`` gives the word counts."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, decided = matching_rule(F.col("host"), F.col("path"), rules)
    urls = urls.select("*", rule.alias("rule"), decided.alias("decided"))
    known = host_words(urls.select("host").filter("host <> ''").distinct(), stage(lexicon(docs, text_col), "url-lexicon"))
    path_words = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    urls = urls.join(known, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    urls = stage(urls.withColumn("tokens", F.concat(
        F.transform("words", lambda w: F.concat(F.lit("host:"), w)),
        F.transform(path_words, lambda w: F.concat(F.lit("path:"), w))))
        .withColumn("row", F.monotonically_increasing_id()), "url-rows")  # staged: row numbers stay

    share = urls.agg(*[F.count_if(F.col("decided") == side).alias(side) for side in ("allow", "block")],
                     *[F.coalesce(F.sum(F.when(F.col("decided") == side, F.size("tokens"))), F.lit(0)).alias(f"{side}_words")
                       for side in ("allow", "block")]).first()
    counts = stage(urls.filter("decided is not null").select("decided", F.explode("tokens").alias("token")).groupBy("token").agg(
        *[F.count_if(F.col("decided") == side).alias(side) for side in ("allow", "block")]), "url-counts")
    kinds = counts.count() + 1
    odds = lambda side: F.log((F.col(side) + SMOOTHING) / (share[f"{side}_words"] + SMOOTHING * kinds))
    unseen = math.log((share["allow_words"] + SMOOTHING * kinds) / (share["block_words"] + SMOOTHING * kinds))
    prior = math.log((share["block"] + SMOOTHING) / (share["allow"] + SMOOTHING))
    weights = counts.select("token", (odds("block") - odds("allow")).alias("w"))
    added = (urls.select("row", F.explode("tokens").alias("token")).join(weights, "token", "left")
             .groupBy("row").agg(F.sum(F.coalesce("w", F.lit(unseen))).alias("sum")))
    log_odds = F.lit(prior) + F.coalesce("sum", F.lit(0.0))
    return urls.join(added, "row", "left").select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("decided", F.when(log_odds > 0, "block").otherwise("allow")).alias("verdict"),
        F.col("words").alias("host_words"), log_odds.alias("log_odds"))
