"""Language identification of web pages by Bayesian fusion of evidence.

Four sources speak on a page's language: the likelihood of its visible text under hashed byte
trigrams of each language, the language its markup declares, the address suffix, and the host.
How far a declaration can be trusted, and what a host tends to publish, is learnt from all pages:
grouped aggregations add up the text posteriors by declaration, suffix, domain and host. A host's
prior is its own counts smoothed by its domain's, those by its suffix's, and those by the whole
corpus. A page's own share is taken out of every count before it judges the page.

Text models count the trigrams of all labelled documents, so every language that labels a document
is known, however rare; the judgement covers all pages.

Defined cases: a null or empty page has no text evidence; a null URL, or one without ``://``, has
the empty host, domain and suffix, which are groups like any other; very long pages and broken
markup take linear time, whatever is left open in them; without labelled documents
every language is null; of equal posteriors the language first in the alphabet wins; rows that
repeat are judged each; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake.llm.common import stage
from hearthlake.llm.url_filter import host_and_path

BITS = 15
HELD_LANGS = 64  # languages whose counts (256 kB each) a task holds before it hands them on
TEMPER = 0.25  # trigrams of a text overlap: their joint evidence is a power of the product
SMOOTH = 5.0  # pages of the level above that a level is mixed with
DECLARED_SMOOTH = 0.5
_OPENER = re.compile(r"<(?:((?ai:script|style|noscript|template))\b|!--)")
_CLOSERS = {kind: re.compile(rf"</(?ai:{kind})\s*+>") for kind in ("script", "style", "noscript", "template")} | {"": re.compile("-->")}
_TAG = re.compile(r"<[^>]*+>")
_HTML = re.compile(r"(?i)<html\b")
_LANG = re.compile(r"""(?i)\s(?:xml:)?lang\s*+=\s*+["']?\s*+([a-z]{2,8})""")
_ZEROS = re.compile(r"&#0{8,}(?=[0-9])")
_TOO_LARGE = re.compile(r"&#[1-9][0-9]{7,};?")


def without_hidden(page: str) -> str:
    """The page with a blank for every script, style sheet, template and comment. One that is never
    closed hides nothing. Each closer is looked for from left to right and, once there is none left,
    never again, so the time is linear."""
    parts, at, unclosed = [], 0, set()
    m = _OPENER.search(page)
    while m:
        kind = (m.group(1) or "").lower()
        end = None if kind in unclosed else _CLOSERS[kind].search(page, m.end())
        if end:
            parts += [page[at:m.start()], " "]
            at = end.end()
        else:
            unclosed.add(kind)
        m = _OPENER.search(page, end.end() if end else m.end())
    return "".join([*parts, page[at:]])


def visible_text(page: str) -> str:
    """Text outside of tags, with references resolved."""
    page = without_hidden(page)
    last = page.rfind(">") + 1  # no tag ends after it
    text = _TAG.sub(" ", page[:last]) + page[last:]
    return html.unescape(_TOO_LARGE.sub("\ufffd", _ZEROS.sub("&#", text)))  # its int() refuses long numbers


def declared_language(page: str) -> str:
    """Primary language subtag that the markup declares, or the empty string."""
    m = _HTML.search(page)
    m = m and _LANG.search(page, m.end(), page.find(">", m.end()) + 1)
    return m.group(1).lower() if m else ""


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of a text in lower case, with white space as one blank."""
    b = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    key = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)
    return (key >> np.uint32(32 - BITS)).astype(np.int64)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and the logarithms of their trigram chances, (languages, 2**BITS)."""
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                at = np.union1d([0], np.flatnonzero(n))  # a language without any trigram is known too
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], names=["lang", "at", "n"])
            held.clear()
        for b in batches:
            for lang, x in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                if lang not in held:
                    if len(held) >= HELD_LANGS:
                        yield from out()
                    held[lang] = np.zeros(1 << BITS, np.int64)
                held[lang] += np.bincount(trigrams(x.as_py()), minlength=1 << BITS)
        yield from out()
    rows = (labelled.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
            .toArrow())  # at most 2**BITS rows a language, as many as the chances have
    langs = sorted(set(rows["lang"].to_pylist()))
    n = np.full((len(langs), 1 << BITS), 0.5)
    row = {lang: i for i, lang in enumerate(langs)}
    n[[row[x] for x in rows["lang"].to_pylist()], rows["at"].to_numpy()] += rows["n"].to_numpy()
    return langs, np.log(n / n.sum(1, keepdims=True)).astype(np.float32)


def posterior(log: np.ndarray) -> np.ndarray:
    p = np.exp(log - log.max(-1, keepdims=True))
    return p / p.sum(-1, keepdims=True)


def read_pages(pages: DataFrame, model, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, host, domain, suffix, declared, log, q): the evidence of each page alone."""
    host = host_and_path(F.col(url_col))[0]
    source = pages.select(F.col(id_col).alias("id"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    source = source.withColumn("labels", F.split("host", r"\.")).withColumn(
        "suffix", F.element_at("labels", -1)).withColumn(
        "domain", F.array_join(F.slice("labels", F.greatest(F.size("labels") - 1, F.lit(1)), F.lit(2)), "."))
    source = source.select("id", "host", "domain", "suffix", "html")
    schema = (source.drop("html").schema.add("declared", "string").add("log", T.ArrayType(T.DoubleType())).add("q", T.ArrayType(T.DoubleType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chances = model.value
        for b in batches:
            log, declared = np.zeros((b.num_rows, len(chances))), []
            for i, x in enumerate(b.column("html")):
                page = x.as_py() or ""
                declared.append(declared_language(page))
                log[i] = TEMPER * chances[:, trigrams(visible_text(page))].sum(1)
            arrays = [pa.array(list(m), pa.list_(pa.float64())) for m in (log, posterior(log))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "host", "domain", "suffix")), pa.array(declared, pa.string()),
                                              *arrays], names=["id", "host", "domain", "suffix", "declared", "log", "q"])
    return source.mapInArrow(run, schema)


def fuse(log: np.ndarray, q: np.ndarray, sums: list[np.ndarray], declared: np.ndarray, kinds: int, said: np.ndarray) -> np.ndarray:
    """Posteriors of rows. ``sums``: text posteriors added up over the corpus and the row's suffix,
    domain and host; ``declared``: over rows with the same declaration; ``said``: over the corpus."""
    prior = np.full_like(q, 1.0 / q.shape[1])
    for level in sums:
        own = np.maximum(level - q, 0)
        prior = (own + SMOOTH * prior) / (own.sum(1, keepdims=True) + SMOOTH)
    says = (np.maximum(declared - q, 0) + DECLARED_SMOOTH) / (np.maximum(said - q, 0) + DECLARED_SMOOTH * kinds)
    return posterior(log + np.log(np.maximum(prior, 1e-12)) + np.log(says))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: the id, lang, confidence, text_lang (by text alone),
    declared, host. ``docs`` (doc_id, text, lang) teaches the text models."""
    spark = pages.sparkSession
    langs, chances = train(docs)
    if not langs:
        host = host_and_path(F.col(url_col))[0]
        return pages.select(id_col, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"),
                            F.lit(None).cast("string").alias("text_lang"), F.lit("").alias("declared"), host.alias("host"))
    rows = stage(read_pages(pages, spark.sparkContext.broadcast(chances), id_col, url_col, html_col), "language-pages")
    added = F.array(*[F.sum(F.col("q")[i]) for i in range(len(langs))])
    total = rows.agg(added.alias("all_q"), F.count_distinct("declared").alias("kinds")).first()
    whole, kinds = [float(x or 0) for x in total.all_q], total.kinds + 1
    hosts = rows.groupBy("host", "domain", "suffix").agg(added.alias("host_q"))
    by = lambda c: rows.groupBy(c).agg(added.alias(f"{c}_q"))
    hosts = hosts.join(by("domain"), "domain").join(by("suffix"), "suffix").drop("domain", "suffix")
    joined = (rows.drop("domain", "suffix").join(by("declared"), "declared").join(hosts, "host")
              .select("id", "host", "declared", "log", "q", "suffix_q", "domain_q", "host_q", "declared_q"))
    schema = (rows.select("id").schema.add("lang", "string").add("confidence", "double").add("text_lang", "string")
              .add("declared", "string").add("host", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(langs)
        for b in batches:
            if not b.num_rows:
                continue
            table = lambda c, b=b: np.array(b.column(c).to_pylist(), float)
            q, everything = table("q"), np.broadcast_to(np.array(whole), (b.num_rows, len(langs)))
            p = fuse(table("log"), q, [everything, table("suffix_q"), table("domain_q"), table("host_q")],
                     table("declared_q"), kinds, everything)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(names[p.argmax(1)], pa.string()), pa.array(p.max(1)),
                 pa.array(names[q.argmax(1)], pa.string()), b.column("declared"), b.column("host")], names=schema.names)
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)
