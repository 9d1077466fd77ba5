"""URL filter, personal data, decontamination and the pipeline against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import LONG, ROWS, documents, empty
from conftest import SF_ORACLE, SF_SMALL
from hearthlake.llm import decontaminate, personal_data, url_filter
from hearthlake.llm.queries import registry
from test_dedup import plain_components, plain_fingerprint

# ---- URL filter


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after).group()
    path = re.match(r"[^?#]*", after[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, rule in url_filter.RULES:
        at, _, rest = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


def plain_split(label, counts, total):
    """Best cut by trying all of them."""
    best = None
    for mask in range(1 << (len(label) - 1)):
        words, start = [], 0
        for i in range(len(label)):
            if i == len(label) - 1 or mask >> i & 1:
                words.append(label[start:i + 1])
                start = i + 1
        score = sum(math.log(counts[w] / total) if counts[w] else math.log(10 / total / 10 ** len(w)) for w in words)
        if best is None or score > best[0] + 1e-12:
            best = score, words
    return best


def test_viterbi_finds_the_best_cut():
    counts = Counter({"free": 50, "bets": 20, "be": 90, "ts": 1, "free": 50, "the": 300, "rapist": 3, "therapist": 9, "a": 500, "at": 80})
    total = sum(counts.values())
    for label in ("freebets", "therapist", "atthe", "zzz", "thefreeq", "a"):
        got = url_filter.best_split(label, counts, total)
        score = sum(math.log(counts[w] / total) if counts[w] else math.log(10 / total / 10 ** len(w)) for w in got)
        assert "".join(got) == label and abs(score - plain_split(label, counts, total)[0]) < 1e-9
    assert url_filter.best_split("freebets", counts, total) == ["free", "bets"]


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x://y", "a://b://c/d", "http://example.org", "http://org/x",
        "http://notexample.org/en/12#f", "http://x.example.org/en/1", "https://m.example.com/de/?q", "https://m.example.com/fr/ä/B",
        "http://com/fr/", "http://xcom/fr/", "http://free-bets.example.com/en/5", "http://a..b/\n/c?d", "http://freebets.example.net/en/" + "z" * 5000]


def test_url_verdicts(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, None, "x", "y"), (None, URLS[4], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, words string")
    docs = documents(spark, [(1, "free free bets bets and other words"), (2, None)])
    got = url_filter.judge(pages, docs).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    urls = dict(enumerate(URLS)) | {None: URLS[4]}
    tokens, sides = {}, {}
    for r in got:
        host, path = plain_parts(urls[r.page_id])
        verdict, rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        if verdict:
            assert r.verdict == verdict
        labels = [x for x in re.split(r"[^a-z]+", host) if x]
        assert "".join(r.host_words) == "".join(labels)
        tokens.setdefault(r.page_id, [f"host:{w}" for w in r.host_words] + [f"path:{w}" for w in re.split(r"[\W_]+", path.lower()) if w])
        sides[r.page_id] = verdict
    assert next(r.host_words for r in got if r.page_id == 16)[:2] == ["free", "bets"]
    words, pagesn = {"allow": Counter(), "block": Counter()}, Counter()
    for r in got:
        if sides[r.page_id]:
            words[sides[r.page_id]].update(tokens[r.page_id])
            pagesn[sides[r.page_id]] += 1
    v = len(words["allow"] | words["block"]) + 1
    for r in got:
        odds = math.log((pagesn["block"] + 1) / (pagesn["allow"] + 1)) + sum(
            math.log((words["block"][w] + 1) / (words["block"].total() + v)) - math.log((words["allow"][w] + 1) / (words["allow"].total() + v))
            for w in tokens[r.page_id])
        assert abs(odds - r.log_odds) < 1e-9
        if not r.rule:
            assert r.verdict == ("block" if odds > 0 else "allow")


def test_long_words_are_known_and_all_words_count(spark):
    long, longest, beyond = "donaudampfschifffahrtsgesellschaft", "q" * url_filter.LONGEST_WORD, "r" * (url_filter.LONGEST_WORD + 1)
    text = f"{long} {long} ship {longest} {beyond} " + "donau dampf schifffahrts gesellschaft " * 2
    words = url_filter.lexicon(documents(spark, [(1, text), (2, text.upper()), (3, None)]))
    counts = {r.word: r.n for r in words.collect()}
    want = Counter(w for w in (text * 2).split())
    assert sum(counts.values()) == want.total() and counts[""] == want[beyond] and counts[longest] == 2
    labels = [long, "ship" + long, longest, "shipdonau", beyond, long + "x"]
    got = {r.label: r.words for r in url_filter.segment(spark.createDataFrame([(x,) for x in labels], "label string"), words).collect()}
    assert got[long] == [long] and got["ship" + long] == ["ship", long] and got[longest] == [longest] and got["shipdonau"] == ["ship", "donau"]
    assert "".join(got[beyond]) == beyond
    known, total = Counter({w: n for w, n in counts.items() if w}), want.total()

    def best(label):  # of all cuts, by their first word
        scores = [0.0]
        for i in range(len(label) - 1, -1, -1):
            tail = label[i:]
            scores.insert(0, max((math.log(known[tail[:k]] / total) if known[tail[:k]] else math.log(10 / total) - k * math.log(10))
                                 + scores[k - 1] for k in range(1, min(len(tail), url_filter.LONGEST_WORD) + 1)))
        return scores[0]
    for label in labels:
        score = sum(math.log(known[w] / total) if known[w] else math.log(10 / total) - len(w) * math.log(10) for w in got[label])
        assert abs(score - best(label)) < 1e-9


def test_url_filter_on_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none, documents(spark)).collect() == []
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(one, empty(spark)).collect()] == ["allow"]


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = registry()["op6_url_filter"](spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.host, r.path) == plain_parts(pages[r.page_id])
        verdict, rule = plain_rule(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")

# ---- personal data


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[ -]", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15))


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PLAIN for m in re.finditer(p, text) if ok(m.group())]


def written(spans):
    return [f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)]


def test_base_spans_of_random_texts():
    rng = random.Random(5)
    bits = ["a", "b.", "@", "@x.", "c-d", "_", "%", "1", "255", "256", ".", "..", "+", "+1", " ", "(", ")", "-", "4111 1111 1111 1111", "é",
            "10.0.0.1", "007", "\n", "x@y.z_q@r.st", "5500-0000-0000-0004", "٣", "+49 30 1234567"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert written(personal_data.base_spans(text)[0]) == plain_spans(text), text


def test_written_addresses_are_what_the_pattern_finds():
    for text in ("mail ann at example.com", "ANN [AT] EXAMPLE [DOT] COM", "ann (AT) example.com", "ann At example Dot com"):
        assert [text[a:b] for k, a, b, base in personal_data.candidates(text) if k == 0 and not base] == [text.removeprefix("mail ")]
    rng = random.Random(9)
    bits = ["a", "at", " at ", " AT ", "[at]", " [At] ", "(aT)", " (at)", "[at)", " ", "  ", "x.y", ".", "dot", " dot ", "[DOT]", " (dot) ", "-",
            "é", "\u0130", "\u0131", "\u017f", "\u212a", "b" * 40, "+", "_", "\n", "[", ")", "@", "com", "Z9"]
    for _ in range(100_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert list(personal_data.written_addresses(text)) == [m.span() for m in personal_data.WRITTEN.finditer(text)], text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1" + " " * 100_000, "1 " * 100_000):
        personal_data.candidates(text)


def test_reliabilities_are_recovered():
    rng = random.Random(6)
    right = (0.95, 0.9, 0.8, 0.6, 0.55)
    rows = Counter()
    truth = Counter()
    for _ in range(20_000):
        y = rng.random() < 0.4
        votes = tuple((1 if (rng.random() < p) == y else -1) for p in right)
        rows[votes] += 1
        truth[votes] += y
    belief = personal_data.estimate([(0, list(v), n, False) for v, n in rows.items()])
    error = sum(abs(belief[0, v] * n - truth[v]) for v, n in rows.items()) / 20_000
    assert error < 0.02


def test_classifier_learns_features():
    rows = [[1, 2 + i % 2] for i in range(100)]
    w = personal_data.fit(rows, personal_data.np.array([float(i % 2) for i in range(100)]))
    assert w[1] + w[2] < -1 and w[1] + w[3] > 1


def test_wider_candidates_are_added_and_base_stays(spark):
    sure = [f"call me: phone {a}-555-{b}, e-mail ann{b} [at] example [dot] com or bob{b}@example.com, phone +1 (212) 555-{b} today"
            for a, b in zip(range(212, 252), range(1000, 1040), strict=True)]
    noise = [f"version {i}.{i}.2 order 1234567890123{i % 10} of {i}" for i in range(40)]
    docs = documents(spark, list(enumerate(sure + noise)) + [(100, None), (None, "")])
    got = {r.doc_id: r for r in personal_data.find_personal_data(docs).collect()}
    for i, t in enumerate(sure + noise):
        base = written((s.kind, s.begin, s.stop) for s in got[i].base)
        every = [(s.kind, s.begin, s.stop) for s in got[i].all]
        assert base == plain_spans(t) and set(base) <= set(written(every))
        spans = sorted((a, b) for k, a, b in every if written([(k, a, b)])[0] not in base)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert sum(len(got[i].all) > len(got[i].base) for i in range(40)) >= 38
    assert sum(len(got[i].all) > len(got[i].base) for i in range(40, 80)) <= 4
    assert got[100].all == [] and got[None].all == []


@pytest.mark.parametrize("every", [100, 10])
def test_planted_spans_are_found_in_shipped_documents(spark, every):
    """Written-out addresses, plain phone numbers and dotted cards at two rates, among decoys."""
    rows, want, decoys = [], set(), set()
    for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect():
        i, text = r.doc_id, r.text or ""

        def plant(lead, span, into, kind):
            nonlocal text
            text += f" {lead} "
            into.add((i, kind, len(text), len(text) + len(span)))
            text += span + " soon"
        if i % every == 0:
            card = next(c for c in (f"4{i:011d}{x:04d}" for x in range(9999)) if personal_data.luhn(c))
            plant("write an e-mail to", f"ann{i} [at] example [dot] {('com', 'ca', 'jp', 'br')[i // every % 4]}", want, 0)
            plant("or phone", f"212-555-{1000 + i}", want, 3)
            plant("pay by card", ".".join(card[k:k + 4] for k in (0, 4, 8, 12)), want, 2)
        elif i % every == 1:
            plant("they met", f"friends{i} at noon.then", decoys, 0)
            plant("order", f"212-555-{1000 + i}", decoys, 3)
            plant("serial", "4111.1111.1111.%04d" % (i % 1000 + 1112), decoys, 2)
        rows.append((i, text))
    got = personal_data.find_personal_data(documents(spark, rows)).collect()
    added = {(r.doc_id, s.kind, s.begin, s.stop) for r in got for s in r.all} - {
        (r.doc_id, s.kind, s.begin, s.stop) for r in got for s in r.base}
    for kind in (0, 2, 3):
        mine = {w for w in want if w[1] == kind}
        assert len(added & mine) >= 0.9 * len(mine), kind
    assert len(added - want) <= 0.05 * len(want | decoys), sorted(added - want)


def test_many_spans_take_linear_time(spark):
    text = " ".join(f"phone 212-555-{i % 10_000:04d}, a{i}@example.com;" for i in range(25_000))
    got = personal_data.find_personal_data(documents(spark, [(1, text)])).collect()
    assert len(got[0].base) == 25_000


def test_personal_data_with_awkward_rows(spark):
    got = personal_data.find_personal_data(documents(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ROWS)
    assert personal_data.find_personal_data(empty(spark)).collect() == []


def test_personal_data_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    got = registry()["op8_personal_data"](spark, SF_ORACLE).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in personal_data.KINDS]
        assert set(want) <= set(r.spans.split(",")) | {""}

# ---- decontamination


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_equals_the_table_method():
    rng = random.Random(7)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert decontaminate.lcs(decontaminate.masks_of(a), len(a), b) == plain_lcs(a, b)


def plain_leaks(docs, items):
    """Pairs whose words agree by the same rule, over all stretches of every document."""
    out = set()
    for d, text in docs:
        words = decontaminate.words_of(text)
        for i, item in items:
            p = decontaminate.words_of(item)
            if not p or len(set(p) & set(words)) < 0.5 * len(set(p)):
                continue
            for at in range(0, max(1, len(words)), max(1, len(p) // 2)):
                here = words[at:at + 2 * len(p)]
                share = plain_lcs(p, here) / len(p)
                if share >= (1 if len(p) < decontaminate.FEW_WORDS else decontaminate.STRONG):
                    out.add((d, i))
                    break
    return out


def test_recall_against_brute_force(spark):
    read = lambda t, k: [(r[k], r.text) for r in spark.read.parquet(f"{SF_ORACLE}/{t}.parquet").collect()]
    items = read("benchmark", "item_id")
    got = {(r.doc_id, r.item_id) for r in registry()["op3_decontaminate"](spark, SF_ORACLE).collect()}
    want = plain_leaks(read("documents", "doc_id"), items)
    assert want and len(got & want) >= 0.9 * len(want) and len(got - want) <= 0.05 * len(want)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_PASSAGES, 3])
def test_leaks_with_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_PASSAGES", block)
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    items = [(i, say(20)) for i in range(6)] + [(6, None), (7, ""), (8, items0 := say(150)), (1, say(20))]
    planted = [(100, say(200) + " " + items[2][1] + " " + say(300)), (101, items[3][1].upper()), (101, items[3][1].upper()),
               (102, say(40) + " ".join(w for k, w in enumerate(items[4][1].split()) if k != 7) + say(9)),
               (103, say(500) + " " + " ".join(items0.split()[40:110]) + " " + say(50))]
    docs = documents(spark, ROWS + planted + [(i, say(400)) for i in range(200, 230)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench, matches_col="score")
    assert sorted(found.columns) == sorted(docs.columns)
    got = Counter((r.doc_id, x.item_id) for r in found.collect() for x in r.score)
    assert got == Counter([(100, 2), (101, 3), (101, 3), (102, 4), (103, 8)])
    assert found.count() == docs.count()
    assert decontaminate.find_leaks(empty(spark), bench).collect() == []
    assert all(r.leaks == [] for r in decontaminate.find_leaks(docs, bench.limit(0)).collect())


def test_weak_matches_with_the_answer_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(6))
    items, texts = [], []
    for i in range(12):  # a few words repeat, the others occur once; of those, some are replaced
        again = [word() for _ in range(6)]
        p = [again[k % 6] if k % 2 else word() for k in range(40)]
        at = set(rng.sample([k for k in range(35) if p[k] not in again], 10 + i // 2))
        items.append((i, " ".join(p)))
        texts.append((i, " ".join([word() for _ in range(30)] + [word() if k in at else w for k, w in enumerate(p)] + [word() for _ in range(30)])))
    block = decontaminate.Block([i for i, _ in items], [t.split() for _, t in items], {})
    want = set()
    for i, item in items:
        p = item.split()
        for d, text in texts:
            words = text.split()
            share, answer = plain_lcs(p, words) / len(p), plain_lcs(p[-decontaminate.ANSWER_WORDS:], words) / decontaminate.ANSWER_WORDS
            found = share >= decontaminate.STRONG or share >= decontaminate.WEAK and answer >= decontaminate.ANSWER_SHARE
            assert (block.verdict(i, words) > 0) == found, (i, d, share)
            if found:
                want.add((d, i))
    assert len(want) == 12
    docs = documents(spark, texts + [(i, " ".join(word() for _ in range(300))) for i in range(100, 130)])
    got = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, x.item_id) for r in got for x in r.leaks} == want


def test_the_latent_space_is_fitted_on_all_windows(spark, monkeypatch):
    rng = random.Random(5)
    terms = [f"t{i}" for i in range(60)]
    block = decontaminate.Block([0, 1], [terms[:40], terms[30:]], {w: i for i, w in enumerate(terms)})
    texts = [" ".join(rng.choices([*terms[i % 50:i % 50 + 10], "other"], k=rng.randint(0, 90))) for i in range(2_600)]
    df = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)] + [(None, None)], "id long, text string").repartition(5)
    places = decontaminate.term_places(df, block)
    seen = []

    def products(shared):
        seen.append(shared.value)
        return own(shared)
    own = decontaminate._products
    monkeypatch.setattr(decontaminate, "_products", products)
    decontaminate.fit(block, places)
    idf, basis = (x.astype(float) for x in seen[0])
    n_docs = [sum(w in t.split() for t in texts) for w in terms]
    assert np.allclose(idf, [(math.log((len(texts) + 2) / (n + 1)) + 0.05) * (n <= decontaminate.COMMON * (len(texts) + 1)) for n in n_docs])
    windows = [w[a:a + 36] for w in (t.split() for t in texts) for a in range(0, len(w), 36)]
    matrix = np.array([[w.count(t) for t in terms] for w in windows]) * idf
    matrix = matrix[matrix.any(1)]
    matrix /= np.sqrt((matrix ** 2).sum(1, keepdims=True))
    mine = np.zeros((2, len(terms)))
    for i, p in enumerate(block.passages):
        at, x = decontaminate._tf_idf(block.term_ids(p), idf)
        mine[i, at] = x
    want = np.linalg.qr(matrix.T @ (matrix @ basis) + len(matrix) / 2 * mine.T @ (mine @ basis))[0]
    assert np.allclose(np.abs(seen[1][1]), np.abs(want), atol=1e-3)

# ---- pipeline


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from hearthlake.llm import quality
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    weights = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), ~quality.held_out(F.col("doc_id")))
    rows = {r.doc_id: r.text for r in quality.score(docs, weights).filter("quality_score >= 0.7").collect()}
    groups = defaultdict(list)
    for i, t in rows.items():
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in t)].append(i)
    rows = {i: rows[i] for i in (max(g) for g in groups.values())}
    rows = {i: rows[i] for i in {c for _, _, c in plain_components([(i, plain_fingerprint(t)) for i, t in rows.items()])}}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, _ in plain_leaks(rows.items(), items)}
    assert got.keys() == rows.keys() - leaked
    for i, r in got.items():
        assert r.text == rows[i] and r.decoded_text == r.text.replace("▁", " ")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup",
                                                      "benchmark decontamination", "sentencepiece"]


def test_stages_take_awkward_and_empty_tables(spark):
    import corpus_pipeline
    from hearthlake.llm.common import stage
    for docs in (documents(spark), empty(spark), documents(spark, [(1, None), (1, None), (2, LONG), (2, LONG)])):
        columns = docs.columns
        for name, step in corpus_pipeline.STAGES[:-1]:
            docs = stage(step(spark, docs, SF_SMALL), "test-stage")
            assert docs.columns == columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert last.count() == docs.count()


def test_windows_that_cannot_hold_a_passage_are_rejected_by_numbers(monkeypatch):
    words = [f"w{i}" for i in range(decontaminate.PASSAGE)]
    n = len(words)
    block = decontaminate.Block([7], [words], {w: i for i, w in enumerate(words)}, np.eye(n, dtype=np.float32),
                                np.full((n, 1), n ** -0.5, np.float32), np.r_[np.ones(n, bool), False])
    few, whole = np.arange(n // 2, dtype=np.int32), np.arange(n, dtype=np.int32)
    assert [[(p, share) for p, _, share, _ in found] for found in block.matches([few, whole])] == [[], [(0, 1.0)]]

    def known(self, ids):
        raise AssertionError("words were read")
    monkeypatch.setattr(decontaminate.Block, "known", known)
    assert block.matches([few]) == [[]]  # near the passage, yet too few of its words
