"""Exact and near duplicates against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from cases import LONG, ROWS, documents, empty, lowered
from conftest import SF_SMALL
from hearthlake.llm import exact_dedup, simhash
from hearthlake.llm.common import fold_components
from hearthlake.llm.queries import ORACLE_SQL, registry


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (5000, 4)).astype(np.uint64)
    mph = exact_dedup.PerfectHash.build(keys)
    assert sorted(mph.slots(keys)) == list(range(5000))
    again = exact_dedup.PerfectHash(mph.sizes, mph.dump())
    assert (again.slots(keys) == mph.slots(keys)).all()
    held = np.empty_like(keys)
    held[mph.slots(keys)] = keys
    strangers = np.random.default_rng(2).integers(0, 1 << 63, (5000, 4)).astype(np.uint64)
    slot = mph.slots(strangers)
    assert not (held[np.maximum(slot, 0)] == strangers).all(1).any()
    with pytest.raises(ValueError):
        exact_dedup.PerfectHash.build(np.zeros((2, 4), np.uint64))


@pytest.mark.parametrize("split", ["default", "all", "none"])
def test_exact_duplicates_with_awkward_rows(spark, split):
    from pyspark.sql import functions as F
    sides = {"default": exact_dedup.first_half, "all": lambda c: F.lit(True), "none": lambda c: F.lit(False)}
    got = exact_dedup.exact_duplicates(documents(spark), is_history=sides[split]).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[lowered(t)].append(i)
    assert len(got) == len(ROWS)
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows = [r for r in got if r.text_sha256 == digest]
        top = max((i for i in ids if i is not None), default=None)
        assert Counter(r.doc_id for r in rows) == Counter(ids)
        assert all(r.keep_id == top and r.group_size == len(ids) for r in rows)
        assert [r.doc_id for r in rows if r.kept] == [top]
    kept = exact_dedup.drop_exact_duplicates(documents(spark))
    assert kept.columns == documents(spark).columns
    assert Counter((r.doc_id, lowered(r.text)) for r in kept.collect()) == Counter(
        (max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())


@pytest.mark.parametrize("share", [0, 1, 5, 10])
def test_shards_follow_the_larger_side(spark, monkeypatch, share):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup, "SHARD_DIGESTS", 20)
    seen, probe = [], exact_dedup.probe
    monkeypatch.setattr(exact_dedup, "probe", lambda index, batch, shards: seen.append(shards) or probe(index, batch, shards))
    docs = documents(spark, [(i, f"text {i // 2}") for i in range(400)])
    got = exact_dedup.exact_duplicates(docs, is_history=lambda c: c % 20 < F.lit(2 * share)).collect()
    assert seen == [max(share, 10 - share)]
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == Counter((i, i | 1, 2, i % 2 == 1) for i in range(400))


def test_exact_duplicates_of_an_empty_table(spark):
    assert exact_dedup.exact_duplicates(empty(spark)).collect() == []
    assert exact_dedup.drop_exact_duplicates(empty(spark)).collect() == []


def test_exact_query_equals_sql(spark):
    from oracle_check import compare, duck
    assert compare(spark, duck(SF_SMALL), "op1", registry()["op1_exact_dedup"], ORACLE_SQL["op1_exact_dedup"], SF_SMALL)


def plain_fingerprint(text):
    words = lowered(text).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """(id, fingerprint) -> smallest id reachable, for each row, over all pairs."""
    fps = sorted({fp for _, fp in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, f in enumerate(fps):
        for g in fps[i + 1:]:
            if (f ^ g).bit_count() <= 2:
                root[find(f)] = find(g)
    low = defaultdict(list)
    for i, fp in rows:
        low[find(fp)].append(i)
    return [(i, f"{fp:016x}", min((x for x in low[find(fp)] if x is not None), default=None)) for i, fp in rows]


def as_multiset(df):
    return Counter((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_fingerprint_equals_the_jvm_hash(spark):
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("a b c",), ("é ü ß",)], "s string").select("s", F.xxhash64("s").alias("h")).collect()
    for r in got:
        assert simhash.fingerprint(r.s) == r.h % (1 << 64) == plain_fingerprint(r.s)


def test_near_duplicates_with_awkward_rows(spark):
    want = plain_components([(i, plain_fingerprint(t)) for i, t in ROWS])
    assert as_multiset(simhash.near_duplicates(documents(spark))) == Counter(want)
    kept = simhash.drop_near_duplicates(documents(spark))
    assert kept.columns == documents(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({c for _, _, c in want})
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.drop_near_duplicates(empty(spark)).collect() == []


def test_near_duplicate_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs])
    assert as_multiset(registry()["op2_simhash"](spark, SF_SMALL)) == Counter(want)


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 3])
def test_links_equal_all_pairs_also_in_crowded_buckets(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(3)
    fps = set()
    for center in rng.integers(0, 1 << 63, 6).tolist() + [0, (1 << 64) - 1]:
        for _ in range(40):
            f = center
            for b in rng.choice(64, rng.integers(0, 4), replace=False).tolist():
                f ^= 1 << b
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).distinct().collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert got == want and len(want) > 100


def joined_by_sorting(df):
    """The sort-merge joins of a plan in which no exploded rows are broadcast."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i in (i for i, line in enumerate(plan) if "BroadcastExchange" in line):
        below = next((j for j in range(i + 1, len(plan)) if depth(plan[j]) <= depth(plan[i])), len(plan))
        assert not any("Generate" in line for line in plan[i:below])
    return sum("SortMergeJoin" in line for line in plan)


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 3])
def test_exploded_rows_are_not_broadcast(spark, monkeypatch, tmp_path, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    spark.createDataFrame([(f << 40 | 1 << b,) for f in range(1, 5) for b in range(30)], "fp long").write.parquet(str(tmp_path / "fps"))
    found = simhash.links(spark.read.parquet(str(tmp_path / "fps")))
    assert found.count() > 100
    assert joined_by_sorting(found) == (2 if crowded == 3 else 1)


def test_pipeline_step_broadcasts_no_exploded_rows(spark, monkeypatch):
    seen, fold = [], simhash.fold_components
    monkeypatch.setattr(simhash, "fold_components", lambda edges, name: seen.append(edges) or fold(edges, name))
    docs = documents(spark)
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert Counter(r.doc_id for r in got) == Counter({c for _, _, c in plain_components([(i, plain_fingerprint(t)) for i, t in ROWS])})
    assert [joined_by_sorting(edges) for edges in seen] == [1]


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(500, 560)] + [(i, 200 + (i + 1 - 200) % 30) for i in range(200, 230)]
    got = {r.u: r.root for r in fold_components(spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 500 for i in (*range(501, 560), 1000)} | {i: 200 for i in range(201, 230)}
    assert fold_components(spark.createDataFrame([], "u long, v long"), "test").collect() == []


def test_long_texts_are_read_whole():
    assert simhash.fingerprint(LONG) == plain_fingerprint(LONG) != plain_fingerprint(LONG[:10_000])
