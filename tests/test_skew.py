"""Hot keys: one transaction id, one customer and one store each hold about a
third of the rows. Results must equal a brute-force computation."""

import contextlib
import io
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from builders import customer, sources, store, supplier, tx
from conftest import SF_SMALL
from hearthlake.plans.medallion import Medallion
from hearthlake.plans.queries import graph


def make_rows(n=3000, seed=7):
    rng = random.Random(seed)
    t0 = datetime(2024, 5, 1)
    rows = []
    for i in range(n):
        kind = i % 3
        tid = "HOT" if kind == 0 else f"t{i}"                 # a third of the rows share one id
        cust = 1 if kind == 1 else rng.randint(2, 40)         # a third belong to customer 1
        st = 1 if kind == 2 else rng.randint(2, 6)            # a third go to store 1
        qty = rng.choice([0, 1, 2, 3])
        ts = t0 + timedelta(minutes=rng.randint(0, 60 * 24 * 20))
        product = rng.choice(["bun", "scone", "loaf", "tart"])
        total = None if rng.random() < 0.1 else f"{rng.randint(1, 5000) / 100:.2f}"
        rows.append(tx(tid, ts, qty=qty, unit=f"{rng.randint(50, 500) / 100:.2f}", total=total, cust=cust,
                       store_id=st, product=product))
    return rows


def brute_force(rows, customers=None, stores=None):
    """Latest row per id -> validity -> FK (against the given key sets, if any)."""
    def key(r):  # timestamp DESC, then the other columns DESC, NULLs last
        tid, ts, product, qty, unit, total, cust, st = r[:8]
        filled = total if total is not None else (Decimal(qty) * unit).quantize(Decimal("0.01"))
        return (ts, product, qty, unit, filled, str(cust), str(st))
    latest = {}
    for r in rows:
        k = key(r)
        if r[0] not in latest or k > latest[r[0]][0]:
            latest[r[0]] = (k, r)
    silver = [(tid, k) for tid, (k, r) in latest.items() if k[2] > 0 and k[3] > 0
              and (customers is None or k[5] in customers) and (stores is None or k[6] in stores)]
    daily = defaultdict(lambda: [Decimal(0), 0, 0])
    spend = defaultdict(Decimal)
    products = defaultdict(Counter)
    for tid, (ts, product, qty, unit, total, cust, st) in silver:
        d = daily[(st, ts.date())]
        d[0] += total
        d[1] += qty
        d[2] += 1
        spend[cust] += total
        products[cust][product] += 1

    def avg2(total, n):
        wide = (total / n).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        return wide.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    daily_rows = {(st, day): (v[0], v[1], avg2(v[0], v[2])) for (st, day), v in daily.items()}
    top = {c: sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[0][0] for c, cnt in products.items()}
    return {tid for tid, _ in silver}, daily_rows, dict(spend), top


def test_hot_keys_match_brute_force(spark):
    rows = make_rows()
    g = Medallion(sources(spark, customers=[customer(i) for i in range(1, 41)],
                          franchises=[store(i) for i in range(1, 7)], suppliers=[supplier(1)], transactions=rows))
    ids, daily, spend, top = brute_force(rows)
    assert {r.transaction_id for r in g["silver_pos_transactions"].collect()} == ids
    got_daily = {(r.store_id, r.reporting_date): (r.total_daily_revenue, r.total_items_sold, r.avg_transaction_value)
                 for r in g["gold_daily_franchise_health"].collect()}
    assert got_daily == daily
    c360 = {r.customer_id: r for r in g["gold_customer_360"].collect()}
    assert {c: r.total_lifetime_spend for c, r in c360.items()} == spend
    assert {c: r.most_frequent_product for c, r in c360.items()} == top


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextlib.contextmanager
def conf(spark, values):
    saved = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Final Plan ==")[1].split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name,splits", [("silver_pos_transactions", 2), ("gold_customer_360", 2),
                                         ("silver_test_foundation_quality", 2), ("gold_test_customer_360_quality", 2)])
def test_sort_merge_fallback_splits_hot_partitions(spark, name, splits):
    """With broadcasts disabled (dimensions too large to broadcast), the FK
    semi joins fall back to sort-merge joins and AQE splits the partitions of
    the hot customer and the hot store, also below the aggregates of gold and
    checks; results stay the brute-force ones."""
    with conf(spark, NO_BROADCAST):
        rows = make_rows(n=30000)
        g = Medallion(sources(spark, customers=[customer(i) for i in range(1, 41)],
                              franchises=[store(i) for i in range(1, 7)], suppliers=[supplier(1)], transactions=rows))
        df = g[name]
        got = df.collect()
        final = final_plan(df)
    semi = [line for line in final.splitlines() if "SortMergeJoin" in line and "LeftSemi" in line]
    assert len(semi) >= splits and all("skew=true" in line for line in semi), semi
    assert "AQEShuffleRead skewed" in final
    ids, _, spend, top = brute_force(rows)
    if name == "silver_pos_transactions":
        assert {r.transaction_id for r in got} == ids
    elif name == "gold_customer_360":
        assert {r.customer_id: r.total_lifetime_spend for r in got} == spend
        assert {r.customer_id: r.most_frequent_product for r in got} == top
    else:
        failed = {r.test_name: r.failed_records for r in got}
        assert failed.get("invalid_customer_fk_in_transactions", 0) == failed.get("invalid_store_fk_in_transactions", 0) == 0
        assert failed.get("spend_mismatch_vs_silver", 0) == 0


def test_customer_360_curates_the_transactions_once(spark):
    """The dedup window runs once: the other branches reuse the base's shuffle."""
    with conf(spark, NO_BROADCAST):
        df = graph(spark, SF_SMALL)["gold_customer_360"]
        df.collect()
        assert len(re.findall(r"Window \[row_number\(\) windowspecdefinition\(transaction_id", final_plan(df))) == 1


def test_foreign_key_checks_count_every_bad_transaction(spark):
    from hearthlake.operators.quality import foundation_checks
    g = Medallion(sources(spark, customers=[customer(1), customer(1)], franchises=[store(1)], suppliers=[supplier(1)]))
    t = spark.createDataFrame([("a", "1", "1"), ("b", "1", "9"), ("c", "8", "1"), ("d", "8", "9"), ("d", None, "1")],
                              "transaction_id string, customer_id string, store_id string")
    got = {r.test_name: r.failed_records for r in foundation_checks(
        t, g["silver_customer_profiles"], g["silver_franchise_ops"], g["silver_supply_chain"],
        g["silver_supply_chain_quarantine"], g["silver_customer_reviews"], g["bronze_supply_chain"]).collect()}
    assert (got["duplicate_transaction_ids"], got["invalid_customer_fk_in_transactions"],
            got["invalid_store_fk_in_transactions"]) == (1, 3, 2)


def test_foreign_key_checks_hold_keys_not_pairs_of_keys(spark):
    """Ten customers each visit ten stores: 20 rows of counts, whatever the pairs; null keys count as bad."""
    from hearthlake.operators.quality import _key_counts
    rows = [(str(c), str(s)) for c in range(10) for s in range(10)] * 2 + [(None, "1"), (None, None), ("1", None)]
    t = spark.createDataFrame(rows, "customer_id string, store_id string")
    customers = spark.createDataFrame([(str(c),) for c in range(9)] + [("0",), (None,)], "customer_id string")
    stores = spark.createDataFrame([(str(s),) for s in range(8)], "store_id string")
    got = {(r._by_customer, r._key): (r._n, r._known is not None) for r in _key_counts(t, customers, stores).collect()}
    assert got == ({(True, str(c)): (21 if c == 1 else 20, c < 9) for c in range(10)}
                   | {(False, str(s)): (21 if s == 1 else 20, s < 8) for s in range(10)}
                   | {(True, None): (2, False), (False, None): (2, False)})


def test_supplier_serving_most_stores(spark):
    """One supplier serves two thirds of the stores; with broadcasts disabled
    the stores side is the streamed side of an inner join (splittable by AQE)
    and the per-supplier aggregation is partial. Counts and mean distances
    equal a direct computation."""
    import math

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stores = [store(i, supplier=1 if i % 3 else 2, lat=float(i % 50), lon=float(i % 90)) for i in range(1, 301)]
        g = Medallion(sources(spark, franchises=stores, suppliers=[supplier(1, lat=10.0, lon=20.0),
                                                                   supplier(2, lat=-5.0, lon=5.0), supplier(3)]))
        rows = {r.supplier_id: r for r in g["gold_supplier_risk_matrix"].collect()}

        def km(a, b, c, d):
            p1, p2 = math.radians(a), math.radians(c)
            h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
            return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))
        for sid, (lat, lon) in {"1": (10.0, 20.0), "2": (-5.0, 5.0)}.items():
            mine = [st for st in stores if str(st[5]) == sid]
            assert rows[sid].dependent_franchise_count == len(mine)
            expected = sum(km(lat, lon, st[6], st[7]) for st in mine) / len(mine)
            assert abs(rows[sid].avg_geographic_distance - expected) < 1e-6
        assert (rows["3"].dependent_franchise_count, rows["3"].avg_geographic_distance) == (0, 0.0)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
