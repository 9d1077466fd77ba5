"""Refresh in buckets of customers: same rows, and transactions read in place."""

import contextlib
import io

from builders import customer, sources, store, supplier
from conftest import SF_SMALL
from hearthlake.operators import gold
from hearthlake.plans.medallion import Medallion
from hearthlake.plans.queries import graph
from test_skew import make_rows

NAMES = ["silver_pos_transactions", "gold_customer_360"]


def bucket_columns(spark, table):
    return [c.name for c in spark.catalog.listColumns(table) if c.isBucket]


def test_bucketed_refresh_needs_no_shuffle_of_the_transactions(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_test LOCATION '{tmp_path / 'db'}'")
    g, lazy = graph(spark, SF_SMALL), graph(spark, SF_SMALL)
    g.refresh(spark, database="bucket_test", names=NAMES, buckets=4)
    assert {t.name for t in spark.catalog.listTables("bucket_test") if not t.isTemporary} == set(NAMES)
    assert sorted(x.name for x in (tmp_path / "db").iterdir() if x.is_dir()) == sorted(NAMES)
    for name in NAMES:
        assert bucket_columns(spark, f"bucket_test.{name}") == ["customer_id"]
        a, b = spark.table(f"bucket_test.{name}"), lazy[name]
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
    spend = gold.customer_360(spark.table("bucket_test.silver_pos_transactions"), lazy["silver_franchise_ops"]).select(
        "customer_id", "total_lifetime_spend")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        spark.table("bucket_test.silver_pos_transactions").groupBy("customer_id", "store_id", "product_sold").count().explain()
    assert "Bucketed: true" in out.getvalue() or "SelectedBucketsCount" in out.getvalue()
    assert "Exchange" not in out.getvalue()
    assert spend.count() == lazy["gold_customer_360"].count()
    spark.sql("DROP DATABASE bucket_test CASCADE")


def test_a_hot_customer_is_not_stored_in_a_bucket(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hot_test LOCATION '{tmp_path / 'db'}'")
    g = Medallion(sources(spark, customers=[customer(i) for i in range(1, 41)], franchises=[store(i) for i in range(1, 7)],
                          suppliers=[supplier(1)], transactions=make_rows(), reviews=[]))
    g.refresh(spark, database="hot_test", names=NAMES, buckets=4)
    assert bucket_columns(spark, "hot_test.silver_pos_transactions") == []
    assert bucket_columns(spark, "hot_test.gold_customer_360") == ["customer_id"]
    spark.sql("DROP DATABASE hot_test CASCADE")
