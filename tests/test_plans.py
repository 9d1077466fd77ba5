"""Physical-plan properties of the registered queries (read from explain)."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from __spark_entry__ import TUNED
from hearthlake import params
from hearthlake.plans.queries import registry

# the recursion writes its state at every step, so its plan starts from files
SQL_KEYS = [k for k in registry() if k != "forecast_recursion_mean7"]


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def query(spark, key):
    grid = (params.SMALL_CANDIDATES,) if key in TUNED else ()  # the plan is the same for any grid
    return registry()[key](spark, SF_SMALL, *grid)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_no_python_udfs_and_no_cartesian_joins(spark, key):
    text = plan_text(query(spark, key))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, (key, bad)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_no_rows_are_dealt_round_robin(spark, key):
    assert "RoundRobinPartitioning" not in plan_text(query(spark, key)), key


def test_dedup_limits_each_id_before_the_shuffle(spark):
    text = plan_text(registry()["silver_transactions"](spark, SF_SMALL), mode="simple")
    physical = text.split("== Physical Plan ==")[-1]
    # partial WindowGroupLimit below the transaction_id exchange, final one above it
    assert physical.count("WindowGroupLimit") >= 2
    exchange = physical.index("Exchange hashpartitioning(transaction_id")
    assert "WindowGroupLimit" in physical[exchange:]


def test_daily_health_prunes_lineitem_columns(spark):
    text = plan_text(registry()["gold_daily_store_health"](spark, SF_SMALL))
    line = next(ln for ln in text.splitlines() if "ReadSchema: struct<l_orderkey" in ln)
    for unused in ("l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in line


def test_aggregations_are_partial_before_shuffle(spark):
    text = plan_text(registry()["gold_daily_store_health"](spark, SF_SMALL), mode="simple")
    assert "partial_sum(total_price" in text and "partial_avg(total_price" in text


def test_panel_is_shuffled_once_by_store(spark):
    """Calendar + observed rows meet in one exchange keyed by store and slice; both
    window passes (dedup of covered days, features) reuse it."""
    text = plan_text(registry()["forecast_panel_features"](spark, SF_SMALL), mode="simple")
    physical = text.split("== Physical Plan ==")[-1]
    by_store = re.findall(r"Exchange hashpartitioning\(store_id#\d+, \d+\)", physical)
    by_slice = re.findall(r"Exchange hashpartitioning\(store_id#\d+, _slice#\d+, \d+\)", physical)
    # one for the distinct store list that seeds the calendar, one for the panel itself, by store and slice
    assert len(by_store) == 1 and len(by_slice) == 1
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_scorecard_days_are_not_shuffled_for_their_stores(spark, monkeypatch):
    """The per-store frame goes to the days, however large Spark estimates it; beyond ``BROADCAST_STORES`` the
    days are shuffled once more, for the same rows."""
    from hearthlake.operators import gold
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = []
        for most in (gold.BROADCAST_STORES, 0):
            monkeypatch.setattr(gold, "BROADCAST_STORES", most)
            frames.append(registry()["gold_store_scorecard"](spark, SF_SMALL))
        small, large = ([line for line in plan_text(df, mode="simple").splitlines() if "BroadcastHashJoin [store_id" in line]
                        for df in frames)
        assert len(small) == 1 and "LeftOuter, BuildRight" in small[0] and not large
        assert sorted(map(tuple, frames[0].collect())) == sorted(map(tuple, frames[1].collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_stored_with_zstd(spark, tmp_path):
    from hearthlake.sources.sinks import write_table
    write_table(spark.range(10), "zstd_rows", path=str(tmp_path / "rows"))
    try:
        assert spark.table("zstd_rows").count() == 10
        assert all(f.endswith(".zstd.parquet") for f in (p.name for p in (tmp_path / "rows").glob("*.parquet")))
        assert list((tmp_path / "rows").glob("*.zstd.parquet"))
    finally:
        spark.sql("DROP TABLE zstd_rows")
