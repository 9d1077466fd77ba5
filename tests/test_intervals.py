"""Interval join against a brute force; its plan on a hot key."""

import random
from datetime import date, timedelta

import pytest

from hearthlake.operators.intervals import interval_left_join

D0 = date(2020, 1, 1)


def plain(days, periods):
    out = []
    for k, d, v in days:
        held = [p for p in periods if k is not None and p[0] == k and d is not None
                and (p[1] is None or p[1] <= d) and (p[2] is None or d <= p[2])]
        out += [(k, d, v, *p[1:]) for p in held] or [(k, d, v, None, None, None)]
    return sorted(out, key=str)


def frames(spark, days, periods):
    return (spark.createDataFrame(days, "store string, day date, v int"),
            spark.createDataFrame(periods, "store string, first date, last date, score int"))


@pytest.mark.parametrize("bin_days", [1, 7, 28])
def test_equals_brute_force(spark, bin_days):
    rng = random.Random(bin_days)
    day = lambda: D0 + timedelta(days=rng.randrange(200))
    days = [(rng.choice(["a", "b", "c", None]), rng.choice([day(), day(), day(), None]), i) for i in range(200)]
    days += days[:10]
    periods = [(rng.choice(["a", "b", None]), rng.choice([day(), day(), None]), rng.choice([day(), day(), None]), i)
               for i in range(40)] + [("a", D0 - timedelta(days=9999), D0 + timedelta(days=9999), 99)]
    got = interval_left_join(*frames(spark, days, periods), "store", "day", "first", "last", bin_days)
    assert got.columns == ["store", "day", "v", "first", "last", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(days, periods)


def test_empty_tables(spark):
    days, periods = [("a", D0, 1)], [("a", D0, D0, 1)]
    assert interval_left_join(*frames(spark, [], periods), "store", "day", "first", "last").count() == 0
    assert interval_left_join(*frames(spark, days, []), "store", "day", "first", "last").collect()[0].score is None


def test_hot_store_is_split_without_a_nested_loop(spark, capsys):
    """One store holds most of the days: the partition of its bin is split."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        days = spark.range(0, 60_000, 1, 12).select(
            F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("store"),
            F.date_add(F.lit(D0), (F.col("id") % 20).cast("int")).alias("day"), F.xxhash64("id").alias("v"))
        periods = spark.createDataFrame([("hot", D0, None, 1), ("hot", None, D0 + timedelta(days=9), 2), ("s1", D0, D0, 3)],
                                        "store string, first date, last date, score int")
        joined = interval_left_join(days, periods, "store", "day", "first", "last")
        assert joined.count() == 60_000 + days.where("store = 'hot' and day <= '2020-01-10'").count()
        joined.collect()
        joined.explain()
        plan = capsys.readouterr().out
        assert "skew=true" in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
