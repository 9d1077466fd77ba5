"""Business datasets on hand-made inputs."""

from datetime import date
from decimal import Decimal

import pytest

from builders import customer, review, sources, store, supplier, tx
from hearthlake.plans.medallion import Medallion


def test_daily_health_decimals_and_rounding(spark):
    g = Medallion(sources(spark, customers=[customer(1)], franchises=[store(1)], suppliers=[supplier(1)],
                          transactions=[tx("a", "2024-05-13 01:00:00", qty=1, unit="1.00", total="1.00"),
                                        tx("b", "2024-05-13 23:59:59", qty=2, unit="1.00", total="1.00"),
                                        tx("c", "2024-05-13 12:00:00", qty=3, unit="1.00", total="2.01"),
                                        tx("d", "2024-05-14 00:00:00", qty=4, unit="1.00", total="5.00")]))
    daily = g["gold_daily_franchise_health"]
    types = {f.name: f.dataType.simpleString() for f in daily.schema.fields}
    assert types["total_daily_revenue"] == "decimal(23,2)"
    assert types["total_items_sold"] == "bigint"
    assert types["avg_transaction_value"] == "decimal(13,2)"
    rows = sorted(tuple(r) for r in daily.collect())
    assert rows == [("1", date(2024, 5, 13), Decimal("4.01"), 6, Decimal("1.34")),
                    ("1", date(2024, 5, 14), Decimal("5.00"), 4, Decimal("5.00"))]


def test_customer_360_preferences_and_ties(spark):
    g = Medallion(sources(
        spark, customers=[customer(1), customer(2)],
        franchises=[store(1, name="A"), store(2, name="B"), store(3, name="B")], suppliers=[supplier(1)],
        transactions=[tx("1", "2024-05-13 10:00:00", store_id=2, product="scone", total="2.00"),
                      tx("2", "2024-05-13 10:00:00", store_id=1, product="bun", total="3.00"),
                      tx("3", "2024-05-13 10:00:00", store_id=1, product="scone", total="1.00"),
                      tx("4", "2024-05-13 10:00:00", store_id=2, product="bun", total="1.00"),
                      # customer 2: two same-named stores merge into one preference
                      tx("5", "2024-05-13 10:00:00", cust=2, store_id=2, total="1.00"),
                      tx("6", "2024-05-13 10:00:00", cust=2, store_id=3, total="1.00"),
                      tx("7", "2024-05-13 10:00:00", cust=2, store_id=1, total="1.00")]))
    rows = {r.customer_id: r for r in g["gold_customer_360"].collect()}
    assert rows["1"].total_lifetime_spend == Decimal("7.00")
    assert rows["1"].preferred_store_location == "A"  # 2 visits each: smallest name wins
    assert rows["1"].most_frequent_product == "bun"
    assert rows["2"].preferred_store_location == "B"


@pytest.mark.parametrize("n,km,crit,expected", [(1, 0.0, 5, True), (3, 5000.0, 2, True), (3, 4999.0, 3, False),
                                                (2, 9000.0, 3, False), (0, 0.0, 5, False)])
def test_risk_flag(spark, n, km, crit, expected):
    from pyspark.sql import functions as F
    from hearthlake import params
    df = spark.createDataFrame([(n, km, crit)], "n int, km double, crit int")
    nn, kk, cc = F.col("n"), F.col("km"), F.col("crit")
    flag = (((nn >= params.MANY_DEPENDANTS) & ((kk >= params.FAR_DISTANCE_KM) | (cc >= params.CRITICAL_SCORE)))
            | ((nn >= 1) & (cc >= params.CRITICAL_SCORE)))
    assert df.select(flag).first()[0] is expected


def test_supplier_risk_matrix(spark):
    far = [store(i, supplier=1, lat=0.0, lon=float(i)) for i in range(1, 4)]  # 3 stores, ~111-333 km
    g = Medallion(sources(spark, customers=[customer(1)],
                          franchises=far + [store(9, supplier=2, lat=0.0, lon=180.0), store(10, supplier=None)],
                          suppliers=[supplier(1, ingredient="Cacao"), supplier(2, ingredient="flour"),
                                     supplier(3, ingredient="almonds"), supplier(4, approved="N")]))
    rows = {r.supplier_id: r for r in g["gold_supplier_risk_matrix"].collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].dependent_franchise_count == 3 and rows["1"].ingredient_criticality_score == 5
    assert rows["1"].avg_geographic_distance == pytest.approx(2 * 111.19492664455873, rel=1e-9)
    assert rows["1"].is_high_risk_flag is True
    assert rows["2"].avg_geographic_distance == pytest.approx(20015.0868, abs=1e-3)
    assert rows["2"].is_high_risk_flag is False
    assert (rows["3"].dependent_franchise_count, rows["3"].avg_geographic_distance) == (0, 0.0)


def test_weekly_sentiment(spark):
    g = Medallion(sources(spark, reviews=[
        review(1, "Great bread! But slow... Really?", day=date(2024, 5, 13)),
        review(2, "Cold coffee.", day=date(2024, 5, 19)),
        review(3, "fine", day=date(2024, 5, 20)),
        review(4, None, day=date(2024, 5, 20)),
    ]))
    rows = sorted(tuple(r) for r in g["gold_store_sentiment_trends"].collect())
    # week of 05-13: chunks great bread (+1), but slow (-1), really (0), cold coffee (-1) -> -0.25
    assert rows == [("1", date(2024, 5, 13), date(2024, 5, 19), Decimal("-0.2500")),
                    ("1", date(2024, 5, 20), date(2024, 5, 26), Decimal("0.0000"))]


def test_scorecard_joins(spark):
    g = Medallion(sources(
        spark, customers=[customer(1), customer(2)],
        franchises=[store(1, name="A", supplier=1), store(2, name="B", supplier=2)],
        suppliers=[supplier(1, ingredient="Cacao"), supplier(2, ingredient="Cacao", approved="N")],
        transactions=[tx("1", "2024-05-13 10:00:00", store_id=1, total="10.00"),
                      tx("2", "2024-05-14 10:00:00", cust=2, store_id=2, total="4.00")],
        reviews=[review(1, "great", day=date(2024, 5, 19), store_id=1)]))
    rows = {r.store_id: r for r in g["gold_store_scorecard"].collect()}
    a, b = rows["1"], rows["2"]
    assert (a.store_name, a.weekly_sentiment_score, a.active_customer_count, a.avg_lifetime_spend) == (
        "A", Decimal("1.0000"), 1, Decimal("10.00"))
    assert a.supply_risk_alert is True
    # quarantined supplier -> no risk row -> no alert; no reviews -> 0.0
    assert (b.weekly_sentiment_score, b.supply_risk_alert) == (Decimal("0.0000"), False)
    assert g["gold_store_scorecard"].count() == g["gold_daily_franchise_health"].count()
