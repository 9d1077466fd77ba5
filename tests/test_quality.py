"""Embedded checks: zero on clean input, non-zero on planted defects."""

from decimal import Decimal

from builders import customer, review, sources, store, supplier, tx
from hearthlake.operators import quality
from hearthlake.plans.medallion import Medallion


def report(df):
    rows = df.collect()
    assert all(r.test_passed == (r.failed_records == 0) for r in rows)
    assert all(r.validated_at is not None for r in rows)
    return {r.test_name: r.failed_records for r in rows}


def clean_graph(spark):
    return Medallion(sources(
        spark, customers=[customer(1), customer(2)], franchises=[store(1), store(2)],
        suppliers=[supplier(1), supplier(2, approved="N")],
        transactions=[tx("a", "2024-05-13 10:00:00"), tx("b", "2024-05-14 10:00:00", cust=2, store_id=2)],
        reviews=[review(1, "Great bread."), review(2, "Fine!")]))


CHECK_SETS = {
    "silver_test_foundation_quality": 8, "gold_test_daily_franchise_health_quality": 3,
    "gold_test_customer_360_quality": 4, "gold_test_supplier_risk_quality": 4,
    "gold_test_sentiment_trends_quality": 3, "gold_test_scorecard_quality": 3, "silver_test_contract_quality": 5,
}


def test_all_checks_pass_on_clean_input(spark):
    g = clean_graph(spark)
    for name, n in CHECK_SETS.items():
        got = report(g[name])
        assert len(got) == n, name
        assert all(v == 0 for v in got.values()), (name, got)


def test_foundation_checks_surface_planted_defects(spark):
    g = Medallion(sources(
        spark, customers=[customer(1, email="no-at-sign", phone="12")], franchises=[store(1)],
        suppliers=[supplier(1)], transactions=[tx("a", "2024-05-13 10:00:00")],
        reviews=[review(1, "!!!"), review(2, None)]))
    got = report(g["silver_test_foundation_quality"])
    assert got["unmasked_email_patterns"] == 1
    assert got["unmasked_phone_patterns"] == 1
    assert got["reviews_without_chunks"] == 2
    assert got["duplicate_transaction_ids"] == 0


def test_fk_and_duplicate_checks_on_bad_frames(spark):
    g = clean_graph(spark)
    bad_tx = g["silver_pos_transactions"].unionByName(g["silver_pos_transactions"].limit(1))
    bad_tx = bad_tx.unionByName(bad_tx.limit(1).selectExpr("'z' AS transaction_id", "transaction_timestamp",
                                                           "product_sold", "quantity", "unit_price", "total_price",
                                                           "'99' AS customer_id", "'98' AS store_id"))
    got = report(quality.foundation_checks(bad_tx, g["silver_customer_profiles"], g["silver_franchise_ops"],
                                           g["silver_supply_chain"], g["silver_supply_chain_quarantine"],
                                           g["silver_customer_reviews"], g["bronze_supply_chain"]))
    assert got["duplicate_transaction_ids"] == 1
    assert got["invalid_customer_fk_in_transactions"] == 1
    assert got["invalid_store_fk_in_transactions"] == 1


def test_reconciliation_checks_catch_stale_gold(spark):
    from pyspark.sql import functions as F
    g = clean_graph(spark)
    stale = g["gold_daily_franchise_health"].withColumn(
        "total_daily_revenue", F.col("total_daily_revenue") + F.lit(Decimal("1.00")))
    assert report(quality.daily_health_checks(stale, g["silver_pos_transactions"]))[
        "aggregation_mismatch_vs_silver"] == 2
    c360 = g["gold_customer_360"].where("customer_id = '1'")
    got = report(quality.customer_360_checks(c360, g["silver_pos_transactions"]))
    assert got["spend_mismatch_vs_silver"] == 1


def test_scorecard_and_sentiment_checks(spark):
    from pyspark.sql import functions as F
    g = clean_graph(spark)
    short = g["gold_store_scorecard"].limit(1)
    assert report(quality.scorecard_checks(short, g["gold_daily_franchise_health"]))[
        "scorecard_row_count_matches_daily_health"] == 1
    bad = g["gold_store_sentiment_trends"].withColumn("reporting_period_end", F.col("reporting_period_start"))
    assert report(quality.sentiment_checks(bad))["invalid_reporting_period_span"] == 1
    risk = g["gold_supplier_risk_matrix"].withColumn("ingredient_criticality_score", F.lit(4))
    got = report(quality.supplier_risk_checks(risk.limit(0), g["silver_supply_chain"]))
    assert got["missing_suppliers_in_risk_matrix"] == 1
    assert report(quality.supplier_risk_checks(risk, g["silver_supply_chain"]))["criticality_out_of_range"] == 1


def test_contract_checks_surface_planted_defects(spark):
    g = Medallion(sources(
        spark, customers=[customer(1), customer(1)], franchises=[store(1), store(1), store(2)],
        suppliers=[supplier(1), supplier(1), supplier(2, approved=None)],
        transactions=[tx("a", "2024-05-13 10:00:00")]))
    bad_source = g.sources.transactions.selectExpr(
        "transactionID", "dateTime", "'many' AS quantity", "unitPrice", "totalPrice", "customerID", "franchiseID",
        "cardNumber")
    got = report(quality.contract_checks(bad_source, g["bronze_supply_chain"], g["silver_supply_chain"],
                                         g["silver_supply_chain_quarantine"], g["silver_customer_profiles"],
                                         g["silver_franchise_ops"]))
    assert got["duplicate_customer_ids"] == 1
    assert got["duplicate_store_ids"] == 1
    assert got["duplicate_supplier_ids"] == 1
    assert got["transaction_cast_failures"] == 1
    assert got["suppliers_neither_approved_nor_quarantined"] == 0  # the NULL status went to quarantine
    lost = report(quality.contract_checks(g.sources.transactions, g["bronze_supply_chain"],
                                          g["silver_supply_chain"].limit(1), g["silver_supply_chain_quarantine"],
                                          g["silver_customer_profiles"], g["silver_franchise_ops"]))
    assert lost["suppliers_neither_approved_nor_quarantined"] == 1


def test_customer_360_checks_count_like_a_full_outer_join(spark):
    """Duplicates, null ids, missing and extra customers, equal and different spends, null spends."""
    from decimal import Decimal
    money = lambda x: None if x is None else Decimal(str(x))
    c360 = [("a", 10, "s", "p"), ("a", 10, "s", "p"), ("a", 11, None, "p"), ("b", 5, "s", None), ("c", None, "s", "p"),
            (None, 3, "s", "p"), (None, 3, None, None), ("e", 1, "s", "p"), ("f", 0, "s", "p")]
    tx = [("a", 4), ("a", 6), ("b", 6), ("c", None), (None, 3), ("d", 2), ("f", 0), ("g", None)]
    got = report(quality.customer_360_checks(
        spark.createDataFrame([(c, money(s), x, y) for c, s, x, y in c360],
                              "customer_id string, total_lifetime_spend decimal(23,2), preferred_store_location string, "
                              "most_frequent_product string"),
        spark.createDataFrame([(c, money(v)) for c, v in tx], "customer_id string, total_price decimal(12,2)")))
    spend = {}
    for c, v in tx:
        known = [x for x in (spend.get(c), v) if x is not None]
        spend[c] = sum(known) if known else None
    mismatch = sum(c is None or c not in spend or spend[c] != s for c, s, _, _ in c360)
    mismatch += sum(c is None or c not in {r[0] for r in c360} for c in spend)
    ids = [r[0] for r in c360]
    assert {k: v[0] if isinstance(v, tuple) else v for k, v in got.items()} == {
        "duplicate_customer_rows": sum(ids.count(c) > 1 for c in set(ids)), "null_customer_id": ids.count(None),
        "null_preference_fields_for_transacting_customers": sum(x is None or y is None for _, _, x, y in c360),
        "spend_mismatch_vs_silver": mismatch}
