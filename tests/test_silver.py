"""Curation rules: approval/quarantine, dedup -> validate -> FK, back-fill."""

from decimal import Decimal

from builders import customer, sources, store, supplier, tx
from hearthlake.plans.medallion import Medallion


def graph(spark, **kw):
    base = dict(customers=[customer(1), customer(2)], franchises=[store(1), store(2)], suppliers=[supplier(1)])
    base.update(kw)
    return Medallion(sources(spark, **base))


def test_approval_and_quarantine_cover_bronze(spark):
    g = graph(spark, suppliers=[supplier(1, approved="Y"), supplier(2, approved=" y "), supplier(3, approved="N"),
                                supplier(4, approved=None)])
    approved = sorted(r.supplier_id for r in g["silver_supply_chain"].collect())
    quarantined = sorted(r.supplier_id for r in g["silver_supply_chain_quarantine"].collect())
    assert approved == ["1", "2"]
    assert quarantined == ["3", "4"]  # NULL status is quarantined, not lost
    assert len(approved) + len(quarantined) == g["bronze_supply_chain"].count()
    assert all(r.is_approved for r in g["silver_supply_chain"].collect())


def test_latest_row_invalid_drops_the_id(spark):
    g = graph(spark, transactions=[tx("t1", "2024-05-13 10:00:00", qty=1), tx("t1", "2024-05-13 11:00:00", qty=0)])
    assert g["silver_pos_transactions"].count() == 0


def test_latest_valid_row_is_kept(spark):
    g = graph(spark, transactions=[tx("t1", "2024-05-13 10:00:00", qty=1), tx("t1", "2024-05-13 11:00:00", qty=2)])
    rows = g["silver_pos_transactions"].collect()
    assert [(r.transaction_id, r.quantity, r.transaction_timestamp.hour) for r in rows] == [("t1", 2, 11)]


def test_equal_timestamps_pick_a_deterministic_winner(spark):
    a = tx("t1", "2024-05-13 10:00:00", qty=1, product="bread")
    b = tx("t1", "2024-05-13 10:00:00", qty=3, product="bread")
    for order in ([a, b], [b, a]):
        rows = graph(spark, transactions=order)["silver_pos_transactions"].collect()
        assert [r.quantity for r in rows] == [3]


def test_total_back_filled_from_quantity_times_price(spark):
    g = graph(spark, transactions=[tx("t1", "2024-05-13 10:00:00", qty=3, unit="1.25", total=None)])
    assert [r.total_price for r in g["silver_pos_transactions"].collect()] == [Decimal("3.75")]


def test_unknown_foreign_keys_and_null_ids_are_dropped(spark):
    g = graph(spark, transactions=[
        tx("ok", "2024-05-13 10:00:00"),
        tx("badcust", "2024-05-13 10:00:00", cust=99),
        tx("badstore", "2024-05-13 10:00:00", store_id=99),
        tx(None, "2024-05-13 10:00:00"),
        tx("zero_price", "2024-05-13 10:00:00", unit="0.00"),
    ])
    assert [r.transaction_id for r in g["silver_pos_transactions"].collect()] == ["ok"]


def test_duplicate_dimension_keys_do_not_multiply_transactions(spark):
    g = graph(spark, customers=[customer(1), customer(1)], transactions=[tx("t1", "2024-05-13 10:00:00")])
    assert g["silver_pos_transactions"].count() == 1


def test_customer_curation(spark):
    g = graph(spark, customers=[customer(1, email="Ann@X.com", phone="555-123-4567", country=" usa ",
                                         continent="northamerica")])
    r = g["silver_customer_profiles"].first()
    assert (r.masked_email, r.masked_phone, r.masked_address) == ("a***@x.com", "555-123-4****67", "1 Main***")
    assert (r.normalized_country, r.normalized_continent) == ("United States", "North America")


def test_original_quarantine_rule_drops_null_status(spark):
    from hearthlake.plans.medallion import Medallion
    from builders import sources as make_sources
    g = Medallion(make_sources(spark, suppliers=[supplier(1, approved="N"), supplier(2, approved=None)]),
                  quarantine_null_status=False)
    assert [r.supplier_id for r in g["silver_supply_chain_quarantine"].collect()] == ["1"]
