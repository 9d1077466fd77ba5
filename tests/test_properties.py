"""Whole-table properties on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hearthlake.operators.forecast.features import forecast_frames
from hearthlake.plans.queries import graph


def test_daily_revenue_sums_to_silver_total(spark):
    g = graph(spark, SF_SMALL)
    daily = g["gold_daily_franchise_health"].agg(F.sum("total_daily_revenue"), F.sum("total_items_sold")).first()
    silver = g["silver_pos_transactions"].agg(F.sum("total_price"), F.sum("quantity")).first()
    assert daily[0] == silver[0] and daily[1] == silver[1]


def test_supplier_split_is_complete(spark):
    g = graph(spark, SF_SMALL)
    assert (g["silver_supply_chain"].count() + g["silver_supply_chain_quarantine"].count()
            == g["bronze_supply_chain"].count())


def test_panel_rows_equal_stores_times_days(spark):
    g = graph(spark, SF_SMALL)
    daily = g["gold_daily_franchise_health"]
    frames = forecast_frames(daily)
    bounds = daily.agg(F.min("reporting_date").alias("a"), F.max("reporting_date").alias("b")).first()
    days = (bounds["b"] - bounds["a"]).days + 1
    stores = daily.select("store_id").distinct().count()
    panel = frames.panel
    assert panel.count() == stores * days
    assert panel.select("store_id", "reporting_date").distinct().count() == stores * days
    # observed revenue survives densification unchanged; the rest is zero
    total = panel.agg(F.sum("total_daily_revenue")).first()[0]
    assert total == daily.agg(F.sum("total_daily_revenue")).first()[0]


def test_every_transacting_customer_has_one_360_row(spark):
    g = graph(spark, SF_SMALL)
    c360 = g["gold_customer_360"]
    customers = g["silver_pos_transactions"].select("customer_id").distinct().count()
    assert c360.count() == customers == c360.select("customer_id").distinct().count()
