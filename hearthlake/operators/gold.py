"""Gold layer (P12-P16): business datasets."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake import params
from hearthlake.functions import day_of, haversine_km, lexicon_score, week_start
from hearthlake.operators.intervals import interval_left_join

BROADCAST_STORES = 1_000_000  # stores whose attributes are broadcast, about 100 bytes each


def daily_store_health(transactions: DataFrame) -> DataFrame:
    """Revenue, items and mean ticket per (store, UTC day).

    Partial aggregation runs before the shuffle, so a store with a huge
    share of the transactions sends one row per day per map task.
    """
    return (transactions
            .groupBy("store_id", day_of("transaction_timestamp").alias("reporting_date"))
            .agg(F.round(F.sum("total_price"), 2).alias("total_daily_revenue"),
                 F.sum("quantity").alias("total_items_sold"),
                 F.round(F.avg("total_price"), 2).alias("avg_transaction_value")))


def _top_per_customer(counts: DataFrame, value: str, out: str) -> DataFrame:
    """Most frequent ``value`` per customer; ties go to the smallest value.

    ``rn = 1`` becomes a WindowGroupLimit on both sides of the shuffle.
    """
    w = Window.partitionBy("customer_id").orderBy(F.col("_n").desc(), F.col(value).asc())
    return (counts.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select("customer_id", F.col(value).alias(out)))


def customer_360(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Lifetime spend, preferred store (by name) and preferred product.

    Store preference counts visits per store *name* (same-named stores are
    merged, as in the original definition); customers whose transactions
    have no known store get a NULL preference. All three read one base of
    sums and counts per (customer, store, product), so the transactions are
    curated once and a hot customer is reduced before the preferences.
    """
    base = (transactions.groupBy("customer_id", "store_id", "product_sold")
            # one column for both sums: a branch that needs one of them still plans the same base
            .agg(F.array(F.sum("total_price").cast("decimal(30,2)"), F.count(F.lit(1)).cast("decimal(30,2)")).alias("_sums")))
    n = F.sum(F.col("_sums")[1]).alias("_n")
    spend = (base.groupBy("customer_id")
             .agg(F.round(F.sum(F.col("_sums")[0]), 2).cast("decimal(23,2)").alias("total_lifetime_spend")))
    store_counts = (base.select("customer_id", "store_id", "_sums")
                    .join(stores.select("store_id", "store_name"), "store_id")
                    .groupBy("customer_id", "store_name").agg(n))
    product_counts = base.groupBy("customer_id", "product_sold").agg(n)
    return (spend
            .join(_top_per_customer(store_counts, "store_name", "preferred_store_location"), "customer_id", "left")
            .join(_top_per_customer(product_counts, "product_sold", "most_frequent_product"), "customer_id", "left")
            .select("customer_id", "total_lifetime_spend", "preferred_store_location", "most_frequent_product"))


def ingredient_criticality(ingredient) -> F.Column:
    key = F.lower(F.col(ingredient) if isinstance(ingredient, str) else ingredient)
    return (F.when(key.isin(*params.CRITICAL_INGREDIENTS), F.lit(params.CRITICAL_SCORE))
            .when(key.isin(*params.IMPORTANT_INGREDIENTS), F.lit(params.IMPORTANT_SCORE))
            .otherwise(F.lit(params.DEFAULT_CRITICALITY)))


def supplier_risk(suppliers: DataFrame, stores: DataFrame) -> DataFrame:
    """Dependants, mean store distance, ingredient criticality, flag.

    Stores are joined *to* the supplier coordinates (inner join, stores as
    the streamed side), then aggregated per supplier, and only the small
    per-supplier result is left-joined back to the suppliers. A supplier
    serving a large share of all stores is therefore split by AQE's skew
    handling or by the partial aggregation; the plain
    ``suppliers LEFT JOIN stores`` would put all its stores on the build
    side of one task. ``count(DISTINCT store)`` runs as a two-level
    aggregation keyed by (supplier, store) first. Suppliers without stores
    get 0 dependants and distance 0.0.
    """
    s = suppliers.select(F.col("supplier_id").alias("_sid"), F.col("latitude").alias("_s_lat"),
                         F.col("longitude").alias("_s_lon"))
    f = stores.select("store_id", "primary_supplier_id", F.col("latitude").alias("_f_lat"),
                      F.col("longitude").alias("_f_lon"))
    deps = (f.join(s, f.primary_supplier_id == s._sid)
            .groupBy(F.col("_sid").alias("supplier_id"))
            .agg(F.count_distinct("store_id").alias("_n"),
                 F.avg(haversine_km("_s_lat", "_s_lon", "_f_lat", "_f_lon")).alias("_km")))
    n = F.coalesce(F.col("_n"), F.lit(0))
    km = F.coalesce(F.col("_km"), F.lit(0.0))
    crit = F.col("ingredient_criticality_score")
    flag = (((n >= params.MANY_DEPENDANTS) & ((km >= params.FAR_DISTANCE_KM) | (crit >= params.CRITICAL_SCORE)))
            | ((n >= 1) & (crit >= params.CRITICAL_SCORE)))
    return (suppliers.select("supplier_id",
                             ingredient_criticality("provided_ingredients").alias("ingredient_criticality_score"))
            .join(deps, "supplier_id", "left")
            .select("supplier_id", n.alias("dependent_franchise_count"), km.alias("avg_geographic_distance"),
                    crit, F.coalesce(flag, F.lit(False)).alias("is_high_risk_flag")))


def weekly_sentiment(reviews: DataFrame, positive=params.POSITIVE_WORDS, negative=params.NEGATIVE_WORDS) -> DataFrame:
    """Mean chunk score per (store, Monday-Sunday week), 4 decimals.

    ``explode_outer`` + dropping the NULL chunk equals ``explode`` here, but
    keeps Spark from inferring a ``size(chunks) > 0`` filter that it would
    push below the projection, evaluating the whole text cleaning and
    chunking twice per review.
    """
    chunks = (reviews.select(
        "store_id",
        week_start("submission_date").alias("reporting_period_start"),
        F.explode_outer("chunked_review_text").alias("_chunk"),
    ).where(F.col("_chunk").isNotNull()))
    scored = chunks.select("store_id", "reporting_period_start",
                           lexicon_score("_chunk", positive, negative).alias("_score"))
    return (scored.groupBy("store_id", "reporting_period_start")
            .agg(F.round(F.avg("_score"), 4).alias("customer_satisfaction_score"))
            .select("store_id", "reporting_period_start",
                    F.date_add("reporting_period_start", 6).alias("reporting_period_end"),
                    "customer_satisfaction_score"))


def store_scorecard(daily: DataFrame, stores: DataFrame, sentiment: DataFrame, customers_360: DataFrame,
                    risk: DataFrame) -> DataFrame:
    """Daily health with store name, week sentiment, customer rollup, risk alert.

    All store-level attributes are joined into one per-store frame first, so
    the large (store, day) side meets two joins: per store, and per
    (store, week). Spark learns the size of the per-store frame only after the
    customers are rolled up, and has shuffled all (store, day) rows by then;
    so the stores are counted first, and up to ``BROADCAST_STORES`` of them are
    sent to the days. The week join is an equi-join on the Monday of the day's
    week, which is exactly the day-in-period condition because every
    sentiment period is one Monday-Sunday week.

    Stores whose supplier is quarantined have no risk row and get
    ``supply_risk_alert = false``; missing sentiment reads as 0.0.
    """
    rollup = (customers_360.groupBy(F.col("preferred_store_location").alias("store_name"))
              .agg(F.count(F.lit(1)).alias("active_customer_count"),
                   F.avg("total_lifetime_spend").alias("_avg_spend")))
    risk_by_store = (stores.select("store_id", "primary_supplier_id")
                     .join(risk.select("supplier_id", "is_high_risk_flag"),
                           F.col("primary_supplier_id") == F.col("supplier_id"), "left")
                     .groupBy("store_id")
                     .agg(F.max(F.when(F.col("is_high_risk_flag"), 1).otherwise(0)).alias("_risk")))
    store_level = (stores.select("store_id", "store_name")
                   .join(rollup, "store_name", "left")
                   .join(risk_by_store, "store_id", "left"))
    if stores.count() <= BROADCAST_STORES:
        store_level = F.broadcast(store_level)
    week = sentiment.select("store_id", F.col("reporting_period_start").alias("_week"),
                            "customer_satisfaction_score")
    return (daily.withColumn("_week", week_start("reporting_date"))
            .join(store_level, "store_id", "left")
            .join(week, ["store_id", "_week"], "left")
            .select("store_id", "store_name", "reporting_date", "total_daily_revenue", "total_items_sold",
                    "avg_transaction_value",
                    F.coalesce("customer_satisfaction_score", F.lit(Decimal("0.0"))).alias("weekly_sentiment_score"),
                    F.coalesce("active_customer_count", F.lit(0)).alias("active_customer_count"),
                    F.round(F.coalesce("_avg_spend", F.lit(Decimal("0.0"))), 2).alias("avg_lifetime_spend"),
                    (F.coalesce("_risk", F.lit(0)) == 1).alias("supply_risk_alert")))


def store_scorecard_by_period(daily: DataFrame, stores: DataFrame, periods: DataFrame) -> DataFrame:
    """Daily health with every rating period that holds the day: one row for each period, one with
    nulls for a day in none.

    ``periods`` has store_id, period_start, period_end, customer_satisfaction_score. Unlike the weeks of
    ``store_scorecard`` they may overlap, have any length and be open at either end (null).
    """
    joined = interval_left_join(daily, periods, "store_id", "reporting_date", "period_start", "period_end")
    return (joined.join(stores.select("store_id", "store_name"), "store_id", "left")
            .select("store_id", "store_name", "reporting_date", "total_daily_revenue", "total_items_sold",
                    "avg_transaction_value", "period_start", "period_end",
                    F.coalesce("customer_satisfaction_score", F.lit(Decimal("0.0"))).alias("period_sentiment_score")))


def rating_periods(sentiment: DataFrame, trailing_days: int = 30) -> DataFrame:
    """Each sentiment week as a period that stays valid for ``trailing_days`` more days, so periods
    overlap; the latest week of a store stays valid for good (open end)."""
    latest = Window.partitionBy("store_id")
    open_end = F.col("reporting_period_start") == F.max("reporting_period_start").over(latest)
    return sentiment.select(
        "store_id", F.col("reporting_period_start").alias("period_start"),
        F.when(~open_end, F.date_add("reporting_period_end", trailing_days)).alias("period_end"),
        "customer_satisfaction_score")


__all__ = ["daily_store_health", "customer_360", "supplier_risk", "weekly_sentiment", "store_scorecard",
           "store_scorecard_by_period", "rating_periods",
           "ingredient_criticality"]
