"""Registered queries: (spark, sf_dir) -> DataFrame, one per dataset operator.

Each query stages the five sources from the driver tables in ``sf_dir``
and builds the requested dataset through the lazy ``Medallion`` graph, so
every query runs over the whole tables. Columns that are not deterministic
(``_ingested_at``, ``validated_at``) are left out; float columns that are
compared across engines are rounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake import params
from hearthlake.functions import mask_pii
from hearthlake.plans.medallion import Medallion
from hearthlake.session import model_dir
from hearthlake.sources.staging import catalog_sources, stage_sources
from hearthlake.sources.tables import TableReader


def graph(spark: SparkSession, sf_dir: str) -> Medallion:
    return Medallion(stage_sources(TableReader(spark, sf_dir)))


def _without(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def _dataset(name: str, drop: tuple = ()) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _without(graph(spark, sf_dir)[name], *drop)
    run.__name__ = f"query_{name}"
    return run


def silver_review_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hearthlake.operators.silver import review_chunks
    return review_chunks(graph(spark, sf_dir)["silver_customer_reviews"])


def gold_weekly_sentiment_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sentiment with the original, literal chunking (one-character chunks)."""
    sources = stage_sources(TableReader(spark, sf_dir))
    return Medallion(sources, literal_split=True)["gold_store_sentiment_trends"]


def gold_supplier_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = graph(spark, sf_dir)["gold_supplier_risk_matrix"]
    return df.withColumn("avg_geographic_distance", F.round("avg_geographic_distance", 6))


def gold_store_scorecard_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily health with every rating period that holds the day; periods overlap and the last is open."""
    from hearthlake.operators.gold import rating_periods, store_scorecard_by_period
    g = graph(spark, sf_dir)
    return store_scorecard_by_period(g["gold_daily_franchise_health"], g["silver_franchise_ops"],
                                     rating_periods(g["gold_store_sentiment_trends"]))


def catalog_store_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard, bronze to gold, from source tables of the session catalog under three-part names."""
    from hearthlake.sources.sinks import ensure_schema, write_table
    database = "hearthlake_sources"
    root = f"{model_dir(spark)}/{spark.sparkContext.applicationId}/sources-{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, database)
    staged = stage_sources(TableReader(spark, sf_dir))
    for name in ("customers", "franchises", "suppliers", "transactions", "reviews"):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        write_table(getattr(staged, name), f"{database}.{name}", path=f"{root}/{name}")
    return Medallion(catalog_sources(TableReader(spark, database=f"spark_catalog.{database}")))["gold_store_scorecard"]


def _masked_customers(is_admin: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = graph(spark, sf_dir)["bronze_customer_profiles"]
        return b.select("raw_customer_id",
                        mask_pii("email", is_admin).alias("email"),
                        mask_pii("phone", is_admin).alias("phone"),
                        mask_pii("physical_address", is_admin).alias("physical_address"))
    run.__name__ = "mask_pii_admin" if is_admin else "mask_pii_user"
    return run


def forecast_panel_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hearthlake.operators.forecast.features import forecast_frames
    frames = forecast_frames(graph(spark, sf_dir)["gold_daily_franchise_health"])
    return frames.usable.select(
        "store_id", "reporting_date", "label", "day_of_week", "day_of_month", "month", "week_of_year",
        "is_weekend", "trend_index", "lag_1", "lag_7",
        *[F.round(c, 6).alias(c) for c in ("rolling_mean_3", "rolling_mean_7", "rolling_std_7")])


def forecast_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hearthlake.operators.forecast.features import forecast_frames
    frames = forecast_frames(graph(spark, sf_dir)["gold_daily_franchise_health"])
    return frames.split_counts()


def nodes_path(spark: SparkSession | None) -> str:
    """Where the nodes of the latest tuned run of a registered query are kept."""
    return f"{model_dir(spark)}/current/nodes"


def _tuned(spark: SparkSession, sf_dir: str, candidates):
    """The tuned run over the whole panel. Queries of one application share it: the run is stored under the
    application's name and read by the next one."""
    from hearthlake.operators.forecast.features import forecast_frames
    from hearthlake.operators.forecast.train import stored_nodes, tune_store_levels
    frames = forecast_frames(graph(spark, sf_dir)["gold_daily_franchise_health"]).checkpointed()
    best = tune_store_levels(frames, candidates, f"{model_dir(spark)}/{spark.sparkContext.applicationId}")
    stored_nodes(spark, best).write.mode("overwrite").parquet(nodes_path(spark))
    return frames, best


def forecast_tuning(spark: SparkSession, sf_dir: str, candidates=params.DEFAULT_CANDIDATES) -> DataFrame:
    """Holdout metrics of every candidate of the full grid."""
    results = _tuned(spark, sf_dir, candidates)[1].results
    return results.select("algorithm", "config_json", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
                          F.round("r2", 6).alias("r2"))


def forecast_next_14_days(spark: SparkSession, sf_dir: str, candidates=params.DEFAULT_CANDIDATES) -> DataFrame:
    """The recursive forecast of every store with the tuned model."""
    from hearthlake.operators.forecast.predict import roll_forward_forecast
    frames, best = _tuned(spark, sf_dir, candidates)
    return roll_forward_forecast(best.model, frames, best.model_name).drop("forecast_generated_at")


def forecast_run_log(spark: SparkSession, sf_dir: str, candidates=params.DEFAULT_CANDIDATES) -> DataFrame:
    """Metrics and registry rows of the tuned run after it was recorded twice, as by a job that starts over."""
    from hearthlake.operators.forecast.train import run_key
    from hearthlake.plans.forecast_job import ForecastTables, record_run
    from hearthlake.sources.sinks import ensure_schema
    frames, best = _tuned(spark, sf_dir, candidates)
    database, tables = "hearthlake_runs", ForecastTables()
    ensure_schema(spark, database, location=f"{model_dir(spark)}/{spark.sparkContext.applicationId}/tables")
    run_id = run_key(frames, candidates)
    for _ in range(2):
        record_run(spark, database, tables, frames, best, run_id)
    names = tables.qualified(database)
    registered = spark.table(names.registry).where(F.col("run_id") == run_id).agg(F.count(F.lit(1)))
    return (spark.table(names.metrics).where(F.col("run_id") == run_id)
            .select("model_name", "train_rows", "test_rows", F.round("rmse", 4).alias("rmse"),
                    F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
                    registered.scalar().alias("registry_rows")))


def forecast_first_step_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model input of the first forecast day, for every store."""
    from hearthlake.operators.forecast.features import forecast_frames
    from hearthlake.operators.forecast.predict import initial_state, step_features
    frames = forecast_frames(graph(spark, sf_dir)["gold_daily_franchise_health"])
    return step_features(initial_state(frames)).select(
        "store_id", "reporting_date", "day_of_week", "day_of_month", "month", "week_of_year", "is_weekend",
        "trend_index", "lag_1", "lag_7",
        *[F.round(c, 6).alias(c) for c in ("rolling_mean_3", "rolling_mean_7", "rolling_std_7")])


def forecast_recursion_mean7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursive forecast with a model that predicts the mean of the last
    seven days: every step of the feedback is then plain arithmetic."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    from hearthlake.operators.forecast.features import forecast_frames
    from hearthlake.operators.forecast.predict import roll_forward_forecast
    frames = forecast_frames(graph(spark, sf_dir)["gold_daily_franchise_health"]).checkpointed()
    mean7 = PipelineModel(stages=[SQLTransformer(statement="SELECT *, rolling_mean_7 AS prediction FROM __THIS__")])
    return roll_forward_forecast(mean7, frames, "mean7").drop("forecast_generated_at")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "bronze_customers": _dataset("bronze_customer_profiles", ("_ingested_at",)),
        "bronze_stores": _dataset("bronze_franchise_ops", ("_ingested_at",)),
        "bronze_suppliers": _dataset("bronze_supply_chain", ("_ingested_at",)),
        "bronze_transactions": _dataset("bronze_pos_transactions", ("_ingested_at",)),
        "bronze_reviews": _dataset("bronze_customer_reviews", ("_ingested_at",)),
        "silver_customers_masked": _dataset("silver_customer_profiles"),
        "silver_stores": _dataset("silver_franchise_ops"),
        "silver_suppliers_approved": _dataset("silver_supply_chain"),
        "silver_suppliers_quarantine": _dataset("silver_supply_chain_quarantine"),
        "silver_transactions": _dataset("silver_pos_transactions"),
        "silver_review_chunks": silver_review_chunks,
        "gold_daily_store_health": _dataset("gold_daily_franchise_health"),
        "gold_customer_360": _dataset("gold_customer_360"),
        "gold_supplier_risk": gold_supplier_risk,
        "gold_weekly_sentiment": _dataset("gold_store_sentiment_trends"),
        "gold_weekly_sentiment_literal": gold_weekly_sentiment_literal,
        "gold_store_scorecard": _dataset("gold_store_scorecard"),
        "gold_store_scorecard_by_period": gold_store_scorecard_by_period,
        "catalog_store_scorecard": catalog_store_scorecard,
        "checks_foundation": _dataset("silver_test_foundation_quality", ("validated_at",)),
        "checks_contracts": _dataset("silver_test_contract_quality", ("validated_at",)),
        "checks_daily": _dataset("gold_test_daily_franchise_health_quality", ("validated_at",)),
        "checks_customer_360": _dataset("gold_test_customer_360_quality", ("validated_at",)),
        "checks_supplier_risk": _dataset("gold_test_supplier_risk_quality", ("validated_at",)),
        "checks_sentiment": _dataset("gold_test_sentiment_trends_quality", ("validated_at",)),
        "checks_scorecard": _dataset("gold_test_scorecard_quality", ("validated_at",)),
        "forecast_panel_features": forecast_panel_features,
        "forecast_holdout_split": forecast_holdout_split,
        "forecast_first_step_features": forecast_first_step_features,
        "forecast_recursion_mean7": forecast_recursion_mean7,
        "forecast_tuning": forecast_tuning,
        "forecast_next_14_days": forecast_next_14_days,
        "forecast_run_log": forecast_run_log,
        "mask_pii_admin": _masked_customers(True),
        "mask_pii_user": _masked_customers(False),
    }
