"""The dataset graph: sources -> bronze -> silver -> gold -> checks.

``Medallion`` wires the operator functions together lazily. Each dataset
is built once per instance (one DataFrame object), so a query that uses a
dataset several times hands Catalyst identical sub-plans, and their
shuffles are reused. ``refresh`` materialises every dataset as a table, in
dependency order, and later datasets then read the written tables - the
cluster equivalent of a full pipeline refresh.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.operators import bronze, gold, quality, silver
from hearthlake.sources.staging import SourceTables
from hearthlake.sources.sinks import ensure_schema, table_path, write_table

# Dataset name -> (layer, description); the order is a valid build order.
DATASETS = {
    "bronze_customer_profiles": ("bronze", "Raw customer records with lineage"),
    "bronze_franchise_ops": ("bronze", "Raw store records with lineage"),
    "bronze_supply_chain": ("bronze", "Raw supplier records with lineage"),
    "bronze_pos_transactions": ("bronze", "Raw point-of-sale transactions with lineage"),
    "bronze_customer_reviews": ("bronze", "Raw review text with lineage"),
    "silver_customer_profiles": ("silver", "Customers with masked PII and normalised geography"),
    "silver_franchise_ops": ("silver", "Stores with normalised country"),
    "silver_supply_chain": ("silver", "Approved suppliers"),
    "silver_supply_chain_quarantine": ("silver", "Suppliers held back for non-approved status"),
    "silver_pos_transactions": ("silver", "Deduplicated, validated transactions with valid references"),
    "silver_customer_reviews": ("silver", "Cleaned review text split into sentence chunks"),
    "silver_test_foundation_quality": ("check", "Foundation data-quality checks"),
    "silver_test_contract_quality": ("check", "Layer contracts: completeness, cast failures, unique dimension keys"),
    "gold_daily_franchise_health": ("gold", "Daily store revenue and ticket metrics"),
    "gold_test_daily_franchise_health_quality": ("check", "Daily store health checks"),
    "gold_customer_360": ("gold", "Customer spend, preferred store and product"),
    "gold_test_customer_360_quality": ("check", "Customer 360 checks"),
    "gold_supplier_risk_matrix": ("gold", "Supplier dependency, distance and criticality risk"),
    "gold_test_supplier_risk_quality": ("check", "Supplier risk checks"),
    "gold_store_sentiment_trends": ("gold", "Weekly store sentiment from review chunks"),
    "gold_test_sentiment_trends_quality": ("check", "Sentiment trend checks"),
    "gold_store_scorecard": ("gold", "Combined daily store scorecard"),
    "gold_test_scorecard_quality": ("check", "Scorecard checks"),
}


# Datasets refreshed together; a group reads datasets of other groups from
# their tables (see ``Medallion.refresh(group=...)``).
REFRESH_GROUPS = {
    "foundation": ["bronze_customer_profiles", "bronze_franchise_ops", "bronze_supply_chain",
                   "bronze_pos_transactions", "bronze_customer_reviews", "silver_customer_profiles",
                   "silver_franchise_ops", "silver_supply_chain", "silver_supply_chain_quarantine",
                   "silver_pos_transactions", "silver_customer_reviews", "silver_test_foundation_quality",
                   "silver_test_contract_quality"],
    "daily_health": ["gold_daily_franchise_health", "gold_test_daily_franchise_health_quality"],
    "customer_360": ["gold_customer_360", "gold_test_customer_360_quality"],
    "supplier_risk": ["gold_supplier_risk_matrix", "gold_test_supplier_risk_quality"],
    "sentiment": ["gold_store_sentiment_trends", "gold_test_sentiment_trends_quality"],
    "scorecard": ["gold_store_scorecard", "gold_test_scorecard_quality"],
}


# Datasets of other groups that a group reads.
GROUP_INPUTS = {
    "foundation": [],
    "daily_health": ["silver_pos_transactions"],
    "customer_360": ["silver_pos_transactions", "silver_franchise_ops"],
    "supplier_risk": ["silver_supply_chain", "silver_franchise_ops"],
    "sentiment": ["silver_customer_reviews"],
    "scorecard": ["gold_daily_franchise_health", "silver_franchise_ops", "gold_store_sentiment_trends",
                  "gold_customer_360", "gold_supplier_risk_matrix"],
}

# Datasets that a refresh can store in buckets of their customers, and the share of a bucket's mean
# size that one customer may have: a bucket is read by one task, so a hot customer must not fill it.
BUCKETED = {"silver_pos_transactions": "customer_id", "gold_customer_360": "customer_id"}
HOT_SHARE = 0.5


def splits_evenly(rows: DataFrame, column: str, buckets: int) -> bool:
    """Whether no value of ``column`` (NULL included) outweighs its bucket."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return counts.most is None or counts.most <= HOT_SHARE * counts["all"] / buckets


CHECK_DATASETS = [name for name, (layer, _) in DATASETS.items() if layer == "check"]


def stored_check_report(spark: SparkSession, database: str) -> DataFrame:
    """All stored check tables of a database as one report, failing checks first."""
    frames = [spark.table(f"{database}.{name}").withColumn("dataset", F.lit(name)) for name in CHECK_DATASETS]
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    return (report.select("dataset", "test_name", "failed_records", "test_passed", "validated_at")
            .orderBy("test_passed", "dataset", "test_name"))


class Medallion:
    """Lazy dataset graph over one set of sources."""

    def __init__(self, sources: SourceTables, literal_split: bool = False, quarantine_null_status: bool = True):
        """``literal_split`` / ``quarantine_null_status=False`` switch the two
        documented deviations back to the original behaviour."""
        self.sources = sources
        self.literal_split = literal_split
        self.quarantine_null_status = quarantine_null_status
        self._overrides: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        return getattr(self, name)

    # bronze ---------------------------------------------------------------
    @cached_property
    def bronze_customer_profiles(self) -> DataFrame:
        return bronze.bronze_customers(self.sources.customers, self.sources.names[0])

    @cached_property
    def bronze_franchise_ops(self) -> DataFrame:
        return bronze.bronze_stores(self.sources.franchises, self.sources.names[1])

    @cached_property
    def bronze_supply_chain(self) -> DataFrame:
        return bronze.bronze_suppliers(self.sources.suppliers, self.sources.names[2])

    @cached_property
    def bronze_pos_transactions(self) -> DataFrame:
        return bronze.bronze_transactions(self.sources.transactions, self.sources.names[3])

    @cached_property
    def bronze_customer_reviews(self) -> DataFrame:
        return bronze.bronze_reviews(self.sources.reviews, self.sources.names[4])

    # silver ---------------------------------------------------------------
    @cached_property
    def silver_customer_profiles(self) -> DataFrame:
        return silver.silver_customers(self["bronze_customer_profiles"])

    @cached_property
    def silver_franchise_ops(self) -> DataFrame:
        return silver.silver_stores(self["bronze_franchise_ops"])

    @cached_property
    def silver_supply_chain(self) -> DataFrame:
        return silver.silver_suppliers(self["bronze_supply_chain"])

    @cached_property
    def silver_supply_chain_quarantine(self) -> DataFrame:
        return silver.silver_suppliers_quarantine(self["bronze_supply_chain"],
                                                  quarantine_null_status=self.quarantine_null_status)

    @cached_property
    def silver_pos_transactions(self) -> DataFrame:
        return silver.silver_transactions(self["bronze_pos_transactions"], self["silver_customer_profiles"],
                                          self["silver_franchise_ops"])

    @cached_property
    def silver_customer_reviews(self) -> DataFrame:
        return silver.silver_reviews(self["bronze_customer_reviews"], literal_split=self.literal_split)

    @cached_property
    def silver_test_foundation_quality(self) -> DataFrame:
        return quality.foundation_checks(
            self["silver_pos_transactions"], self["silver_customer_profiles"], self["silver_franchise_ops"],
            self["silver_supply_chain"], self["silver_supply_chain_quarantine"], self["silver_customer_reviews"],
            self["bronze_supply_chain"])

    @cached_property
    def silver_test_contract_quality(self) -> DataFrame:
        return quality.contract_checks(
            self.sources.transactions, self["bronze_supply_chain"], self["silver_supply_chain"],
            self["silver_supply_chain_quarantine"], self["silver_customer_profiles"], self["silver_franchise_ops"])

    # gold -----------------------------------------------------------------
    @cached_property
    def gold_daily_franchise_health(self) -> DataFrame:
        return gold.daily_store_health(self["silver_pos_transactions"])

    @cached_property
    def gold_test_daily_franchise_health_quality(self) -> DataFrame:
        return quality.daily_health_checks(self["gold_daily_franchise_health"], self["silver_pos_transactions"])

    @cached_property
    def gold_customer_360(self) -> DataFrame:
        return gold.customer_360(self["silver_pos_transactions"], self["silver_franchise_ops"])

    @cached_property
    def gold_test_customer_360_quality(self) -> DataFrame:
        return quality.customer_360_checks(self["gold_customer_360"], self["silver_pos_transactions"])

    @cached_property
    def gold_supplier_risk_matrix(self) -> DataFrame:
        return gold.supplier_risk(self["silver_supply_chain"], self["silver_franchise_ops"])

    @cached_property
    def gold_test_supplier_risk_quality(self) -> DataFrame:
        return quality.supplier_risk_checks(self["gold_supplier_risk_matrix"], self["silver_supply_chain"])

    @cached_property
    def gold_store_sentiment_trends(self) -> DataFrame:
        return gold.weekly_sentiment(self["silver_customer_reviews"])

    @cached_property
    def gold_test_sentiment_trends_quality(self) -> DataFrame:
        return quality.sentiment_checks(self["gold_store_sentiment_trends"])

    @cached_property
    def gold_store_scorecard(self) -> DataFrame:
        return gold.store_scorecard(self["gold_daily_franchise_health"], self["silver_franchise_ops"],
                                    self["gold_store_sentiment_trends"], self["gold_customer_360"],
                                    self["gold_supplier_risk_matrix"])

    @cached_property
    def gold_test_scorecard_quality(self) -> DataFrame:
        return quality.scorecard_checks(self["gold_store_scorecard"], self["gold_daily_franchise_health"])

    # SQL access -----------------------------------------------------------
    def register_views(self, names=None) -> list[str]:
        """Expose datasets as temporary views under their dataset names, so
        SQL users can query them (lazily) without a refresh."""
        registered = []
        for name in DATASETS:
            if names is None or name in names:
                self[name].createOrReplaceTempView(name)
                registered.append(name)
        return registered

    # materialisation ------------------------------------------------------
    def refresh(self, spark: SparkSession, database: str | None = None, names=None,
                group: str | None = None, buckets: int | None = None) -> list[str]:
        """Write datasets as tables (full refresh) in build order.

        After each write the dataset is re-read from its table, so
        downstream datasets start from materialised data (short lineage,
        and a lost executor only costs the stage in flight). With ``group``
        only that refresh group is written, and it reads the datasets of other
        groups from their tables; a table that is not there is an error, so
        one refresh never mixes stored and recomputed inputs. With ``buckets``
        transactions and customer 360 are stored in that many buckets of
        customers, unless one customer holds too many rows for a bucket.
        """
        if database:
            ensure_schema(spark, database)
        if group is not None:
            names = REFRESH_GROUPS[group]
            existing = ({t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
                        if database else set())
            missing = [n for n in GROUP_INPUTS[group] if n not in existing]
            if missing:
                raise ValueError(f"group {group} reads tables that are not there: {', '.join(missing)}")
            for other in DATASETS:
                if other not in names and other in existing:
                    self._overrides[other] = spark.table(f"{database}.{other}" if database else other)
        written = []
        for name, (_, comment) in DATASETS.items():
            if names is not None and name not in names:
                continue
            table = f"{database}.{name}" if database else name
            path, bucket_by = table_path(spark, database, name), None
            first = f"{table}_{uuid.uuid4().hex}"  # counted and then dealt: written once, dropped with its files
            if buckets and name in BUCKETED:
                write_table(self[name], first)
                self._overrides[name] = spark.table(first)
                if splits_evenly(self[name], BUCKETED[name], buckets):
                    bucket_by = (buckets, BUCKETED[name])
            write_table(self[name], table, mode="overwrite", comment=comment, path=path, bucket_by=bucket_by)
            self._overrides[name] = spark.table(table)
            if buckets and name in BUCKETED:
                spark.sql(f"DROP TABLE {first}")
            written.append(table)
        return written
