"""Embedded data-quality checks.

A check report has one row per check: ``test_name``, ``failed_records``
(BIGINT), ``test_passed`` and ``validated_at``. Checks over the same input
are evaluated together: ``CheckBlock`` turns N conditions on one DataFrame
into a single aggregation pass (``count_if`` per condition) whose one row is
then unpivoted with ``stack``; a report unions the tiny per-block results.
Scanning a table once per check is what the naive UNION ALL form does.

Conditions use SQL three-valued logic like the original checks: a row whose
condition is NULL is not counted. Reconciliation checks compare with the
null-safe ``<=>`` instead, so a NULL on one side counts as a mismatch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake import params


@dataclass
class CheckBlock:
    """Checks evaluated in one pass over ``df``.

    ``measures`` maps a check name to an aggregate Column yielding the
    failed-record count, e.g. ``failed_if(cond)`` or ``row_count()``.
    """

    df: DataFrame
    measures: dict[str, Column] = field(default_factory=dict)

    def add(self, name: str, measure: Column) -> "CheckBlock":
        self.measures[name] = measure
        return self

    def rows(self) -> DataFrame:
        names = list(self.measures)
        aggregated = self.df.agg(*[self.measures[n].cast("bigint").alias(f"_m{i}") for i, n in enumerate(names)])
        pairs = []
        for i, n in enumerate(names):
            pairs += [F.lit(n), F.col(f"_m{i}")]
        return aggregated.select(F.stack(F.lit(len(names)), *pairs).alias("test_name", "failed_records"))


def failed_if(condition: Column) -> Column:
    """Number of rows for which ``condition`` is TRUE."""
    return F.count_if(condition)


def row_count() -> Column:
    return F.count(F.lit(1))


def check_report(*blocks: CheckBlock) -> DataFrame:
    result = None
    for block in blocks:
        rows = block.rows()
        result = rows if result is None else result.unionByName(rows)
    return result.select("test_name", "failed_records",
                         (F.col("failed_records") == 0).alias("test_passed"),
                         F.current_timestamp().alias("validated_at"))


def _duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def _mismatch(left_cols, right_cols) -> Column:
    """Any pair of columns differs, treating NULL as a value."""
    cond = None
    for a, b in zip(left_cols, right_cols):
        c = ~F.col(a).eqNullSafe(F.col(b))
        cond = c if cond is None else (cond | c)
    return cond


# ---------------------------------------------------------------------------
# P17 foundation
# ---------------------------------------------------------------------------

def _key_counts(transactions: DataFrame, customers: DataFrame, stores: DataFrame) -> DataFrame:
    """Transactions per customer and per store (``_by_customer`` says which), with a mark for each key that its
    dimension knows. Counting each key by itself holds one row per key, not one per pair of keys, and a hot
    key reaches the join as one row."""
    def known(dimension: DataFrame, key: str, by_customer: bool) -> DataFrame:
        return dimension.select(F.lit(by_customer).alias("_of_customers"), F.col(key).alias("_known")).distinct()
    by_customer = F.grouping_id() == 1  # the store is the key that is not grouped by
    counts = (transactions.groupingSets([["customer_id"], ["store_id"]], "customer_id", "store_id")
              .agg(F.count(F.lit(1)).alias("_n"), by_customer.alias("_by_customer"))
              .select("_by_customer", F.when(F.col("_by_customer"), F.col("customer_id")).otherwise(F.col("store_id"))
                      .alias("_key"), "_n"))
    keys = known(customers, "customer_id", True).unionByName(known(stores, "store_id", False))
    return counts.join(keys, (F.col("_by_customer") == F.col("_of_customers")) & (F.col("_key") == F.col("_known")), "left")


def foundation_checks(transactions: DataFrame, customers: DataFrame, stores: DataFrame,
                      suppliers: DataFrame, quarantine: DataFrame, reviews: DataFrame,
                      bronze_suppliers: DataFrame) -> DataFrame:
    """Eight checks on the curated layer.

    ``unapproved_suppliers_in_silver_supply`` also verifies each approved
    supplier against its bronze status (the silver flag alone is constant).
    """
    approved_ids = (bronze_suppliers
                    .where(F.upper(F.trim("approval_status")) == F.lit(params.APPROVED_STATUS))
                    .select(F.col("raw_supplier_id").alias("supplier_id")).distinct()
                    .withColumn("_backed", F.lit(True)))
    supplier_view = suppliers.select("supplier_id", "is_approved").join(approved_ids, "supplier_id", "left")
    return check_report(
        CheckBlock(_duplicate_keys(transactions, "transaction_id"), {"duplicate_transaction_ids": row_count()}),
        CheckBlock(_key_counts(transactions, customers, stores), {
            "invalid_customer_fk_in_transactions": F.coalesce(
                F.sum(F.when(F.col("_by_customer") & F.col("_known").isNull(), F.col("_n"))), F.lit(0)),
            "invalid_store_fk_in_transactions": F.coalesce(
                F.sum(F.when(~F.col("_by_customer") & F.col("_known").isNull(), F.col("_n"))), F.lit(0))}),
        CheckBlock(supplier_view, {"unapproved_suppliers_in_silver_supply": failed_if(
            (F.coalesce("is_approved", F.lit(False)) != F.lit(True)) | F.col("_backed").isNull())}),
        CheckBlock(quarantine, {"approved_suppliers_in_quarantine": failed_if(
            F.upper(F.trim("approval_status")) == F.lit(params.APPROVED_STATUS))}),
        CheckBlock(customers, {
            "unmasked_email_patterns": failed_if(~F.col("masked_email").like("_***%@%")),
            "unmasked_phone_patterns": failed_if(~F.col("masked_phone").like("%****%")),
        }),
        CheckBlock(reviews, {"reviews_without_chunks": failed_if(
            F.col("chunked_review_text").isNull() | (F.size("chunked_review_text") == 0))}),
    )


# ---------------------------------------------------------------------------
# P18 daily health
# ---------------------------------------------------------------------------

_DAILY_METRICS = ("total_daily_revenue", "total_items_sold", "avg_transaction_value")


def daily_health_checks(daily: DataFrame, transactions: DataFrame) -> DataFrame:
    from hearthlake.operators.gold import daily_store_health

    expected = daily_store_health(transactions).select(
        "store_id", "reporting_date", *[F.col(m).alias(f"_e_{m}") for m in _DAILY_METRICS],
        F.lit(True).alias("_e"))
    actual = daily.select("store_id", "reporting_date", *[F.col(m).alias(f"_a_{m}") for m in _DAILY_METRICS],
                          F.lit(True).alias("_a"))
    reconciled = expected.join(actual, ["store_id", "reporting_date"], "full_outer")
    mismatch = (F.col("_e").isNull() | F.col("_a").isNull()
                | _mismatch([f"_e_{m}" for m in _DAILY_METRICS], [f"_a_{m}" for m in _DAILY_METRICS]))
    return check_report(
        CheckBlock(reconciled, {"aggregation_mismatch_vs_silver": failed_if(mismatch)}),
        CheckBlock(daily, {
            "negative_metrics": failed_if((F.col("total_daily_revenue") < 0) | (F.col("total_items_sold") < 0)
                                          | (F.col("avg_transaction_value") < 0)),
            "null_store_or_date": failed_if(F.col("store_id").isNull() | F.col("reporting_date").isNull()),
        }),
    )


# ---------------------------------------------------------------------------
# P19 customer 360
# ---------------------------------------------------------------------------

def customer_360_checks(c360: DataFrame, transactions: DataFrame) -> DataFrame:
    """Duplicates, nulls and spend mismatches from one keyed pass over customer 360 and the expected spends.

    Rows of both sides are counted per (customer, spend), then per customer. A customer 360 row agrees if its
    customer's expected spend is in the same group; a customer without any such row counts once. Nulls group
    like values, so a hot customer id costs one row per map task.
    """
    money = c360.schema["total_lifetime_spend"].dataType
    preference_missing = F.col("preferred_store_location").isNull() | F.col("most_frequent_product").isNull()
    actual = c360.select("customer_id", F.col("total_lifetime_spend").alias("_spend"), F.lit(1).alias("_actual"),
                         F.lit(0).alias("_expected"), preference_missing.cast("int").alias("_bare"))
    expected = (transactions.groupBy("customer_id").agg(F.round(F.sum("total_price"), 2).cast(money).alias("_spend"))
                .select("customer_id", "_spend", F.lit(0).alias("_actual"), F.lit(1).alias("_expected"),
                        F.lit(0).alias("_bare")))
    tallies = ("_actual", "_expected", "_bare")
    by_spend = (actual.unionByName(expected).groupBy("customer_id", "_spend")
                .agg(*[F.sum(c).alias(c) for c in tallies])
                # a null customer matches nothing, on either side
                .withColumn("_agree", F.when(F.col("customer_id").isNotNull() & (F.col("_expected") > 0), F.col("_actual"))
                            .otherwise(F.lit(0))))
    lone = F.when(F.col("customer_id").isNull(), F.col("_expected")).otherwise(
        F.when(F.col("_actual") == 0, F.col("_expected")).otherwise(F.lit(0)))
    per_customer = (by_spend.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in (*tallies, "_agree")])
                    .withColumn("_off", F.col("_actual") - F.col("_agree") + lone))
    zero = F.lit(0)
    return check_report(CheckBlock(per_customer, {
        "duplicate_customer_rows": failed_if(F.col("_actual") > 1),
        "null_customer_id": F.coalesce(F.sum(F.when(F.col("customer_id").isNull(), F.col("_actual"))), zero),
        "null_preference_fields_for_transacting_customers": F.coalesce(F.sum("_bare"), zero),
        "spend_mismatch_vs_silver": F.coalesce(F.sum("_off"), zero),
    }))


# ---------------------------------------------------------------------------
# P20 supplier risk
# ---------------------------------------------------------------------------

def supplier_risk_checks(risk: DataFrame, suppliers: DataFrame) -> DataFrame:
    return check_report(
        CheckBlock(suppliers.select("supplier_id").join(risk.select("supplier_id"), "supplier_id", "left_anti"),
                   {"missing_suppliers_in_risk_matrix": row_count()}),
        CheckBlock(risk, {
            "criticality_out_of_range": failed_if(~F.col("ingredient_criticality_score").isin(2, 3, 5)),
            "negative_distance": failed_if(F.col("avg_geographic_distance") < 0),
            "null_primary_fields": failed_if(F.col("supplier_id").isNull() | F.col("is_high_risk_flag").isNull()),
        }),
    )


# ---------------------------------------------------------------------------
# P21 sentiment
# ---------------------------------------------------------------------------

def sentiment_checks(sentiment: DataFrame) -> DataFrame:
    score = F.col("customer_satisfaction_score")
    return check_report(CheckBlock(sentiment, {
        "sentiment_score_out_of_bounds": failed_if((score < -1) | (score > 1)),
        "invalid_reporting_period_span": failed_if(
            F.datediff("reporting_period_end", "reporting_period_start") != 6),
        "null_store_or_period": failed_if(F.col("store_id").isNull() | F.col("reporting_period_start").isNull()
                                          | F.col("reporting_period_end").isNull()),
    }))


# ---------------------------------------------------------------------------
# P22 scorecard
# ---------------------------------------------------------------------------

def scorecard_checks(scorecard: DataFrame, daily: DataFrame) -> DataFrame:
    daily_rows = daily.select(row_count()).scalar()
    return check_report(CheckBlock(scorecard, {
        "scorecard_row_count_matches_daily_health": F.abs(daily_rows - row_count()),
        "null_primary_keys": failed_if(F.col("store_id").isNull() | F.col("reporting_date").isNull()),
        "negative_core_metrics": failed_if((F.col("total_daily_revenue") < 0) | (F.col("total_items_sold") < 0)
                                           | (F.col("avg_transaction_value") < 0)),
    }))


# ---------------------------------------------------------------------------
# Layer contracts (completeness, cast failures, dimension key uniqueness)
# ---------------------------------------------------------------------------

# Typed bronze columns of the transactions source: source column -> bronze type.
TRANSACTION_CASTS = {"transactionID": "string", "dateTime": "timestamp", "quantity": "int",
                     "unitPrice": "decimal(10,2)", "totalPrice": "decimal(12,2)", "customerID": "string",
                     "franchiseID": "string", "cardNumber": "string"}


def contract_checks(source_transactions: DataFrame, bronze_suppliers: DataFrame, approved: DataFrame,
                    quarantine: DataFrame, customers: DataFrame, stores: DataFrame) -> DataFrame:
    """Checks on the contracts between layers.

    * every bronze supplier is either approved or quarantined;
    * no source transaction value is lost by the bronze ``try_cast``;
    * dimension keys are unique (the dimension joins assume it).
    """
    split_rows = approved.select(row_count()).scalar() + quarantine.select(row_count()).scalar()
    lost_in_cast = None
    for column, type_ in TRANSACTION_CASTS.items():
        c = F.col(column).isNotNull() & F.col(column).try_cast(type_).isNull()
        lost_in_cast = c if lost_in_cast is None else (lost_in_cast | c)
    return check_report(
        CheckBlock(bronze_suppliers, {"suppliers_neither_approved_nor_quarantined": F.abs(row_count() - split_rows)}),
        CheckBlock(source_transactions, {"transaction_cast_failures": failed_if(lost_in_cast)}),
        CheckBlock(_duplicate_keys(customers, "customer_id"), {"duplicate_customer_ids": row_count()}),
        CheckBlock(_duplicate_keys(stores, "store_id"), {"duplicate_store_ids": row_count()}),
        CheckBlock(_duplicate_keys(approved, "supplier_id"), {"duplicate_supplier_ids": row_count()}),
    )
