"""Silver layer (P6-P11): curated, validated entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake import params
from hearthlake.functions import (chunk_sentences, clean_review_text, mask_address, mask_email, mask_phone,
                                  normalize_continent, normalize_country)


def _is_approved(status):
    return F.upper(F.trim(status)) == F.lit(params.APPROVED_STATUS)


def silver_customers(bronze: DataFrame) -> DataFrame:
    """PII masked, country and continent canonicalised."""
    return bronze.select(
        F.col("raw_customer_id").alias("customer_id"),
        "first_name", "last_name",
        mask_email("email").alias("masked_email"),
        mask_phone("phone").alias("masked_phone"),
        mask_address("physical_address").alias("masked_address"),
        "city", "state",
        normalize_country("country").alias("normalized_country"),
        normalize_continent("continent").alias("normalized_continent"),
        "zip_code", "gender",
    )


def silver_stores(bronze: DataFrame) -> DataFrame:
    """Stores with the country canonicalised."""
    return bronze.select(
        F.col("raw_store_id").alias("store_id"),
        "store_name", "operational_size", "district",
        normalize_country("country").alias("normalized_country"),
        "primary_supplier_id", "latitude", "longitude",
    )


def silver_suppliers(bronze: DataFrame) -> DataFrame:
    """Approved suppliers only (status 'Y' after trim/upper)."""
    return bronze.where(_is_approved(F.col("approval_status"))).select(
        F.col("raw_supplier_id").alias("supplier_id"),
        "supplier_name", "provided_ingredients", "latitude", "longitude",
        F.lit(True).alias("is_approved"),
        normalize_continent("continent").alias("normalized_continent"),
        "city", "district", "size",
    )


def silver_suppliers_quarantine(bronze: DataFrame, quarantine_null_status: bool = True) -> DataFrame:
    """Every supplier that is not approved, raw columns.

    A NULL status is quarantined as well (``NOT (x <=> 'Y')``), so approved +
    quarantined always equals bronze. ``quarantine_null_status=False`` keeps
    the original ``<> 'Y'`` test, under which such a supplier is in neither set.
    """
    status = F.upper(F.trim(F.col("approval_status")))
    if quarantine_null_status:
        held = ~status.eqNullSafe(F.lit(params.APPROVED_STATUS))
    else:
        held = status != F.lit(params.APPROVED_STATUS)
    return bronze.where(held).select(
        F.col("raw_supplier_id").alias("supplier_id"),
        "supplier_name", "provided_ingredients", "latitude", "longitude",
        "approval_status", "continent", "city", "district", "size",
    )


# Order that picks the surviving row of a transaction id: latest timestamp
# first; equal timestamps are broken by the remaining columns so the result
# does not depend on task scheduling. NULLs sort last in every key.
DEDUP_ORDER = ("transaction_timestamp", "product_sold", "quantity", "unit_price", "total_price",
               "customer_id", "store_id")


def latest_transactions(bronze: DataFrame) -> DataFrame:
    """Latest row per transaction id (the id must be non-NULL).

    ``total_price`` is back-filled from quantity x unit price first. The
    ``rn = 1`` filter lets Spark plan a partial WindowGroupLimit before the
    shuffle, so even an id holding a large share of the rows reaches the
    reducer as at most one row per map task.
    """
    filled = bronze.where(F.col("raw_transaction_id").isNotNull()).select(
        F.col("raw_transaction_id").alias("transaction_id"),
        "transaction_timestamp", "product_sold", "quantity", "unit_price",
        F.coalesce(F.col("total_price"), (F.col("quantity") * F.col("unit_price")).try_cast("decimal(12,2)"))
         .alias("total_price"),
        "customer_id", "store_id",
    )
    w = Window.partitionBy("transaction_id").orderBy(*[F.col(c).desc_nulls_last() for c in DEDUP_ORDER])
    return filled.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def silver_transactions(bronze: DataFrame, customers: DataFrame, stores: DataFrame) -> DataFrame:
    """P10: dedup -> validate -> referential check.

    Validation applies to the surviving row only: if the latest row of an id
    is invalid the id is dropped, with no fallback to an older row. The
    foreign-key checks are semi joins, so duplicate dimension keys cannot
    multiply transactions; AQE broadcasts the dimension key sets when their
    measured size is small and keeps a sort-merge semi join otherwise.
    """
    latest = latest_transactions(bronze)
    valid = latest.where((F.col("quantity") > 0) & (F.col("unit_price") > 0))
    # Semi joins commute; the store check goes first because the store
    # dimension is usually far smaller (broadcast), so rows it rejects are
    # gone before a sort-merge customer join would shuffle them.
    return (valid
            .join(stores.select("store_id"), "store_id", "left_semi")
            .join(customers.select("customer_id"), "customer_id", "left_semi")
            .select("transaction_id", "transaction_timestamp", "product_sold", "quantity", "unit_price",
                    "total_price", "customer_id", "store_id"))


def silver_reviews(bronze: DataFrame, literal_split: bool = False) -> DataFrame:
    """Cleaned review text split into sentence chunks.

    Chunks are split at runs of '.', '!' or '?'. ``literal_split=True``
    keeps the original one-character chunking instead (see
    ``chunk_sentences``).
    """
    return bronze.select(
        F.col("raw_review_id").alias("review_id"),
        chunk_sentences(clean_review_text("review_text"), literal=literal_split).alias("chunked_review_text"),
        "submission_date",
        F.col("franchise_id").alias("store_id"),
    )


def review_chunks(silver_reviews_df: DataFrame) -> DataFrame:
    """One row per (review, chunk position, chunk).

    ``posexplode_outer`` + dropping NULL chunks (see ``weekly_sentiment``)
    avoids evaluating the chunking twice.
    """
    return (silver_reviews_df
            .select("review_id", F.posexplode_outer("chunked_review_text").alias("pos", "chunk"))
            .where(F.col("chunk").isNotNull()))
