"""Bronze layer (P1-P5): rename, type, stamp lineage.

Casts use ``try_cast`` so a single malformed source value becomes NULL
instead of failing the whole load under ANSI mode; the foundation checks
count what the later layers reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lineage(source_table: str):
    return [F.current_timestamp().alias("_ingested_at"), F.lit(source_table).alias("_source_table")]


def _t(name: str, type_: str):
    return F.col(name).try_cast(type_)


def bronze_customers(src: DataFrame, source_table: str = "customers") -> DataFrame:
    return src.select(
        _t("customerID", "string").alias("raw_customer_id"),
        "first_name", "last_name",
        F.col("email_address").alias("email"),
        F.col("phone_number").alias("phone"),
        F.col("address").alias("physical_address"),
        "city", "state", "country", "continent",
        _t("postal_zip_code", "string").alias("zip_code"),
        "gender",
        *_lineage(source_table),
    )


def bronze_stores(src: DataFrame, source_table: str = "franchises") -> DataFrame:
    return src.select(
        _t("franchiseID", "string").alias("raw_store_id"),
        F.col("name").alias("store_name"),
        F.col("size").alias("operational_size"),
        "district", "country",
        _t("supplierID", "string").alias("primary_supplier_id"),
        _t("latitude", "double").alias("latitude"),
        _t("longitude", "double").alias("longitude"),
        *_lineage(source_table),
    )


def bronze_suppliers(src: DataFrame, source_table: str = "suppliers") -> DataFrame:
    return src.select(
        _t("supplierID", "string").alias("raw_supplier_id"),
        F.col("name").alias("supplier_name"),
        F.col("ingredient").alias("provided_ingredients"),
        _t("latitude", "double").alias("latitude"),
        _t("longitude", "double").alias("longitude"),
        F.col("approved").alias("approval_status"),
        "continent", "city", "district", "size",
        *_lineage(source_table),
    )


def bronze_transactions(src: DataFrame, source_table: str = "transactions") -> DataFrame:
    return src.select(
        _t("transactionID", "string").alias("raw_transaction_id"),
        _t("dateTime", "timestamp").alias("transaction_timestamp"),
        F.col("product").alias("product_sold"),
        _t("quantity", "int").alias("quantity"),
        _t("unitPrice", "decimal(10,2)").alias("unit_price"),
        _t("totalPrice", "decimal(12,2)").alias("total_price"),
        _t("customerID", "string").alias("customer_id"),
        _t("franchiseID", "string").alias("store_id"),
        F.col("paymentMethod").alias("payment_method"),
        _t("cardNumber", "string").alias("card_number"),
        *_lineage(source_table),
    )


def bronze_reviews(src: DataFrame, source_table: str = "reviews") -> DataFrame:
    return src.select(
        _t("new_id", "string").alias("raw_review_id"),
        F.col("review").alias("review_text"),
        _t("review_date", "date").alias("submission_date"),
        _t("franchiseID", "string").alias("franchise_id"),
        *_lineage(source_table),
    )
