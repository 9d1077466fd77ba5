"""The five operational sources (customers, franchises, suppliers,
transactions, reviews).

``stage_sources`` derives them from the TPC-H-style driver tables
(customer, supplier, nation, region, part, orders, lineitem, documents) with
a fixed mapping that also plants realistic defects (missing '@', padded
approval flags, NULL totals, unknown foreign keys, zero quantities, ...), so
every branch of the curation rules is exercised. ``catalog_sources`` reads
real source tables that already have the source column names.

Column names are the operational sources' own (``customerID``,
``franchiseID``, ``dateTime`` ...), so the bronze layer is written against
the real source contract.

The ``key % n == r`` expressions below only choose which *values* carry a
planted defect (a NULL total, an unknown foreign key, a zero quantity, a
padded flag); every staging view keeps every row of its driver table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.sources.tables import TableReader


@dataclass(frozen=True)
class SourceTables:
    customers: DataFrame
    franchises: DataFrame
    suppliers: DataFrame
    transactions: DataFrame
    reviews: DataFrame
    # Names recorded in the bronze ``_source_table`` column.
    names: tuple = ("src_customers", "src_franchises", "src_suppliers", "src_transactions", "src_reviews")


def _s(c):
    return F.col(c).cast("string")


def staged_customers(read: TableReader) -> DataFrame:
    c = read("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read("region").select("r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("c_custkey")
    return j.select(
        key.alias("customerID"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(key % 50 == 7, F.lit("no-at-sign"))
         .otherwise(F.concat(F.col("c_mktsegment"), F.lit("."), _s("c_custkey"), F.lit("@Example.com")))
         .alias("email_address"),
        F.concat(F.lit("555-"), F.lpad(_s("c_custkey"), 7, "0")).alias("phone_number"),
        F.concat(_s("c_custkey"), F.lit(" "), F.col("c_mktsegment"), F.lit(" St")).alias("address"),
        F.col("n_name").alias("city"),
        F.lit("unknown").alias("state"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit(" usa"))
         .when(F.col("c_nationkey") % 3 == 1, F.lit("US"))
         .otherwise(F.col("n_name")).alias("country"),
        F.when(F.col("r_regionkey") == 1, F.lit("NorthAmerica")).otherwise(F.col("r_name")).alias("continent"),
        (key % 99999).cast("int").alias("postal_zip_code"),
        F.lit("unknown").alias("gender"),
    )


def staged_franchises(read: TableReader) -> DataFrame:
    s = read("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read("nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    key = F.col("s_suppkey")
    return j.select(
        key.alias("franchiseID"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 5000, F.lit("L")).otherwise(F.lit("S")).alias("size"),
        F.col("n_name").alias("district"),
        F.col("n_name").alias("country"),
        # a third of the stores buy from supplier 1, the others in groups of four
        F.when(F.col("s_nationkey") % 7 == 6, F.lit(None)).when(key % 3 == 1, F.lit(1))
         .otherwise(key - key % 4 + 2).cast("long").alias("supplierID"),
        ((key * 37) % 60 - 30).cast("double").alias("latitude"),
        ((key * 73) % 120 - 60).cast("double").alias("longitude"),
    )


def staged_suppliers(read: TableReader) -> DataFrame:
    s = read("supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read("region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("s_suppkey")
    ingredient = (F.when(key % 6 == 0, F.lit("Cacao")).when(key % 6 == 1, F.lit("almonds"))
                  .when(key % 6 == 2, F.lit("flour")).when(key % 6 == 3, F.lit("vanilla"))
                  .when(key % 6 == 4, F.lit("coffee")).otherwise(F.lit(None).cast("string")))
    approved = (F.when(key % 25 == 24, F.lit(None).cast("string")).when(key % 5 == 4, F.lit("N"))
                .when(key % 5 == 3, F.lit(" y ")).otherwise(F.lit("Y")))
    return j.select(
        key.alias("supplierID"),
        F.col("s_name").alias("name"),
        ingredient.alias("ingredient"),
        ((key * 53) % 60 - 30).cast("double").alias("latitude"),
        ((key * 97) % 120 - 60).cast("double").alias("longitude"),
        approved.alias("approved"),
        F.col("r_name").alias("continent"),
        F.col("n_name").alias("city"),
        F.lit("central").alias("district"),
        F.lit("M").alias("size"),
    )


def staged_transactions(read: TableReader) -> DataFrame:
    li = read("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                              "l_quantity", "l_extendedprice", "l_shipdate")
    o = read("orders").select("o_orderkey", "o_custkey")
    p = read("part").select("p_partkey", "p_type", "p_retailprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    order = F.col("l_orderkey")
    return j.select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("transactionID"),
        F.col("l_shipdate").alias("dateTime"),
        F.col("p_type").alias("product"),
        F.when(F.col("l_partkey") % 97 == 5, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unitPrice"),
        F.when(order % 100 == 3, F.lit(None)).otherwise(F.col("l_extendedprice").cast("decimal(12,2)"))
         .alias("totalPrice"),
        F.when(order % 223 == 5, F.lit(-1)).otherwise(F.col("o_custkey")).alias("customerID"),
        F.when(order % 211 == 9, F.lit(-1)).otherwise(F.col("l_suppkey")).alias("franchiseID"),
        F.lit("card").alias("paymentMethod"),
        F.lit(None).cast("string").alias("cardNumber"),
    )


def staged_reviews(read: TableReader) -> DataFrame:
    docs = read("documents").select("doc_id", "text")
    store_count = read("supplier").select(F.count(F.lit(1))).scalar()
    doc = F.col("doc_id")
    suffix = (F.when(doc % 4 == 0, F.lit(". The service was slow")).when(doc % 4 == 1, F.lit(". Fresh bread"))
              .when(doc % 4 == 2, F.lit("! Good but stale")).otherwise(F.lit("")))
    return docs.select(
        doc.alias("new_id"),
        F.concat(F.col("text"), suffix).alias("review"),
        F.date_add(F.lit("1999-01-01").cast("date"), (doc % 120).cast("int")).alias("review_date"),
        (doc % store_count).alias("franchiseID"),
    )


def stage_sources(read: TableReader) -> SourceTables:
    return SourceTables(
        customers=staged_customers(read),
        franchises=staged_franchises(read),
        suppliers=staged_suppliers(read),
        transactions=staged_transactions(read),
        reviews=staged_reviews(read),
    )


def catalog_sources(read: TableReader, customers="customers", franchises="franchises", suppliers="suppliers",
                    transactions="transactions", reviews="reviews") -> SourceTables:
    names = (customers, franchises, suppliers, transactions, reviews)
    return SourceTables(*(read(n) for n in names), names=names)
