"""DuckDB SQL for every SQL-expressible registered query.

The driver registers the raw tables (customer, supplier, nation, region,
part, orders, lineitem, documents, ...) as views and runs these statements
next to the Spark queries. They are written independently of the Spark
code and take different routes where SQL allows: top-1 preferences with
``first(... ORDER BY ...)`` instead of a ranking window, the scorecard's
week with a ``BETWEEN`` range join instead of an equi-join, the panel with a
cross join, foreign-key checks with ``NOT EXISTS``. Business constants come
from ``hearthlake.params`` so both sides use one specification.

Dialect notes:
* Spark averages a DECIMAL(p,s) to DECIMAL(p+4,s+4) with HALF_UP and the
  datasets then ROUND again; DuckDB averages decimals as DOUBLE. ``_avg``
  reproduces Spark's two roundings with exact integer arithmetic.
* Spark's regexp_replace replaces every match; ``'g'`` does that in DuckDB.
  Java's ``\\s`` also matches vertical tab, so the cleaner spells it out.
* DuckDB has no initcap; ``_initcap`` upper-cases the first letter of each
  blank-separated word after lower-casing, like Spark.
* DuckDB's concat() skips NULLs; ``||`` propagates them like Spark's concat.
* RE2's ``.`` matches ``\r`` where Java's does not; the masked fields of the
  staged customers contain no line terminators, so the mask patterns agree.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from hearthlake import params
from hearthlake.plans.queries import nodes_path


def _words(words) -> str:
    return "(" + "|".join(words) + ")"


def _quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


POSITIVE = _words(params.POSITIVE_WORDS)
NEGATIVE = _words(params.NEGATIVE_WORDS)


def _initcap(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def _country(expr: str) -> str:
    return (f"CASE WHEN upper(trim({expr})) IN ('US', 'USA') THEN 'United States' "
            f"ELSE {_initcap(f'trim({expr})')} END")


def _continent(expr: str) -> str:
    key = f"lower(trim({expr}))"
    arms = " ".join(f"WHEN {key} IN ({_quoted(spellings)}) THEN '{name}'" for spellings, name in params.CONTINENT_NAMES)
    return f"CASE {arms} ELSE {_initcap(f'trim({expr})')} END"


def _criticality(expr: str) -> str:
    key = f"lower({expr})"
    return (f"CASE WHEN {key} IN ({_quoted(params.CRITICAL_INGREDIENTS)}) THEN {params.CRITICAL_SCORE} "
            f"WHEN {key} IN ({_quoted(params.IMPORTANT_INGREDIENTS)}) THEN {params.IMPORTANT_SCORE} "
            f"ELSE {params.DEFAULT_CRITICALITY} END")


def _score_tenths(chunk: str) -> str:
    return (f"CASE WHEN regexp_matches({chunk}, '{POSITIVE}') THEN 10 "
            f"WHEN regexp_matches({chunk}, '{NEGATIVE}') THEN -10 ELSE 0 END")


def _rhu(num: str, den: str) -> str:
    """round_half_up(num / den) for integers, den > 0."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def _avg(expr: str, scale: int, digits: int, precision: int = 18) -> str:
    """Spark's ROUND(AVG(decimal(p, scale)), digits) as an exact DECIMAL(precision, digits)."""
    total = f"SUM(CAST(({expr}) * {10 ** scale} AS HUGEINT))"
    n = f"COUNT({expr})"
    wide = _rhu(f"({total}) * 10000", n)
    rounded = _rhu(wide, str(10 ** (scale + 4 - digits)))
    unit = "0." + "0" * (digits - 1) + "1"
    return (f"CAST(CASE WHEN {n} = 0 THEN NULL ELSE CAST({rounded} AS DECIMAL(18,0)) * {unit} END "
            f"AS DECIMAL({precision},{digits}))")


def _haversine(lat1, lon1, lat2, lon2) -> str:
    root = (f"SQRT(POWER(SIN(RADIANS({lat2} - {lat1}) / 2), 2) + "
            f"COS(RADIANS({lat1})) * COS(RADIANS({lat2})) * POWER(SIN(RADIANS({lon2} - {lon1}) / 2), 2))")
    return f"12742.0 * ASIN(CASE WHEN {root} > 1.0 THEN 1.0 ELSE {root} END)"


CTES: list[tuple[str, str]] = [
    # -- staging: driver tables in the shape of the five operational sources
    ("src_customers", r"""
SELECT c_custkey AS customerID, c_name AS first_name, c_mktsegment AS last_name,
  CASE WHEN c_custkey % 50 = 7 THEN 'no-at-sign'
       ELSE c_mktsegment || '.' || CAST(c_custkey AS VARCHAR) || '@Example.com' END AS email_address,
  '555-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone_number,
  CAST(c_custkey AS VARCHAR) || ' ' || c_mktsegment || ' St' AS address,
  n_name AS city, 'unknown' AS state,
  CASE WHEN c_nationkey % 3 = 0 THEN ' usa' WHEN c_nationkey % 3 = 1 THEN 'US' ELSE n_name END AS country,
  CASE WHEN r_regionkey = 1 THEN 'NorthAmerica' ELSE r_name END AS continent,
  CAST(c_custkey % 99999 AS INT) AS postal_zip_code, 'unknown' AS gender
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    ("src_franchises", r"""
SELECT s_suppkey AS franchiseID, s_name AS name, CASE WHEN s_acctbal > 5000 THEN 'L' ELSE 'S' END AS size,
  n_name AS district, n_name AS country,
  CAST(CASE WHEN s_nationkey % 7 = 6 THEN NULL WHEN s_suppkey % 3 = 1 THEN 1 ELSE s_suppkey - s_suppkey % 4 + 2 END
       AS BIGINT) AS supplierID,
  CAST((s_suppkey * 37) % 60 - 30 AS DOUBLE) AS latitude, CAST((s_suppkey * 73) % 120 - 60 AS DOUBLE) AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    ("src_suppliers", r"""
SELECT s_suppkey AS supplierID, s_name AS name,
  CASE s_suppkey % 6 WHEN 0 THEN 'Cacao' WHEN 1 THEN 'almonds' WHEN 2 THEN 'flour' WHEN 3 THEN 'vanilla'
       WHEN 4 THEN 'coffee' ELSE NULL END AS ingredient,
  CAST((s_suppkey * 53) % 60 - 30 AS DOUBLE) AS latitude, CAST((s_suppkey * 97) % 120 - 60 AS DOUBLE) AS longitude,
  CASE WHEN s_suppkey % 25 = 24 THEN NULL WHEN s_suppkey % 5 = 4 THEN 'N' WHEN s_suppkey % 5 = 3 THEN ' y '
       ELSE 'Y' END AS approved,
  r_name AS continent, n_name AS city, 'central' AS district, 'M' AS size
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    ("src_transactions", r"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transactionID,
  l_shipdate AS dateTime, p_type AS product,
  CASE WHEN l_partkey % 97 = 5 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
  CAST(p_retailprice AS DECIMAL(10,2)) AS unitPrice,
  CASE WHEN l_orderkey % 100 = 3 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS totalPrice,
  CASE WHEN l_orderkey % 223 = 5 THEN -1 ELSE o_custkey END AS customerID,
  CASE WHEN l_orderkey % 211 = 9 THEN -1 ELSE l_suppkey END AS franchiseID,
  'card' AS paymentMethod, CAST(NULL AS VARCHAR) AS cardNumber
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    ("src_reviews", r"""
SELECT doc_id AS new_id,
  text || CASE doc_id % 4 WHEN 0 THEN '. The service was slow' WHEN 1 THEN '. Fresh bread'
                          WHEN 2 THEN '! Good but stale' ELSE '' END AS review,
  CAST(DATE '1999-01-01' + CAST(doc_id % 120 AS INT) AS DATE) AS review_date,
  doc_id % (SELECT count(*) FROM supplier) AS franchiseID
FROM documents"""),
    # -- bronze
    ("bronze_customer_profiles", r"""
SELECT TRY_CAST(customerID AS VARCHAR) AS raw_customer_id, first_name, last_name, email_address AS email,
  phone_number AS phone, address AS physical_address, city, state, country, continent,
  TRY_CAST(postal_zip_code AS VARCHAR) AS zip_code, gender, 'src_customers' AS _source_table
FROM src_customers"""),
    ("bronze_franchise_ops", r"""
SELECT TRY_CAST(franchiseID AS VARCHAR) AS raw_store_id, name AS store_name, size AS operational_size, district,
  country, TRY_CAST(supplierID AS VARCHAR) AS primary_supplier_id, TRY_CAST(latitude AS DOUBLE) AS latitude,
  TRY_CAST(longitude AS DOUBLE) AS longitude, 'src_franchises' AS _source_table
FROM src_franchises"""),
    ("bronze_supply_chain", r"""
SELECT TRY_CAST(supplierID AS VARCHAR) AS raw_supplier_id, name AS supplier_name, ingredient AS provided_ingredients,
  TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude, approved AS approval_status,
  continent, city, district, size, 'src_suppliers' AS _source_table
FROM src_suppliers"""),
    ("bronze_pos_transactions", r"""
SELECT TRY_CAST(transactionID AS VARCHAR) AS raw_transaction_id,
  TRY_CAST(dateTime AS TIMESTAMP) AS transaction_timestamp, product AS product_sold,
  TRY_CAST(quantity AS INT) AS quantity, TRY_CAST(unitPrice AS DECIMAL(10,2)) AS unit_price,
  TRY_CAST(totalPrice AS DECIMAL(12,2)) AS total_price, TRY_CAST(customerID AS VARCHAR) AS customer_id,
  TRY_CAST(franchiseID AS VARCHAR) AS store_id, paymentMethod AS payment_method,
  TRY_CAST(cardNumber AS VARCHAR) AS card_number, 'src_transactions' AS _source_table
FROM src_transactions"""),
    ("bronze_customer_reviews", r"""
SELECT TRY_CAST(new_id AS VARCHAR) AS raw_review_id, review AS review_text,
  TRY_CAST(review_date AS DATE) AS submission_date, TRY_CAST(franchiseID AS VARCHAR) AS franchise_id,
  'src_reviews' AS _source_table
FROM src_reviews"""),
    # -- silver
    ("silver_customer_profiles", rf"""
SELECT raw_customer_id AS customer_id, first_name, last_name,
  regexp_replace(lower(email), '(^.).*(@.*$)', '\1***\2', 'g') AS masked_email,
  regexp_replace(phone, '(\d{{0,3}})\d+(\d{{2}})$', '\1****\2', 'g') AS masked_phone,
  substr(physical_address, 1, 6) || '***' AS masked_address,
  city, state, {_country('country')} AS normalized_country, {_continent('continent')} AS normalized_continent,
  zip_code, gender
FROM bronze_customer_profiles"""),
    ("silver_franchise_ops", rf"""
SELECT raw_store_id AS store_id, store_name, operational_size, district, {_country('country')} AS normalized_country,
  primary_supplier_id, latitude, longitude
FROM bronze_franchise_ops"""),
    ("silver_supply_chain", rf"""
SELECT raw_supplier_id AS supplier_id, supplier_name, provided_ingredients, latitude, longitude, true AS is_approved,
  {_continent('continent')} AS normalized_continent, city, district, size
FROM bronze_supply_chain WHERE upper(trim(approval_status)) = 'Y'"""),
    ("silver_supply_chain_quarantine", r"""
SELECT raw_supplier_id AS supplier_id, supplier_name, provided_ingredients, latitude, longitude, approval_status,
  continent, city, district, size
FROM bronze_supply_chain WHERE upper(trim(approval_status)) IS DISTINCT FROM 'Y'"""),
    ("tx_filled", r"""
SELECT raw_transaction_id AS transaction_id, transaction_timestamp, product_sold, quantity, unit_price,
  COALESCE(total_price, TRY_CAST(quantity * unit_price AS DECIMAL(12,2))) AS total_price, customer_id, store_id
FROM bronze_pos_transactions WHERE raw_transaction_id IS NOT NULL"""),
    ("tx_deduped", r"""
SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_timestamp DESC NULLS LAST,
  product_sold DESC NULLS LAST, quantity DESC NULLS LAST, unit_price DESC NULLS LAST, total_price DESC NULLS LAST,
  customer_id DESC NULLS LAST, store_id DESC NULLS LAST) AS rn
FROM tx_filled"""),
    ("silver_pos_transactions", r"""
SELECT transaction_id, transaction_timestamp, product_sold, quantity, unit_price, total_price, customer_id, store_id
FROM tx_deduped d
WHERE rn = 1 AND quantity > 0 AND unit_price > 0
  AND EXISTS (SELECT 1 FROM silver_customer_profiles c WHERE c.customer_id = d.customer_id)
  AND EXISTS (SELECT 1 FROM silver_franchise_ops f WHERE f.store_id = d.store_id)"""),
    ("silver_customer_reviews", r"""
SELECT raw_review_id AS review_id,
  list_filter(list_transform(regexp_split_to_array(
      regexp_replace(lower(review_text), '[^a-z0-9 \t\n\x0B\f\r.!?]', ' ', 'g'), '[.!?]+'),
    lambda x: trim(x)), lambda x: length(x) > 0) AS chunked_review_text,
  submission_date, franchise_id AS store_id
FROM bronze_customer_reviews"""),
    # -- gold
    ("gold_daily_franchise_health", rf"""
SELECT store_id, CAST(transaction_timestamp AS DATE) AS reporting_date,
  CAST(SUM(total_price) AS DECIMAL(23,2)) AS total_daily_revenue, CAST(SUM(quantity) AS BIGINT) AS total_items_sold,
  {_avg('total_price', 2, 2, 13)} AS avg_transaction_value
FROM silver_pos_transactions GROUP BY store_id, CAST(transaction_timestamp AS DATE)"""),
    ("visits_by_store_name", r"""
SELECT t.customer_id, f.store_name, count(*) AS n
FROM silver_pos_transactions t JOIN silver_franchise_ops f ON f.store_id = t.store_id
GROUP BY ALL"""),
    ("purchases_by_product", r"""
SELECT customer_id, product_sold, count(*) AS n FROM silver_pos_transactions GROUP BY ALL"""),
    ("gold_customer_360", r"""
WITH lifetime AS (
  SELECT customer_id, CAST(sum(total_price) AS DECIMAL(23,2)) AS total_lifetime_spend
  FROM silver_pos_transactions GROUP BY ALL),
fav_store AS (
  SELECT customer_id, first(store_name ORDER BY n DESC, store_name ASC NULLS FIRST) AS preferred_store_location
  FROM visits_by_store_name GROUP BY ALL),
fav_product AS (
  SELECT customer_id, first(product_sold ORDER BY n DESC, product_sold ASC NULLS FIRST) AS most_frequent_product
  FROM purchases_by_product GROUP BY ALL)
SELECT l.customer_id, l.total_lifetime_spend, s.preferred_store_location, p.most_frequent_product
FROM lifetime l
LEFT JOIN fav_store s ON s.customer_id = l.customer_id
LEFT JOIN fav_product p ON p.customer_id = l.customer_id"""),
    ("gold_supplier_risk_matrix", rf"""
WITH reach AS (
  SELECT s.supplier_id, count(DISTINCT f.store_id) AS stores,
    avg({_haversine('s.latitude', 's.longitude', 'f.latitude', 'f.longitude')}) AS km
  FROM silver_supply_chain s LEFT JOIN silver_franchise_ops f ON f.primary_supplier_id = s.supplier_id
  GROUP BY s.supplier_id),
scored AS (
  SELECT s.supplier_id, coalesce(r.stores, 0) AS n, coalesce(r.km, 0.0) AS km,
    {_criticality('s.provided_ingredients')} AS crit
  FROM silver_supply_chain s LEFT JOIN reach r ON r.supplier_id = s.supplier_id)
SELECT supplier_id, n AS dependent_franchise_count, km AS avg_geographic_distance,
  crit AS ingredient_criticality_score,
  (n >= 1 AND crit >= {params.CRITICAL_SCORE})
    OR (n >= {params.MANY_DEPENDANTS} AND km >= {params.FAR_DISTANCE_KM}) AS is_high_risk_flag
FROM scored"""),
    ("gold_store_sentiment_trends", rf"""
SELECT store_id, week AS reporting_period_start, CAST(week + 6 AS DATE) AS reporting_period_end,
  {_avg('score_tenths * 0.1', 1, 4, 6)} AS customer_satisfaction_score
FROM (SELECT store_id, CAST(date_trunc('week', submission_date) AS DATE) AS week, {_score_tenths('chunk')} AS score_tenths
      FROM (SELECT store_id, submission_date, UNNEST(chunked_review_text) AS chunk FROM silver_customer_reviews))
GROUP BY store_id, week"""),
    ("silver_customer_reviews_literal", r"""
SELECT raw_review_id AS review_id,
  list_filter(list_transform(regexp_split_to_array(regexp_replace(
      regexp_replace(lower(review_text), '[^a-z0-9 \t\n\x0B\f\r.!?]', ' ', 'g'), '[.!?]+', '||', 'g'), '\\|\\||'),
    lambda x: trim(x)), lambda x: length(x) > 0) AS chunked_review_text,
  submission_date, franchise_id AS store_id
FROM bronze_customer_reviews"""),
    ("gold_store_sentiment_trends_literal", rf"""
SELECT store_id, week AS reporting_period_start, CAST(week + 6 AS DATE) AS reporting_period_end,
  {_avg('score_tenths * 0.1', 1, 4, 6)} AS customer_satisfaction_score
FROM (SELECT store_id, CAST(date_trunc('week', submission_date) AS DATE) AS week, {_score_tenths('chunk')} AS score_tenths
      FROM (SELECT store_id, submission_date, UNNEST(chunked_review_text) AS chunk
            FROM silver_customer_reviews_literal))
GROUP BY store_id, week"""),
    ("gold_store_scorecard", rf"""
WITH by_name AS (
  SELECT preferred_store_location AS store_name, count(*) AS customers,
    {_avg('total_lifetime_spend', 2, 2, 24)} AS spend_2dp
  FROM gold_customer_360 GROUP BY ALL),
alert AS (
  SELECT f.store_id, bool_or(coalesce(r.is_high_risk_flag, false)) AS any_high_risk
  FROM silver_franchise_ops f LEFT JOIN gold_supplier_risk_matrix r ON r.supplier_id = f.primary_supplier_id
  GROUP BY ALL)
SELECT d.store_id, f.store_name, d.reporting_date, d.total_daily_revenue, d.total_items_sold, d.avg_transaction_value,
  CAST(coalesce(w.customer_satisfaction_score, 0) AS DECIMAL(6,4)) AS weekly_sentiment_score,
  coalesce(b.customers, 0) AS active_customer_count,
  CAST(coalesce(b.spend_2dp, 0) AS DECIMAL(24,2)) AS avg_lifetime_spend,
  coalesce(a.any_high_risk, false) AS supply_risk_alert
FROM gold_daily_franchise_health d
LEFT JOIN silver_franchise_ops f ON f.store_id = d.store_id
LEFT JOIN gold_store_sentiment_trends w
  ON w.store_id = d.store_id AND d.reporting_date BETWEEN w.reporting_period_start AND w.reporting_period_end
LEFT JOIN by_name b ON b.store_name = f.store_name
LEFT JOIN alert a ON a.store_id = d.store_id"""),
    # -- forecast panel
    ("fc_base", r"""
SELECT store_id, reporting_date, total_daily_revenue FROM gold_daily_franchise_health
WHERE total_daily_revenue IS NOT NULL"""),
    ("fc_bounds", r"""
SELECT MIN(reporting_date) AS first_day, MAX(reporting_date) AS last_day,
  date_diff('day', MIN(reporting_date), MAX(reporting_date)) + 1 AS total_days FROM fc_base"""),
    ("fc_panel", r"""
SELECT s.store_id, d.reporting_date, COALESCE(b.total_daily_revenue, 0) AS total_daily_revenue
FROM (SELECT DISTINCT store_id FROM fc_base) s
CROSS JOIN (SELECT CAST(UNNEST(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS reporting_date
            FROM fc_bounds) d
LEFT JOIN fc_base b ON b.store_id = s.store_id AND b.reporting_date = d.reporting_date"""),
    ("fc_features", r"""
SELECT store_id, reporting_date, CAST(total_daily_revenue AS DOUBLE) AS label,
  CAST(dayofweek(reporting_date) + 1 AS DOUBLE) AS day_of_week,
  CAST(dayofmonth(reporting_date) AS DOUBLE) AS day_of_month,
  CAST(month(reporting_date) AS DOUBLE) AS month,
  CAST(weekofyear(reporting_date) AS DOUBLE) AS week_of_year,
  CASE WHEN dayofweek(reporting_date) IN (0, 6) THEN 1.0 ELSE 0.0 END::DOUBLE AS is_weekend,
  CAST(date_diff('day', (SELECT first_day FROM fc_bounds), reporting_date) AS DOUBLE) AS trend_index,
  lag(CAST(total_daily_revenue AS DOUBLE), 1) OVER w AS lag_1,
  lag(CAST(total_daily_revenue AS DOUBLE), 7) OVER w AS lag_7,
  avg(CAST(total_daily_revenue AS DOUBLE)) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3,
  avg(CAST(total_daily_revenue AS DOUBLE)) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_mean_7,
  COALESCE(CASE WHEN COUNT(*) OVER week >= 2 THEN SQRT(CAST(
      CAST(COUNT(*) OVER week AS DECIMAL(4,0)) * CAST(SUM(cents * cents) OVER week AS DECIMAL(32,4))
      - CAST(SUM(cents) OVER week AS DECIMAL(18,2)) * CAST(SUM(cents) OVER week AS DECIMAL(18,2)) AS DOUBLE)
    / (COUNT(*) OVER week * (COUNT(*) OVER week - 1))) END, 0.0) AS rolling_std_7
FROM (SELECT *, CAST(total_daily_revenue AS DECIMAL(18,2)) AS cents FROM fc_panel)
WINDOW week AS (PARTITION BY store_id ORDER BY reporting_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
   w AS (PARTITION BY store_id ORDER BY reporting_date)"""),
    ("fc_usable", r"""
SELECT * FROM fc_features WHERE lag_7 IS NOT NULL AND rolling_mean_7 IS NOT NULL"""),
    # the last seven panel days of each store, oldest first
    ("fc_recent", r"""
SELECT store_id, list(CAST(total_daily_revenue AS DOUBLE) ORDER BY reporting_date) AS h
FROM fc_panel WHERE reporting_date > (SELECT last_day FROM fc_bounds) - 7 GROUP BY store_id"""),
    ("fc_split", r"""
SELECT *, CASE WHEN total_days > 14 THEN 7 ELSE GREATEST(3, CAST(floor(total_days / 3) AS INT)) END AS holdout_days,
  CAST(last_day - CAST(CASE WHEN total_days > 14 THEN 7 ELSE GREATEST(3, CAST(floor(total_days / 3) AS INT)) END
                       AS INT) AS DATE) AS split_date
FROM fc_bounds"""),
]


def _with(select: str, more: list | None = None) -> str:
    body = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in [*CTES, *(more or [])])
    return f"WITH {body}\n{select.strip()}"


def _where(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def _block(source: str, measures: dict[str, str]) -> str:
    """One scan of ``source``: one aggregate per check, unpivoted to (test_name, failed_records)."""
    cols = ", ".join(f"CAST({m} AS BIGINT) AS {name}" for name, m in measures.items())
    return (f"SELECT * FROM (SELECT {cols} FROM {source}) "
            f"UNPIVOT (failed_records FOR test_name IN ({', '.join(measures)}))")


def _checks(*blocks: str) -> str:
    union = "\nUNION ALL\n".join(blocks)
    return _with(f"SELECT test_name, failed_records, failed_records = 0 AS test_passed FROM ({union}) checks")


def _copies(table: str, key: str) -> str:
    return f"(SELECT {key}, count(*) AS copies FROM {table} GROUP BY {key}) dup"


def _missing(table: str, key: str, outer: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {table} x WHERE x.{key} = {outer}.{key})"


_EXPECTED_DAILY = f"""(SELECT store_id, CAST(transaction_timestamp AS DATE) AS reporting_date,
    CAST(SUM(total_price) AS DECIMAL(23,2)) AS rev, CAST(SUM(quantity) AS BIGINT) AS items,
    {_avg('total_price', 2, 2, 13)} AS avg_ticket
  FROM silver_pos_transactions GROUP BY ALL)"""

_DAILY_RECONCILED = f"""(SELECT e.store_id AS e_store, a.store_id AS a_store,
    e.rev IS DISTINCT FROM a.total_daily_revenue OR e.items IS DISTINCT FROM a.total_items_sold
      OR e.avg_ticket IS DISTINCT FROM a.avg_transaction_value AS differs
  FROM {_EXPECTED_DAILY} e FULL JOIN gold_daily_franchise_health a
    ON a.store_id = e.store_id AND a.reporting_date = e.reporting_date) r"""

_SPEND_RECONCILED = """(SELECT e.customer_id AS e_cust, g.customer_id AS g_cust,
    e.spend IS DISTINCT FROM g.total_lifetime_spend AS differs
  FROM (SELECT customer_id, CAST(sum(total_price) AS DECIMAL(23,2)) AS spend
        FROM silver_pos_transactions GROUP BY ALL) e
  FULL JOIN gold_customer_360 g ON g.customer_id = e.customer_id) r"""

_TX_CASTS = (("transactionID", "VARCHAR"), ("dateTime", "TIMESTAMP"), ("quantity", "INTEGER"),
             ("unitPrice", "DECIMAL(10,2)"), ("totalPrice", "DECIMAL(12,2)"), ("customerID", "VARCHAR"),
             ("franchiseID", "VARCHAR"), ("cardNumber", "VARCHAR"))

_NEGATIVE = "total_daily_revenue < 0 OR total_items_sold < 0 OR avg_transaction_value < 0"


def _check_queries() -> dict[str, str]:
    supplier_backed = ("EXISTS (SELECT 1 FROM bronze_supply_chain b WHERE b.raw_supplier_id = s.supplier_id "
                       f"AND upper(trim(b.approval_status)) = '{params.APPROVED_STATUS}')")
    return {
        "checks_foundation": _checks(
            _block(_copies("silver_pos_transactions", "transaction_id"),
                   {"duplicate_transaction_ids": _where("copies > 1")}),
            _block("silver_pos_transactions t", {
                "invalid_customer_fk_in_transactions": _where(_missing("silver_customer_profiles", "customer_id", "t")),
                "invalid_store_fk_in_transactions": _where(_missing("silver_franchise_ops", "store_id", "t"))}),
            _block("silver_supply_chain s", {"unapproved_suppliers_in_silver_supply": _where(
                f"coalesce(is_approved, false) <> true OR NOT {supplier_backed}")}),
            _block("silver_supply_chain_quarantine", {"approved_suppliers_in_quarantine": _where(
                f"upper(trim(approval_status)) = '{params.APPROVED_STATUS}'")}),
            _block("silver_customer_profiles", {
                "unmasked_email_patterns": _where("masked_email NOT LIKE '_***%@%'"),
                "unmasked_phone_patterns": _where("masked_phone NOT LIKE '%****%'")}),
            _block("silver_customer_reviews", {"reviews_without_chunks": _where(
                "chunked_review_text IS NULL OR len(chunked_review_text) = 0")})),
        "checks_contracts": _checks(
            _block("bronze_supply_chain", {"suppliers_neither_approved_nor_quarantined":
                   "abs(count(*) - (SELECT count(*) FROM silver_supply_chain)"
                   " - (SELECT count(*) FROM silver_supply_chain_quarantine))"}),
            _block("src_transactions", {"transaction_cast_failures": _where(" OR ".join(
                f"({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL)" for c, t in _TX_CASTS))}),
            _block(_copies("silver_customer_profiles", "customer_id"), {"duplicate_customer_ids": _where("copies > 1")}),
            _block(_copies("silver_franchise_ops", "store_id"), {"duplicate_store_ids": _where("copies > 1")}),
            _block(_copies("silver_supply_chain", "supplier_id"), {"duplicate_supplier_ids": _where("copies > 1")})),
        "checks_daily": _checks(
            _block(_DAILY_RECONCILED, {"aggregation_mismatch_vs_silver": _where(
                "e_store IS NULL OR a_store IS NULL OR differs")}),
            _block("gold_daily_franchise_health", {
                "negative_metrics": _where(_NEGATIVE),
                "null_store_or_date": _where("store_id IS NULL OR reporting_date IS NULL")})),
        "checks_customer_360": _checks(
            _block(_copies("gold_customer_360", "customer_id"), {"duplicate_customer_rows": _where("copies > 1")}),
            _block("gold_customer_360", {
                "null_customer_id": _where("customer_id IS NULL"),
                "null_preference_fields_for_transacting_customers": _where(
                    "preferred_store_location IS NULL OR most_frequent_product IS NULL")}),
            _block(_SPEND_RECONCILED, {"spend_mismatch_vs_silver": _where(
                "e_cust IS NULL OR g_cust IS NULL OR differs")})),
        "checks_supplier_risk": _checks(
            _block("silver_supply_chain s", {"missing_suppliers_in_risk_matrix": _where(
                _missing("gold_supplier_risk_matrix", "supplier_id", "s"))}),
            _block("gold_supplier_risk_matrix", {
                "criticality_out_of_range": _where("ingredient_criticality_score NOT IN (2, 3, 5)"),
                "negative_distance": _where("avg_geographic_distance < 0"),
                "null_primary_fields": _where("supplier_id IS NULL OR is_high_risk_flag IS NULL")})),
        "checks_sentiment": _checks(
            _block("gold_store_sentiment_trends", {
                "sentiment_score_out_of_bounds": _where(
                    "customer_satisfaction_score < -1 OR customer_satisfaction_score > 1"),
                "invalid_reporting_period_span": _where(
                    "date_diff('day', reporting_period_start, reporting_period_end) <> 6"),
                "null_store_or_period": _where(
                    "store_id IS NULL OR reporting_period_start IS NULL OR reporting_period_end IS NULL")})),
        "checks_scorecard": _checks(
            _block("gold_store_scorecard", {
                "scorecard_row_count_matches_daily_health":
                    "abs((SELECT count(*) FROM gold_daily_franchise_health) - count(*))",
                "null_primary_keys": _where("store_id IS NULL OR reporting_date IS NULL"),
                "negative_core_metrics": _where(_NEGATIVE)})),
    }


def _mask(admin: bool) -> str:
    def m(c):
        if admin:
            return f"{c} AS {c}"
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE substr({c}, 1, 2) || '***' END AS {c}"
    return _with(f"SELECT raw_customer_id, {m('email')}, {m('phone')}, {m('physical_address')} "
                 f"FROM bronze_customer_profiles")


# -- tuned forecast: the fitted trees come as a table of nodes (tree, node, feature, threshold, left, right, value,
# weight) that the Spark query stored; features, walks, metrics and the recursion are computed here.

def _walk(rows: str, key: str, nodes: str) -> str:
    """(key, candidate, prediction): every row of ``rows`` (key, x) walked down every tree of ``nodes``."""
    return f"""(WITH RECURSIVE walk AS (
    SELECT r.{key}, r.x, n.* FROM {rows} r, {nodes} n WHERE n.node = 0
    UNION ALL
    SELECT w.{key}, w.x, n.* FROM walk w JOIN {nodes} n ON n.candidate = w.candidate AND n.tree = w.tree
      AND n.node = CASE WHEN w.x[w.feature + 1] <= w.threshold THEN w."left" ELSE w."right" END
    WHERE w."left" >= 0)
  SELECT {key}, candidate, SUM(weight * value) AS prediction FROM walk WHERE "left" < 0 GROUP BY {key}, candidate)"""


def _tuned_ctes(nodes: str, candidates) -> list[tuple[str, str]]:
    grid = ", ".join(f"({i}, '{c['algorithm']}', '{json.dumps(dict(c), sort_keys=True)}')" for i, c in enumerate(candidates))
    return [
        ("fc_nodes", f"SELECT * FROM read_parquet('{nodes.removeprefix('file:')}/*.parquet')"),
        ("fc_grid", f"SELECT * FROM (VALUES {grid}) AS g(candidate, algorithm, config_json)"),
        ("fc_train", """SELECT u.store_id, CAST(u.label AS DECIMAL(18,2)) AS cents
FROM fc_usable u, fc_split s WHERE u.reporting_date <= s.split_date"""),
        ("fc_mean", "SELECT CAST(SUM(cents) AS DOUBLE) / COUNT(*) AS mean, COUNT(*) AS train_rows FROM fc_train"),
        ("fc_level", """SELECT store_id, (CAST(SUM(cents) AS DOUBLE) + 20 * ANY_VALUE(mean)) / (COUNT(*) + 20) AS store_level
FROM fc_train, fc_mean GROUP BY store_id"""),
        ("fc_test", """SELECT ROW_NUMBER() OVER () AS rid, u.label, [COALESCE(l.store_level, m.mean), day_of_week, day_of_month, month,
    week_of_year, is_weekend, trend_index, lag_1, lag_7, rolling_mean_3, rolling_mean_7, rolling_std_7] AS x
FROM fc_usable u CROSS JOIN fc_split s CROSS JOIN fc_mean m LEFT JOIN fc_level l ON l.store_id = u.store_id
WHERE u.reporting_date > s.split_date"""),
        ("fc_scored", f"""SELECT p.candidate, COUNT(*) AS test_rows, SQRT(AVG((t.label - p.prediction) ** 2)) AS rmse,
  AVG(ABS(t.label - p.prediction)) AS mae,
  1 - SUM((t.label - p.prediction) ** 2) / (VAR_SAMP(t.label) * (COUNT(*) - 1)) AS r2
FROM fc_test t JOIN {_walk('fc_test', 'rid', 'fc_nodes')} p USING (rid) GROUP BY p.candidate"""),
        ("fc_winner", """SELECT s.*, g.algorithm, 'sales_forecast_' || g.algorithm || '_lag_tuned' AS model_name
FROM fc_scored s JOIN fc_grid g USING (candidate) ORDER BY s.rmse, s.candidate LIMIT 1"""),
    ]


def _forecast_days(nodes: str, candidates) -> str:
    """The recursive forecast: one walk down the winner's trees for each day, fed back into the history."""
    ctes = [*_tuned_ctes(nodes, candidates),
            ("fc_best", "SELECT n.* FROM fc_nodes n JOIN fc_winner w USING (candidate)"),
            ("fc_day0", """SELECT r.store_id, r.h, COALESCE(l.store_level, m.mean) AS store_level
FROM fc_recent r CROSS JOIN fc_mean m LEFT JOIN fc_level l ON l.store_id = r.store_id""")]
    for k in range(1, params.FORECAST_HORIZON_DAYS + 1):
        ctes += [(f"fc_x{k}", f"""SELECT store_id, h, store_level, [store_level, CAST(dayofweek(d) + 1 AS DOUBLE),
    CAST(dayofmonth(d) AS DOUBLE), CAST(month(d) AS DOUBLE), CAST(weekofyear(d) AS DOUBLE),
    CASE WHEN dayofweek(d) IN (0, 6) THEN 1.0 ELSE 0.0 END::DOUBLE, CAST(total_days - 1 + {k} AS DOUBLE), h[7], h[1],
    (h[5] + h[6] + h[7]) / 3, list_sum(h) / 7, SQRT(CAST(7 * squares - total * total AS DOUBLE) / 42)] AS x
FROM (SELECT p.*, total_days, CAST(last_day + {k} AS DATE) AS d,
        CAST((SELECT SUM(CAST(v AS DECIMAL(18,2))) FROM UNNEST(h) t(v)) AS DECIMAL(18,2)) AS total,
        CAST((SELECT SUM(CAST(v AS DECIMAL(18,2)) * CAST(v AS DECIMAL(18,2))) FROM UNNEST(h) t(v)) AS DECIMAL(32,4)) AS squares
      FROM fc_day{k - 1} p, fc_bounds)"""),
                 (f"fc_day{k}", f"""SELECT store_id, list_append(h[2:], ROUND(prediction, 2)) AS h, store_level
FROM fc_x{k} JOIN {_walk(f'fc_x{k}', 'store_id', 'fc_best')} p USING (store_id)""")]
    # each step once, not once for each day that follows
    ctes = [(name + (" " if not name.startswith(("fc_x", "fc_day", "fc_best", "fc_winner")) else " AS MATERIALIZED "), sql)
            for name, sql in ctes]
    days = " UNION ALL ".join(f"SELECT {k} AS step, store_id, h FROM fc_day{k}"
                              for k in range(1, params.FORECAST_HORIZON_DAYS + 1))
    body = ",\n".join([f"{name} AS ({sql.strip()})" for name, sql in CTES]
                      + [f"{name if 'MATERIALIZED' in name else name + 'AS'} ({sql.strip()})" for name, sql in ctes])
    return f"""WITH {body}
SELECT store_id, CAST(last_day + step AS DATE) AS forecast_date, h[7] AS predicted_daily_revenue, model_name
FROM ({days}), fc_bounds, fc_winner"""


def tuned_oracles(candidates=params.DEFAULT_CANDIDATES) -> dict[str, str]:
    """SQL of the queries that fit the candidates, over the nodes that they stored."""
    nodes = nodes_path(SparkSession.getActiveSession())
    ctes = _tuned_ctes(nodes, candidates)
    return {
        "forecast_tuning": _with("""
SELECT algorithm, config_json, ROUND(rmse, 4) AS rmse, ROUND(mae, 4) AS mae, ROUND(r2, 6) AS r2
FROM fc_scored JOIN fc_grid USING (candidate)""", ctes),
        "forecast_next_14_days": _forecast_days(nodes, candidates),
        "forecast_run_log": _with("""
SELECT model_name, train_rows, test_rows, ROUND(rmse, 4) AS rmse, ROUND(mae, 4) AS mae, ROUND(r2, 6) AS r2,
  CAST(1 AS BIGINT) AS registry_rows
FROM fc_winner, fc_mean""", ctes),
    }


def oracle_queries() -> dict[str, str]:
    return {
        "bronze_customers": _with("SELECT * FROM bronze_customer_profiles"),
        "bronze_stores": _with("SELECT * FROM bronze_franchise_ops"),
        "bronze_suppliers": _with("SELECT * FROM bronze_supply_chain"),
        "bronze_transactions": _with("SELECT * FROM bronze_pos_transactions"),
        "bronze_reviews": _with("SELECT * FROM bronze_customer_reviews"),
        "silver_customers_masked": _with("SELECT * FROM silver_customer_profiles"),
        "silver_stores": _with("SELECT * FROM silver_franchise_ops"),
        "silver_suppliers_approved": _with("SELECT * FROM silver_supply_chain"),
        "silver_suppliers_quarantine": _with("SELECT * FROM silver_supply_chain_quarantine"),
        "silver_transactions": _with("SELECT * FROM silver_pos_transactions"),
        "silver_review_chunks": _with("""
SELECT r.review_id, CAST(u.pos - 1 AS INT) AS pos, u.chunk
FROM silver_customer_reviews r, UNNEST(r.chunked_review_text) WITH ORDINALITY AS u(chunk, pos)"""),
        "gold_daily_store_health": _with("SELECT * FROM gold_daily_franchise_health"),
        "gold_customer_360": _with("SELECT * FROM gold_customer_360"),
        "gold_supplier_risk": _with("""
SELECT supplier_id, dependent_franchise_count, ROUND(avg_geographic_distance, 6) AS avg_geographic_distance,
  ingredient_criticality_score, is_high_risk_flag FROM gold_supplier_risk_matrix"""),
        "gold_weekly_sentiment": _with("SELECT * FROM gold_store_sentiment_trends"),
        "gold_weekly_sentiment_literal": _with("SELECT * FROM gold_store_sentiment_trends_literal"),
        "gold_store_scorecard": _with("SELECT * FROM gold_store_scorecard"),
        **_check_queries(),
        "forecast_panel_features": _with("""
SELECT store_id, reporting_date, label, day_of_week, day_of_month, month, week_of_year, is_weekend, trend_index,
  lag_1, lag_7, ROUND(rolling_mean_3, 6) AS rolling_mean_3, ROUND(rolling_mean_7, 6) AS rolling_mean_7,
  ROUND(rolling_std_7, 6) AS rolling_std_7
FROM fc_usable"""),
        "forecast_holdout_split": _with("""
SELECT CASE WHEN u.reporting_date <= s.split_date THEN 'train' ELSE 'test' END AS split, COUNT(*) AS rows,
  ANY_VALUE(s.holdout_days) AS holdout_days, ANY_VALUE(s.split_date) AS split_date
FROM fc_usable u, fc_split s GROUP BY 1"""),
        "forecast_first_step_features": _with("""
SELECT store_id, reporting_date, CAST(dayofweek(reporting_date) + 1 AS DOUBLE) AS day_of_week,
  CAST(dayofmonth(reporting_date) AS DOUBLE) AS day_of_month, CAST(month(reporting_date) AS DOUBLE) AS month,
  CAST(weekofyear(reporting_date) AS DOUBLE) AS week_of_year,
  CASE WHEN dayofweek(reporting_date) IN (0, 6) THEN 1.0 ELSE 0.0 END::DOUBLE AS is_weekend,
  CAST(total_days AS DOUBLE) AS trend_index, h[-1] AS lag_1, h[1] AS lag_7,
  ROUND((h[5] + h[6] + h[7]) / 3, 6) AS rolling_mean_3, ROUND(list_sum(h) / 7, 6) AS rolling_mean_7,
  ROUND(SQRT(CAST(7 * squares - total * total AS DOUBLE) / 42), 6) AS rolling_std_7
FROM (SELECT store_id, h, total_days, CAST(last_day + 1 AS DATE) AS reporting_date,
        CAST((SELECT SUM(CAST(x AS DECIMAL(18,2))) FROM UNNEST(h) t(x)) AS DECIMAL(18,2)) AS total,
        CAST((SELECT SUM(CAST(x AS DECIMAL(18,2)) * CAST(x AS DECIMAL(18,2))) FROM UNNEST(h) t(x)) AS DECIMAL(32,4))
          AS squares
      FROM fc_recent, fc_bounds)"""),
        "forecast_recursion_mean7": _with(f"""
SELECT store_id, CAST(last_day + step AS DATE) AS forecast_date, h[-1] AS predicted_daily_revenue,
  'mean7' AS model_name
FROM (WITH RECURSIVE days AS (
        SELECT store_id, 0 AS step, h FROM fc_recent
        UNION ALL
        SELECT store_id, step + 1, list_append(h[2:], ROUND(list_sum(h) / 7, 2)) FROM days
        WHERE step < {params.FORECAST_HORIZON_DAYS})
      SELECT * FROM days WHERE step > 0), fc_bounds"""),
        **tuned_oracles(),
        "gold_store_scorecard_by_period": _with("""
SELECT d.store_id, f.store_name, d.reporting_date, d.total_daily_revenue, d.total_items_sold, d.avg_transaction_value,
  p.period_start, p.period_end, CAST(coalesce(p.score, 0) AS DECIMAL(6,4)) AS period_sentiment_score
FROM gold_daily_franchise_health d
LEFT JOIN silver_franchise_ops f ON f.store_id = d.store_id
LEFT JOIN (SELECT store_id, reporting_period_start AS period_start, customer_satisfaction_score AS score,
             CASE WHEN row_number() OVER (PARTITION BY store_id ORDER BY reporting_period_start DESC) > 1
                  THEN CAST(reporting_period_end + 30 AS DATE) END AS period_end
           FROM gold_store_sentiment_trends) p
  ON p.store_id = d.store_id AND d.reporting_date BETWEEN p.period_start AND coalesce(p.period_end, DATE '9999-12-31')"""),
        "catalog_store_scorecard": _with("SELECT * FROM gold_store_scorecard"),
        "mask_pii_admin": _mask(True),
        "mask_pii_user": _mask(False),
    }
