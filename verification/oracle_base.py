"""DuckDB side of the checks: the source mapping and the cleaned tables as SQL.

Written from the definitions, not from the Spark plans: KPI queries really build the joined
rows that the Spark side replaces by weights.
"""

from __future__ import annotations

from tidemark.sources.schemas import source_columns
from tidemark.sources.star import LOAD_INSTANT, LOAD_LAG_HOURS

STAMP = "'%Y-%m-%d %H:%M:%S'"
DAY = "'%Y-%m-%d'"

SOURCE = {
    "orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE o_orderstatus WHEN 'P' THEN 'canceled' WHEN 'F' THEN ' Delivered ' ELSE 'SHIPPED' END AS order_status,
               CASE WHEN o_orderkey % 307 <> 0
                    THEN strftime(o_orderdate + to_hours(o_orderkey % 24), {STAMP}) END AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 97 = 0 THEN 'bad'
                    ELSE strftime(o_orderdate + to_hours(o_orderkey % 24 + 1), {STAMP}) END AS order_approved_at,
               strftime(o_orderdate + INTERVAL 2 DAY, {DAY}) AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'P'
                    THEN strftime(o_orderdate + to_hours(24 * (o_orderkey % 20) + 10), {STAMP}) END AS order_delivered_customer_date,
               strftime(o_orderdate + INTERVAL 12 DAY, {DAY}) AS order_estimated_delivery_date
        FROM orders JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR o_orderkey % 500 = 7""",
    "order_items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               strftime(l_shipdate, {STAMP}) AS shipping_limit_date,
               CASE WHEN l_orderkey % 101 <> 0 THEN l_extendedprice END AS price,
               CASE WHEN l_tax = 0 THEN 0.0::DOUBLE ELSE l_quantity END AS freight_value
        FROM lineitem""",
    "order_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN ' Credit_Card' WHEN 'N' THEN 'BOLETO' ELSE 'voucher ' END AS payment_type,
               CAST(l_partkey % 4 + 1 AS INTEGER) AS payment_installments,
               CASE WHEN NOT (l_orderkey % 103 = 0 AND l_linenumber = 1) THEN l_extendedprice END AS payment_value
        FROM lineitem""",
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CASE WHEN c_custkey % 113 <> 0 THEN c_name END AS customer_unique_id,
               ' ' || CAST(c_nationkey * 40 + c_custkey % 40 AS VARCHAR) AS customer_zip_code_prefix,
               '  ' || c_mktsegment AS customer_city, lower(n_name) || ' ' AS customer_state
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 10 <> 0 THEN ' ' || upper(p_type) END AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght, p_size * 10 AS product_description_lenght,
               p_size % 5 AS product_photos_qty, CAST(p_size * 100 AS DOUBLE) AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size AS DOUBLE) / 2 AS product_height_cm,
               CAST(p_size AS DOUBLE) / 4 AS product_width_cm
        FROM part""",
    "sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               ' ' || CAST(s_nationkey * 40 + s_suppkey % 40 AS VARCHAR) AS seller_zip_code_prefix,
               ' City ' || CAST(s_suppkey % 37 AS VARCHAR) AS seller_city, lower(n_name) || ' ' AS seller_state
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "order_reviews": f"""
        SELECT 'r' || o_orderkey || '-' || number AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(CASE WHEN number = 2 THEN o_orderkey % 5 + 1
                         WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 7 END AS INTEGER) AS review_score,
               CASE WHEN o_orderkey % 3 <> 0 THEN ' Title ' || o_custkey || ' ' END AS review_comment_title,
               CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '   '
                    ELSE '  ' || o_orderpriority || ' ok ' END AS review_comment_message,
               strftime(o_orderdate + INTERVAL 1 DAY, {DAY}) AS review_creation_date,
               CASE WHEN o_orderkey % 89 = 0 THEN 'bad'
                    ELSE strftime(o_orderdate + to_hours(24 * (o_orderkey % 4 + 1) + 9), {STAMP}) END AS review_answer_timestamp
        FROM orders JOIN (VALUES (1), (2)) AS c(number) ON number = 1 OR o_orderkey % 11 = 0""",
    "geolocation": """
        SELECT ' ' || CAST(c_nationkey * 40 + c_custkey % 40 AS VARCHAR) AS geolocation_zip_code_prefix,
               (c_custkey % 8) / 8.0::DOUBLE - (c_custkey % 45) AS geolocation_lat,
               -34.0::DOUBLE - (c_custkey % 45) + (c_custkey % 8) / 8.0::DOUBLE AS geolocation_lng,
               c_mktsegment || ' ' AS geolocation_city, ' sp ' AS geolocation_state
        FROM customer""",
}


def row_hash(table: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in source_columns(table))
    return f"md5(concat_ws('|', {parts}))"


def bronze(table: str) -> str:
    """The bronze table: source columns plus the four metadata columns."""
    return f"""
        SELECT *, TIMESTAMP '{LOAD_INSTANT}' - to_hours({LOAD_LAG_HOURS[table]})
                  - to_days(CAST(length({source_columns(table)[0]}) % 3 AS INTEGER)) AS _ingestion_timestamp,
               'olist_{table}_dataset.csv' AS _source_file, '1.0.0' AS _pipeline_version
        FROM (SELECT *, {row_hash(table)} AS _row_hash FROM ({SOURCE[table]}))"""


def ratio(numerator: str, denominator: str, places: int) -> str:
    """numerator / denominator of whole numbers, rounded half up, as a double."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    scale = 10**places
    return (
        f"CASE WHEN {d} <> 0 THEN (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
        f"CAST((2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d})) AS DOUBLE) / {scale} END"
    )


def cents(column: str) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(18, 4)) * 100, 0) AS HUGEINT)"


SILVER = {
    "orders": """
        SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
               bought AS order_purchase_timestamp,
               TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
               TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
               arrived AS order_delivered_customer_date, promised AS order_estimated_delivery_date,
               CAST(year(bought) AS INTEGER) AS order_year, CAST(month(bought) AS INTEGER) AS order_month,
               CAST(quarter(bought) AS INTEGER) AS order_quarter,
               CAST(dayofweek(bought) + 1 AS INTEGER) AS order_day_of_week, CAST(bought AS DATE) AS order_date,
               CAST(CAST(arrived AS DATE) - CAST(bought AS DATE) AS INTEGER) AS delivery_days,
               coalesce(arrived <= promised, false) AS delivered_on_time
        FROM (SELECT *, TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS bought,
                     TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS arrived,
                     TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS promised FROM b_orders)
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "order_items": """
        SELECT order_id, order_item_id, product_id, seller_id,
               TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date, price, freight_value,
               CAST(CAST(price AS DECIMAL(18, 2)) + CAST(freight_value AS DECIMAL(18, 2)) AS DOUBLE) AS total_item_value,
               coalesce(freight_value = 0, false) AS is_free_shipping
        FROM b_order_items WHERE price IS NOT NULL""",
    "order_payments": """
        SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type, payment_installments,
               CAST(CAST(payment_value AS DECIMAL(18, 2)) AS DOUBLE) AS payment_value,
               CAST(payment_value AS DECIMAL(18, 2)) > 1000 AS is_high_value,
               coalesce(payment_installments > 1, false) AS is_installment
        FROM b_order_payments WHERE payment_value IS NOT NULL""",
    "customers": """
        SELECT customer_id, customer_unique_id, trim(customer_zip_code_prefix) AS customer_zip_code_prefix,
               lower(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state
        FROM b_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL""",
    "products": """
        SELECT product_id, coalesce(lower(trim(product_category_name)), 'uncategorized') AS product_category_name,
               product_name_lenght, product_description_lenght, product_photos_qty, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm,
               CAST(round(CAST(product_length_cm * product_height_cm * product_width_cm AS DECIMAL(18, 3)), 2) AS DOUBLE) AS product_volume_cm3
        FROM b_products WHERE product_id IS NOT NULL""",
    "sellers": """
        SELECT seller_id, trim(seller_zip_code_prefix) AS seller_zip_code_prefix,
               lower(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state
        FROM b_sellers WHERE seller_id IS NOT NULL""",
    "order_reviews": """
        SELECT review_id, order_id, review_score, trim(review_comment_title) AS review_comment_title,
               trim(review_comment_message) AS review_comment_message,
               TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
               TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp,
               CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3 THEN 'neutral'
                    WHEN review_score <= 2 THEN 'negative' ELSE 'unknown' END AS review_sentiment,
               coalesce(length(trim(review_comment_message)) > 0, false) AS has_comment,
               CAST(CAST(TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS DATE)
                    - CAST(TRY_CAST(review_creation_date AS TIMESTAMP) AS DATE) AS INTEGER) AS days_to_answer
        FROM b_order_reviews
        WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5""",
    "geolocation": f"""
        SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state,
               {ratio("sum(CAST(geolocation_lat * 1000 AS BIGINT))", "1000 * count(*)", 6)} AS geolocation_lat,
               {ratio("sum(CAST(geolocation_lng * 1000 AS BIGINT))", "1000 * count(*)", 6)} AS geolocation_lng
        FROM (SELECT trim(geolocation_zip_code_prefix) AS geolocation_zip_code_prefix,
                     lower(trim(geolocation_city)) AS geolocation_city,
                     upper(trim(geolocation_state)) AS geolocation_state, geolocation_lat, geolocation_lng
              FROM b_geolocation)
        WHERE geolocation_lat BETWEEN -35 AND 5 AND geolocation_lng BETWEEN -74 AND -34
              AND geolocation_zip_code_prefix IS NOT NULL
        GROUP BY ALL""",
}


def with_tables(body: str, bronze_tables: tuple[str, ...] = (), silver_tables: tuple[str, ...] = ()) -> str:
    """``body`` with CTEs ``b_<table>`` and ``s_<table>`` for the named tables."""
    parts = [f"b_{t} AS ({bronze(t)})" for t in dict.fromkeys(bronze_tables + silver_tables)]
    parts += [f"s_{t} AS ({SILVER[t]})" for t in silver_tables]
    return f"WITH {', '.join(parts)}\n{body}"


def ratio_units(numerator: str, denominator: str, places: int) -> str:
    """Non-negative numerator / denominator, half up, as a whole number of 10^-places."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"((2 * {n} * {10**places} + {d}) // (2 * {d}))"


def ratio_text(numerator: str, denominator: str, places: int) -> str:
    units, scale = ratio_units(numerator, denominator, places), 10**places
    return f"(({units} // {scale}) || '.' || lpad(CAST({units} % {scale} AS VARCHAR), {places}, '0'))"
