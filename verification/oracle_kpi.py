"""DuckDB SQL for the silver tables and the KPI tables."""

from __future__ import annotations

from tidemark.config import TABLES
from verification.oracle_base import SILVER, cents, ratio, with_tables

PAID = "order_status IN ('delivered', 'shipped', 'invoiced')"


def _day_columns(source: str, prev: str = "prev") -> str:
    return f"""
        SELECT order_date, order_year, order_month, order_quarter,
               CAST(revenue AS DOUBLE) / 100 AS total_revenue, order_count, avg_order_value,
               CAST(freight AS DOUBLE) / 100 AS total_freight, avg_delivery_days, on_time_deliveries,
               CAST({prev} AS DOUBLE) / 100 AS prev_day_revenue,
               {ratio(f"(revenue - {prev}) * 100", prev, 2)} AS revenue_change_pct
        FROM (SELECT *, lag(revenue) OVER (ORDER BY order_date NULLS FIRST) AS prev FROM ({source}))"""


DAILY = with_tables(
    _day_columns(f"""
        SELECT order_date, order_year, order_month, order_quarter,
               sum({cents("payment_value")}) AS revenue, count(DISTINCT order_id) AS order_count,
               {ratio(f"sum({cents('payment_value')})", "100 * count(payment_value)", 2)} AS avg_order_value,
               sum(freight) AS freight,
               {ratio("sum(delivery_days)", "count(delivery_days)", 1)} AS avg_delivery_days,
               CAST(count(*) FILTER (delivered_on_time) AS BIGINT) AS on_time_deliveries
        FROM s_orders
        LEFT JOIN s_order_payments USING (order_id)
        LEFT JOIN (SELECT order_id, sum({cents("freight_value")}) AS freight FROM s_order_items GROUP BY 1)
             USING (order_id)
        WHERE {PAID} GROUP BY ALL"""),
    silver_tables=("orders", "order_payments", "order_items"),
)

DAILY_ORDER_GRAIN = with_tables(
    _day_columns(f"""
        SELECT order_date, order_year, order_month, order_quarter, sum(paid) AS revenue,
               count(*) AS order_count, {ratio("sum(paid)", "100 * count(paid)", 2)} AS avg_order_value,
               sum(freight) AS freight, {ratio("sum(delivery_days)", "count(delivery_days)", 1)} AS avg_delivery_days,
               CAST(count(*) FILTER (delivered_on_time) AS BIGINT) AS on_time_deliveries
        FROM (SELECT DISTINCT * FROM s_orders)
        LEFT JOIN (SELECT order_id, sum({cents("payment_value")}) AS paid FROM s_order_payments GROUP BY 1)
             USING (order_id)
        LEFT JOIN (SELECT order_id, sum({cents("freight_value")}) AS freight FROM s_order_items GROUP BY 1)
             USING (order_id)
        WHERE {PAID} GROUP BY ALL"""),
    silver_tables=("orders", "order_payments", "order_items"),
)

_CATEGORY = f"""
    SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
    FROM (SELECT product_category_name, CAST(sum({cents("price")}) AS DOUBLE) / 100 AS total_revenue,
                 count(DISTINCT order_id) AS order_count, count(product_id) AS items_sold,
                 {ratio(f"sum({cents('price')})", "100 * count(price)", 2)} AS avg_item_price,
                 CAST(sum({cents("freight_value")}) AS DOUBLE) / 100 AS total_freight
          FROM s_order_items LEFT JOIN s_products USING (product_id) JOIN s_orders USING (order_id)
          WHERE {PAID} GROUP BY 1)"""
_CATEGORY_TABLES = ("orders", "order_items", "products")

_STATE = f"""
    SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
    FROM (SELECT customer_state, CAST(sum({cents("payment_value")}) AS DOUBLE) / 100 AS total_revenue,
                 count(DISTINCT order_id) AS order_count,
                 {ratio(f"sum({cents('payment_value')})", "100 * count(payment_value)", 2)} AS avg_order_value,
                 {ratio("sum(CAST(round(CAST(geolocation_lat AS DECIMAL(18, 6)) * 1000000, 0) AS HUGEINT))",
                        "1000000 * count(geolocation_lat)", 4)} AS state_lat,
                 {ratio("sum(CAST(round(CAST(geolocation_lng AS DECIMAL(18, 6)) * 1000000, 0) AS HUGEINT))",
                        "1000000 * count(geolocation_lng)", 4)} AS state_lng
          FROM s_orders LEFT JOIN s_order_payments USING (order_id) LEFT JOIN s_customers USING (customer_id)
          LEFT JOIN s_geolocation ON customer_zip_code_prefix = geolocation_zip_code_prefix
          WHERE {PAID} GROUP BY 1)"""

_STATE_ORDER_GRAIN = f"""
    SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
    FROM (SELECT customer_state, CAST(sum(paid) AS DOUBLE) / 100 AS total_revenue, count(*) AS order_count,
                 {ratio("sum(paid)", "100 * count(paid)", 2)} AS avg_order_value
          FROM (SELECT DISTINCT order_id, customer_id FROM s_orders WHERE {PAID})
          LEFT JOIN s_customers USING (customer_id)
          LEFT JOIN (SELECT order_id, sum({cents("payment_value")}) AS paid FROM s_order_payments GROUP BY 1)
               USING (order_id)
          GROUP BY 1)"""

_SATISFACTION = f"""
    SELECT *, CASE WHEN avg_review_score >= 4 THEN 'High' WHEN avg_review_score >= 3 THEN 'Medium' ELSE 'Low' END
              AS satisfaction_level
    FROM (SELECT product_category_name, order_year, order_month, order_quarter,
                 {ratio("sum(review_score)", "count(review_score)", 2)} AS avg_review_score, count(*) AS total_reviews,
                 count(*) FILTER (review_sentiment = 'positive') AS positive_reviews,
                 count(*) FILTER (review_sentiment = 'neutral') AS neutral_reviews,
                 count(*) FILTER (review_sentiment = 'negative') AS negative_reviews,
                 count(*) FILTER (has_comment) AS reviews_with_comments,
                 {ratio("sum(days_to_answer)", "count(days_to_answer)", 1)} AS avg_days_to_answer
          FROM s_order_reviews LEFT JOIN s_orders USING (order_id)
          LEFT JOIN s_order_items USING (order_id) LEFT JOIN s_products USING (product_id)
          GROUP BY 1, 2, 3, 4)"""

_SELLER = f"""
    SELECT *, CASE WHEN revenue_rank <= 100 THEN 'Top Seller' WHEN revenue_rank <= 500 THEN 'Mid Tier'
              ELSE 'Standard' END AS performance_tier
    FROM (SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
    FROM (SELECT seller_id, seller_city, seller_state, CAST(sum({cents("price")}) AS DOUBLE) / 100 AS total_revenue,
                 count(DISTINCT order_id) AS order_count, count(*) AS items_sold,
                 {ratio(f"sum({cents('price')})", "100 * count(price)", 2)} AS avg_item_price,
                 {ratio("sum(review_score)", "count(review_score)", 2)} AS avg_review_score,
                 {ratio("sum(delivery_days)", "count(delivery_days)", 1)} AS avg_delivery_days,
                 count(*) FILTER (delivered_on_time) AS on_time_deliveries
          FROM s_order_items LEFT JOIN s_sellers USING (seller_id) JOIN s_orders USING (order_id)
          LEFT JOIN s_order_reviews USING (order_id)
          WHERE {PAID} GROUP BY 1, 2, 3))"""
_SELLER_TABLES = ("orders", "order_items", "sellers", "order_reviews")

_SELLER_ORDER_GRAIN = f"""
    SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
    FROM (SELECT seller_id, CAST(sum(paid) AS DOUBLE) / 100 AS total_revenue, count(*) AS order_count,
                 CAST(sum(items) AS BIGINT) AS items_sold,
                 {ratio("sum(paid)", "100 * sum(priced)", 2)} AS avg_item_price,
                 {ratio("sum(score_sum)", "sum(score_n)", 2)} AS avg_review_score,
                 count(*) FILTER (delivered_on_time) AS on_time_orders
          FROM (SELECT order_id, seller_id, sum({cents("price")}) AS paid, count(price) AS priced, count(*) AS items
                FROM s_order_items GROUP BY 1, 2)
          JOIN (SELECT DISTINCT order_id, delivered_on_time FROM s_orders WHERE {PAID}) USING (order_id)
          LEFT JOIN (SELECT order_id, sum(review_score) AS score_sum, count(review_score) AS score_n
                     FROM s_order_reviews GROUP BY 1) USING (order_id)
          GROUP BY 1)"""

QUERIES: dict[str, str] = {
    "gold_daily_revenue": DAILY,
    "gold_revenue_by_category": with_tables(_CATEGORY, silver_tables=_CATEGORY_TABLES),
    "gold_revenue_by_state": with_tables(
        _STATE, silver_tables=("orders", "order_payments", "customers", "geolocation")
    ),
    "gold_customer_satisfaction": with_tables(
        _SATISFACTION, silver_tables=("order_reviews", "orders", "order_items", "products")
    ),
    "gold_seller_performance": with_tables(_SELLER, silver_tables=_SELLER_TABLES),
    "order_status_share": with_tables(
        f"""SELECT order_status, count(*) AS order_count,
                   {ratio("count(*) * 100", "sum(count(*)) OVER ()", 2)} AS pct
            FROM b_orders GROUP BY 1""",
        bronze_tables=("orders",),
    ),
    "top_seller_cities": with_tables(
        f"""SELECT seller_city, CAST(sum({cents("total_revenue")}) AS DOUBLE) / 100 AS total_revenue, count(*) AS sellers
            FROM ({_SELLER}) GROUP BY 1 ORDER BY total_revenue DESC, seller_city LIMIT 10""",
        silver_tables=_SELLER_TABLES,
    ),
    "top_categories": with_tables(
        f"""SELECT product_category_name, total_revenue, revenue_rank FROM ({_CATEGORY})
            ORDER BY total_revenue DESC, product_category_name LIMIT 10""",
        silver_tables=_CATEGORY_TABLES,
    ),
    "daily_revenue_order_grain": DAILY_ORDER_GRAIN,
    "state_revenue_order_grain": with_tables(
        _STATE_ORDER_GRAIN, silver_tables=("orders", "order_payments", "customers")
    ),
    "seller_performance_order_grain": with_tables(
        _SELLER_ORDER_GRAIN, silver_tables=("orders", "order_items", "order_reviews")
    ),
    "silver_run_summary": with_tables(
        " UNION ALL ".join(
            f"SELECT 'silver_{t}' AS table_name, count(*) AS rows_in, count(*) FILTER (keep) AS rows_kept, "
            f"count(*) FILTER (NOT keep) AS rows_rejected FROM (SELECT coalesce({keep}, false) AS keep FROM b_{t})"
            for t, keep in {
                "orders": "order_id IS NOT NULL AND customer_id IS NOT NULL",
                "order_items": "price IS NOT NULL",
                "order_payments": "payment_value IS NOT NULL",
                "customers": "customer_id IS NOT NULL AND customer_unique_id IS NOT NULL",
                "products": "product_id IS NOT NULL",
                "sellers": "seller_id IS NOT NULL",
                "order_reviews": "review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5",
                "geolocation": "geolocation_lat BETWEEN -35 AND 5 AND geolocation_lng BETWEEN -74 AND -34 "
                "AND geolocation_zip_code_prefix IS NOT NULL",
            }.items()
        ),
        bronze_tables=tuple(TABLES),
    ),
    "quarantine_reviews": with_tables(
        """SELECT review_id, order_id, review_score,
                  CASE WHEN review_id IS NULL THEN 'review_id is null' WHEN order_id IS NULL THEN 'order_id is null'
                       ELSE 'review_score outside 1..5' END AS reject_reason
           FROM b_order_reviews
           WHERE review_id IS NULL OR order_id IS NULL OR review_score IS NULL OR review_score NOT BETWEEN 1 AND 5""",
        bronze_tables=("order_reviews",),
    ),
    **{f"silver_{t}": with_tables(f"SELECT * FROM s_{t}", silver_tables=(t,)) for t in SILVER},
}
