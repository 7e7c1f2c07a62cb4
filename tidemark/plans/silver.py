"""Bronze to silver: typed, trimmed, filtered tables.

Each table has one ``typed_*`` projection and a list of keep rules. Both are plain column
expressions, so a whole table is one scan, one projection and one filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import METADATA_COLUMNS, TABLES
from tidemark.functions.clean import flag, lower_trim, parse_timestamp, upper_trim
from tidemark.functions.exact import DEGREES, degrees, mean

# ---- Fixed values: accepted coordinates, value limits ------------------------------------
LATITUDE_RANGE = (-35, 5)
LONGITUDE_RANGE = (-74, -34)
HIGH_VALUE_ABOVE = 1000
SCORE_RANGE = (1, 5)


def typed_orders(bronze: DataFrame) -> DataFrame:
    moments = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    typed = bronze.withColumns(
        {name: parse_timestamp(name) for name in moments} | {"order_status": lower_trim("order_status")}
    )
    bought = F.col("order_purchase_timestamp")
    arrived = F.col("order_delivered_customer_date")
    return typed.withColumns(
        {
            "order_year": F.year(bought),
            "order_month": F.month(bought),
            "order_quarter": F.quarter(bought),
            "order_day_of_week": F.dayofweek(bought),
            "order_date": F.to_date(bought),
            "delivery_days": F.datediff(arrived, bought),
            # Compared as timestamps: a delivery during the promised day is already late.
            "delivered_on_time": flag(arrived <= F.col("order_estimated_delivery_date")),
        }
    )


def typed_order_items(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "shipping_limit_date": parse_timestamp("shipping_limit_date"),
            "total_item_value": F.round(F.col("price") + F.col("freight_value"), 2),
            "is_free_shipping": flag(F.col("freight_value") == 0),
        }
    )


def typed_order_payments(bronze: DataFrame) -> DataFrame:
    value = F.round("payment_value", 2)
    return bronze.withColumns(
        {
            "payment_type": lower_trim("payment_type"),
            "payment_value": value,
            "is_high_value": flag(value > HIGH_VALUE_ABOVE),
            "is_installment": flag(F.col("payment_installments") > 1),
        }
    )


def _typed_place(bronze: DataFrame, prefix: str) -> DataFrame:
    return bronze.withColumns(
        {
            f"{prefix}_city": lower_trim(f"{prefix}_city"),
            f"{prefix}_state": upper_trim(f"{prefix}_state"),
            f"{prefix}_zip_code_prefix": F.trim(f"{prefix}_zip_code_prefix"),
        }
    )


def typed_customers(bronze: DataFrame) -> DataFrame:
    return _typed_place(bronze, "customer")


def typed_sellers(bronze: DataFrame) -> DataFrame:
    return _typed_place(bronze, "seller")


def typed_products(bronze: DataFrame) -> DataFrame:
    sides = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return bronze.withColumns(
        {
            "product_category_name": F.coalesce(lower_trim("product_category_name"), F.lit("uncategorized")),
            "product_volume_cm3": F.round(sides, 2),
        }
    )


def typed_order_reviews(bronze: DataFrame) -> DataFrame:
    score = F.col("review_score")
    message = F.trim("review_comment_message")
    created = parse_timestamp("review_creation_date")
    answered = parse_timestamp("review_answer_timestamp")
    return bronze.withColumns(
        {
            "review_creation_date": created,
            "review_answer_timestamp": answered,
            "review_comment_title": F.trim("review_comment_title"),
            "review_comment_message": message,
            "review_sentiment": F.when(score >= 4, "positive")
            .when(score == 3, "neutral")
            .when(score <= 2, "negative")
            .otherwise("unknown"),
            "has_comment": flag(F.length(message) > 0),
            "days_to_answer": F.datediff(answered, created),
        }
    )


def typed_geolocation(bronze: DataFrame) -> DataFrame:
    return _typed_place(bronze, "geolocation")


def mean_position(points: DataFrame) -> DataFrame:
    """One row per (zip, city, state) with the average position."""
    # The range filter runs first, so every value fits the decimal.
    return (
        points.groupBy("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.sum(degrees("geolocation_lat")).alias("lat_sum"),
            F.sum(degrees("geolocation_lng")).alias("lng_sum"),
        )
        .select(
            "geolocation_zip_code_prefix",
            "geolocation_city",
            "geolocation_state",
            mean(F.col("lat_sum"), F.col("points"), 6, DEGREES.scale).alias("geolocation_lat"),
            mean(F.col("lng_sum"), F.col("points"), 6, DEGREES.scale).alias("geolocation_lng"),
        )
    )


Rule = tuple[str, Column]


def _present(*names: str) -> list[Rule]:
    return [(f"{name} is null", F.col(name).isNotNull()) for name in names]


def keep_rules(table: str) -> list[Rule]:
    """(reason when broken, condition that must hold) per table, in reporting order."""
    return {
        "orders": lambda: _present("order_id", "customer_id"),
        "order_items": lambda: _present("price"),
        "order_payments": lambda: _present("payment_value"),
        "customers": lambda: _present("customer_id", "customer_unique_id"),
        "products": lambda: _present("product_id"),
        "sellers": lambda: _present("seller_id"),
        "order_reviews": lambda: _present("review_id", "order_id")
        + [("review_score outside 1..5", F.col("review_score").between(*SCORE_RANGE))],
        "geolocation": lambda: [
            ("latitude outside range", F.col("geolocation_lat").between(*LATITUDE_RANGE)),
            ("longitude outside range", F.col("geolocation_lng").between(*LONGITUDE_RANGE)),
        ]
        + _present("geolocation_zip_code_prefix"),
    }[table]()


def keep_condition(table: str) -> Column:
    """Conjunction of the keep rules; a filter drops rows where it is unknown."""
    rules = [condition for _, condition in keep_rules(table)]
    joined = rules[0]
    for condition in rules[1:]:
        joined = joined & condition
    return joined


def reject_reason(table: str) -> Column:
    """First broken rule of a row, null for rows that stay."""
    return F.coalesce(*[F.when(~flag(condition), F.lit(reason)) for reason, condition in keep_rules(table)])


TYPED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": typed_orders,
    "order_items": typed_order_items,
    "order_payments": typed_order_payments,
    "customers": typed_customers,
    "products": typed_products,
    "sellers": typed_sellers,
    "order_reviews": typed_order_reviews,
    "geolocation": typed_geolocation,
}


def typed(table: str, bronze: DataFrame) -> DataFrame:
    """All rows of ``table`` with cleaned columns, before any row is dropped."""
    return TYPED[table](bronze).drop(*METADATA_COLUMNS)


# Tables that get a new grain after the row filter.
REGROUPED: dict[str, Callable[[DataFrame], DataFrame]] = {"geolocation": mean_position}


def clean(table: str, bronze: DataFrame) -> DataFrame:
    """The silver table of ``table``."""
    kept = typed(table, bronze).where(keep_condition(table))
    return REGROUPED[table](kept) if table in REGROUPED else kept


class CleanTables(Mapping[str, DataFrame]):
    """Silver tables planned on first use, so a KPI touches only the tables it needs."""

    def __init__(self, bronze: Callable[[str], DataFrame], tables: Iterable[str] = TABLES) -> None:
        self._bronze, self._tables, self._planned = bronze, tuple(tables), {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            raise KeyError(table)
        if table not in self._planned:
            self._planned[table] = clean(table, self._bronze(table))
        return self._planned[table]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def quarantine(table: str, bronze: DataFrame) -> DataFrame:
    """The rows that ``clean`` drops, each with the first rule it breaks."""
    return (
        typed(table, bronze)
        .withColumn("reject_reason", reject_reason(table))
        .where(F.col("reject_reason").isNotNull())
    )


KEPT = "kept"


def with_outcome(table: str, bronze: DataFrame) -> DataFrame:
    """All typed rows with ``reject_reason``: the first broken rule, or ``kept``."""
    return typed(table, bronze).withColumn("reject_reason", F.coalesce(reject_reason(table), F.lit(KEPT)))


def outcome_counts(table: str) -> dict[str, Column]:
    """Aggregates over ``with_outcome``: rows per outcome, in reporting order."""
    outcomes = [KEPT, *[reason for reason, _ in keep_rules(table)]]
    return {outcome: F.count_if(F.col("reject_reason") == outcome) for outcome in outcomes}


def row_accounting(table: str, bronze: DataFrame) -> DataFrame:
    """Rows read, kept and rejected for one table, in one scan."""
    keep = flag(keep_condition(table))
    return (
        typed(table, bronze)
        .agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(keep).alias("rows_kept"),
            F.count_if(~keep).alias("rows_rejected"),
        )
        .select(F.lit(f"silver_{table}").alias("table_name"), "*")
    )
