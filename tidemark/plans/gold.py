"""Silver to gold: the KPI tables.

The published KPI definitions join fact tables on keys that repeat on both sides (payments
and reviews per order, spellings per zip code), and count every joined row. Nothing here
builds those joined rows. Each side is first reduced to one row per key carrying exact sums
and row counts ("weights"); sums over the joined rows are then sums of products of weights.
The reduction combines on the map side, so one key that holds a large share of a table is a
single small row before the shuffle, and no join multiplies rows.

``*_order_grain`` versions give the same KPI with every order, item and review counted once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import REVENUE_STATUSES
from tidemark.functions.exact import amount, half_up_ratio, mean, mean_amount, money
from tidemark.operators.ordering import rank_by_total

Silver = Mapping[str, DataFrame]

# ---- Fixed values: satisfaction and tier limits ------------------------------------------
HIGH_SCORE, MEDIUM_SCORE = 4.0, 3.0
TOP_SELLER_RANK, MID_TIER_RANK = 100, 500

N = F.count
#: Items that carry their product category already; used where silver has such a table.
CATEGORISED = "order_items_category"


def _rows() -> Column:
    return F.count(F.lit(1))


def _or_one(name: str) -> Column:
    """Weight of the optional side of a left join: an unmatched row still counts once."""
    return F.coalesce(F.col(name), F.lit(1))


def _times(total: Column, weight: Column) -> Column:
    """``total`` counted ``weight`` times; the usual weight of one costs no decimal product."""
    return F.when(weight == 1, total.cast("decimal(38,0)")).otherwise(total * weight)


def _revenue_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status").isin(*REVENUE_STATUSES))


def _spread(key: str) -> Column:
    """A second grouping key that follows from the first, so it changes no group.

    A side grouped by ``key`` alone is already partitioned for a join by ``key`` and joins
    without a shuffle of its own. Adaptive execution splits a dominant key only between two
    plain shuffles, so where the other side may hold such a key this side is grouped by both.
    """
    return F.crc32(F.col(key)).alias("spread")


# ---- One row per key --------------------------------------------------------------------


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        _rows().alias("pay_rows"),
        N("payment_value").alias("pay_n"),
        F.sum(money("payment_value")).alias("pay_sum"),
    )


def freight_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum(money("freight_value")).alias("freight"))


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    sentiment = F.col("review_sentiment")
    return reviews.groupBy("order_id").agg(
        _rows().alias("rev_rows"),
        N("review_score").alias("score_n"),
        F.sum("review_score").alias("score_sum"),
        F.count_if(sentiment == "positive").alias("positive"),
        F.count_if(sentiment == "neutral").alias("neutral"),
        F.count_if(sentiment == "negative").alias("negative"),
        F.count_if("has_comment").alias("commented"),
        N("days_to_answer").alias("answer_n"),
        F.sum("days_to_answer").alias("answer_sum"),
    )


def delivery_per_order(orders: DataFrame, *more_keys: str | Column) -> DataFrame:
    return orders.groupBy("order_id", *more_keys).agg(
        _rows().alias("copies"),
        N("delivery_days").alias("delivery_n"),
        F.sum("delivery_days").alias("delivery_sum"),
        F.count_if("delivered_on_time").alias("on_time"),
    )


def items_with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items ⟕ products, with ``product_weight`` for products that are listed twice.

    The product side is reduced to one row per (product, category). Spark broadcasts it when
    its measured size allows; otherwise both join inputs are plain shuffles, which adaptive
    execution can split when one product dominates.
    """
    listed = products.groupBy("product_id", "product_category_name").agg(_rows().alias("product_weight"))
    return items.join(listed, "product_id", "left").withColumn("product_weight", _or_one("product_weight"))


def categorised_items(silver: Silver) -> DataFrame:
    known = silver.get(CATEGORISED)
    return items_with_category(silver["order_items"], silver["products"]) if known is None else known


# ---- Daily revenue ----------------------------------------------------------------------

DAY_KEYS = ("order_date", "order_year", "order_month", "order_quarter")


def _with_previous_day(days: DataFrame, total: str) -> DataFrame:
    """Adds the previous existing day's revenue and the change in percent.

    ``days`` has one row per calendar day, so ordering it in one task is bounded.
    """
    previous = F.lag(total).over(Window.orderBy("order_date"))
    change = half_up_ratio((F.col(total) - F.col("previous")) * F.lit(100), F.col("previous"), 2, scale=2)
    return days.withColumn("previous", previous).withColumns(
        {
            "prev_day_revenue": F.col("previous").cast("double"),
            "revenue_change_pct": change.cast("double"),
        }
    )


def day_totals(silver: Silver) -> DataFrame:
    """Exact sums and counts per day, which later periods can be made of."""
    orders = delivery_per_order(_revenue_orders(silver["orders"]), *DAY_KEYS)
    joined = (
        orders.join(payments_per_order(silver["order_payments"]), "order_id", "left")
        .join(freight_per_order(silver["order_items"]), "order_id", "left")
        .withColumn("pay_rows", _or_one("pay_rows"))
    )
    copies, rows = F.col("copies"), F.col("pay_rows")
    return joined.groupBy(*DAY_KEYS).agg(
        amount(F.sum(_times(F.col("pay_sum"), copies))).alias("revenue"),
        # One row per (order, day) is left, so this counts distinct orders.
        N("order_id").alias("order_count"),
        F.sum(copies * F.col("pay_n")).alias("pay_n"),
        F.sum(_times(F.col("pay_sum"), copies)).alias("pay_sum"),
        amount(F.sum(_times(F.col("freight"), copies * rows))).alias("freight"),
        F.sum(rows * F.col("delivery_sum")).alias("delivery_sum"),
        F.sum(rows * F.col("delivery_n")).alias("delivery_n"),
        F.sum(rows * F.col("on_time")).alias("on_time_deliveries"),
    )


def daily_revenue(silver: Silver) -> DataFrame:
    """Revenue per day; averages, on-time counts and freight are per payment row."""
    return daily_revenue_of(day_totals(silver))


def daily_revenue_of(days: DataFrame) -> DataFrame:
    """The KPI from ``day_totals``."""
    return _with_previous_day(days, "revenue").select(
        *DAY_KEYS,
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        mean_amount(F.col("pay_sum"), F.col("pay_n")).alias("avg_order_value"),
        F.col("freight").cast("double").alias("total_freight"),
        mean(F.col("delivery_sum"), F.col("delivery_n"), 1).alias("avg_delivery_days"),
        "on_time_deliveries",
        "prev_day_revenue",
        "revenue_change_pct",
    )


def daily_revenue_order_grain(silver: Silver) -> DataFrame:
    """Revenue per day with every order counted once, whatever its number of payments."""
    orders = _revenue_orders(silver["orders"]).groupBy("order_id", *DAY_KEYS).agg(
        F.max("delivery_days").alias("delivery_days"),
        F.bool_or("delivered_on_time").alias("on_time"),
    )
    joined = orders.join(payments_per_order(silver["order_payments"]), "order_id", "left").join(
        freight_per_order(silver["order_items"]), "order_id", "left"
    )
    days = joined.groupBy(*DAY_KEYS).agg(
        amount(F.sum("pay_sum")).alias("revenue"),
        N("order_id").alias("order_count"),
        amount(F.sum("freight")).alias("freight"),
        N("pay_sum").alias("paid_orders"),
        F.sum("pay_sum").alias("pay_sum"),
        F.sum("delivery_days").alias("delivery_sum"),
        N("delivery_days").alias("delivery_n"),
        F.count_if("on_time").alias("on_time_deliveries"),
    )
    return _with_previous_day(days, "revenue").select(
        *DAY_KEYS,
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        mean_amount(F.col("pay_sum"), F.col("paid_orders")).alias("avg_order_value"),
        F.col("freight").cast("double").alias("total_freight"),
        mean(F.col("delivery_sum"), F.col("delivery_n"), 1).alias("avg_delivery_days"),
        "on_time_deliveries",
        "prev_day_revenue",
        "revenue_change_pct",
    )


# ---- Revenue by category ----------------------------------------------------------------


def revenue_by_category(silver: Silver) -> DataFrame:
    """Item revenue per product category; items of unknown products form a null category."""
    weight = F.col("product_weight")
    items = (
        categorised_items(silver)
        .groupBy("order_id", "product_category_name")
        .agg(
            F.sum(F.when(F.col("product_id").isNotNull(), weight).otherwise(0)).alias("sold"),
            F.sum(_times(money("price"), weight)).alias("price_sum"),
            F.sum(F.when(F.col("price").isNotNull(), weight)).alias("price_n"),
            F.sum(_times(money("freight_value"), weight)).alias("freight"),
        )
    )
    orders = _revenue_orders(silver["orders"]).groupBy("order_id").agg(_rows().alias("copies"))
    copies = F.col("copies")
    totals = (
        items.join(orders, "order_id")
        .groupBy("product_category_name")
        .agg(
            amount(F.sum(_times(F.col("price_sum"), copies))).alias("revenue"),
            N("order_id").alias("order_count"),
            F.sum(copies * F.col("sold")).alias("items_sold"),
            F.sum(_times(F.col("price_sum"), copies)).alias("price_sum"),
            F.sum(copies * F.col("price_n")).alias("price_n"),
            amount(F.sum(_times(F.col("freight"), copies))).alias("freight"),
        )
    )
    # A category list is a small code table, so its ranking may use one task.
    ranked = totals.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("revenue"))))
    return ranked.select(
        "product_category_name",
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        "items_sold",
        mean_amount(F.col("price_sum"), F.col("price_n")).alias("avg_item_price"),
        F.col("freight").cast("double").alias("total_freight"),
        "revenue_rank",
    )


def top_categories(silver: Silver, n: int = 10) -> DataFrame:
    """The ``n`` categories with most revenue; names break ties."""
    return (
        revenue_by_category(silver)
        .select("product_category_name", "total_revenue", "revenue_rank")
        .orderBy(F.desc("total_revenue"), "product_category_name")
        .limit(n)
    )


# ---- Revenue by state -------------------------------------------------------------------


def zip_positions(geolocation: DataFrame) -> DataFrame:
    """Weights per zip code: a zip has one geolocation row per spelling of its city."""
    lat, lng = F.col("geolocation_lat").cast("decimal(18,6)"), F.col("geolocation_lng").cast("decimal(18,6)")
    zips = geolocation.withColumnRenamed("geolocation_zip_code_prefix", "customer_zip_code_prefix")
    return zips.groupBy("customer_zip_code_prefix", _spread("customer_zip_code_prefix")).agg(
        _rows().alias("geo_rows"),
        N("geolocation_lat").alias("lat_n"),
        F.sum(lat).alias("lat_sum"),
        N("geolocation_lng").alias("lng_n"),
        F.sum(lng).alias("lng_sum"),
    )


def customers_by_state(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """One row per (customer, state) with the weights of its positions."""
    located = customers.join(zip_positions(geolocation), "customer_zip_code_prefix", "left")
    return located.groupBy("customer_id", "customer_state").agg(
        F.sum(_or_one("geo_rows")).alias("places"),
        F.sum("lat_n").alias("lat_n"),
        F.sum("lat_sum").alias("lat_sum"),
        F.sum("lng_n").alias("lng_n"),
        F.sum("lng_sum").alias("lng_sum"),
    )


def revenue_by_state(silver: Silver) -> DataFrame:
    """Revenue per customer state; a payment counts once per spelling of the customer's zip."""
    located = _revenue_orders(silver["orders"]).join(
        customers_by_state(silver["customers"], silver["geolocation"]), "customer_id", "left"
    )
    orders = located.groupBy("order_id", "customer_state").agg(
        F.sum(_or_one("places")).alias("places"),
        F.sum("lat_n").alias("lat_n"),
        F.sum("lat_sum").alias("lat_sum"),
        F.sum("lng_n").alias("lng_n"),
        F.sum("lng_sum").alias("lng_sum"),
    )
    joined = orders.join(payments_per_order(silver["order_payments"]), "order_id", "left").withColumn(
        "pay_rows", _or_one("pay_rows")
    )
    places, rows = F.col("places"), F.col("pay_rows")
    totals = joined.groupBy("customer_state").agg(
        amount(F.sum(_times(F.col("pay_sum"), places))).alias("revenue"),
        N("order_id").alias("order_count"),
        F.sum(_times(F.col("pay_sum"), places)).alias("pay_sum"),
        F.sum(places * F.col("pay_n")).alias("pay_n"),
        *[F.sum(rows * F.col(c)).alias(c) for c in ("lat_sum", "lat_n", "lng_sum", "lng_n")],
    )
    # States are a small code table, so their ranking may use one task.
    ranked = totals.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("revenue"))))
    return ranked.select(
        "customer_state",
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        mean_amount(F.col("pay_sum"), F.col("pay_n")).alias("avg_order_value"),
        mean(F.col("lat_sum"), F.col("lat_n"), 4, scale=6).alias("state_lat"),
        mean(F.col("lng_sum"), F.col("lng_n"), 4, scale=6).alias("state_lng"),
        "revenue_rank",
    )


def revenue_by_state_order_grain(silver: Silver) -> DataFrame:
    """Revenue per customer state with every order counted once."""
    customers = silver["customers"].groupBy("customer_id").agg(F.max("customer_state").alias("customer_state"))
    orders = (
        _revenue_orders(silver["orders"])
        .join(customers, "customer_id", "left")
        .groupBy("order_id")
        .agg(F.max("customer_state").alias("customer_state"))
    )
    totals = (
        orders.join(payments_per_order(silver["order_payments"]), "order_id", "left")
        .groupBy("customer_state")
        .agg(
            amount(F.sum("pay_sum")).alias("revenue"),
            N("order_id").alias("order_count"),
            N("pay_sum").alias("paid_orders"),
        F.sum("pay_sum").alias("pay_sum"),
        )
    )
    ranked = totals.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("revenue"))))
    return ranked.select(
        "customer_state",
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        mean_amount(F.col("pay_sum"), F.col("paid_orders")).alias("avg_order_value"),
        "revenue_rank",
    )


# ---- Customer satisfaction --------------------------------------------------------------

PERIOD = ("order_year", "order_month", "order_quarter")


def customer_satisfaction(silver: Silver) -> DataFrame:
    """Review scores per category and month; a review counts once per item of its order."""
    reviews = reviews_per_order(silver["order_reviews"])
    orders = silver["orders"].groupBy("order_id", *PERIOD).agg(_rows().alias("copies"))
    items = (
        categorised_items(silver)
        .groupBy("order_id", "product_category_name")
        .agg(F.sum("product_weight").alias("items"))
    )
    joined = reviews.join(orders, "order_id", "left").join(items, "order_id", "left")
    weight = _or_one("copies") * _or_one("items")
    measures = (
        "rev_rows", "score_n", "score_sum", "positive", "neutral", "negative",
        "commented", "answer_n", "answer_sum",
    )
    totals = joined.groupBy("product_category_name", *PERIOD).agg(
        *[F.sum(weight * F.col(m)).alias(m) for m in measures]
    )
    score = mean(F.col("score_sum"), F.col("score_n"), 2)
    return totals.select(
        "product_category_name",
        *PERIOD,
        score.alias("avg_review_score"),
        F.col("rev_rows").alias("total_reviews"),
        F.col("positive").alias("positive_reviews"),
        F.col("neutral").alias("neutral_reviews"),
        F.col("negative").alias("negative_reviews"),
        F.col("commented").alias("reviews_with_comments"),
        mean(F.col("answer_sum"), F.col("answer_n"), 1).alias("avg_days_to_answer"),
        F.when(score >= HIGH_SCORE, "High")
        .when(score >= MEDIUM_SCORE, "Medium")
        .otherwise("Low")
        .alias("satisfaction_level"),
    )


# ---- Seller performance -----------------------------------------------------------------


def _items_per_seller(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id", "seller_id").agg(
        _rows().alias("item_rows"),
        N("price").alias("price_n"),
        F.sum(money("price")).alias("price_sum"),
    )


def _sellers_listed(sellers: DataFrame) -> DataFrame:
    return sellers.groupBy("seller_id", "seller_city", "seller_state").agg(_rows().alias("listings"))


def _order_spread(silver: Silver) -> list[Column]:
    """The second key of ``_spread``, unless the facts lie in buckets by order and nothing is shuffled."""
    return [] if getattr(silver, "bucketed_by", None) == "order_id" else [_spread("order_id")]


def seller_totals(silver: Silver) -> DataFrame:
    """Unranked seller KPIs; an item counts once per review of its order.

    What is known per order is joined first, so items of an order with very many sellers meet
    it in a single join that can be split. Seller attributes join after the reduction to one
    row per seller, so a dominant seller is one row by then.
    """
    spread = _order_spread(silver)
    orders = delivery_per_order(_revenue_orders(silver["orders"]), *spread)
    reviews = silver["order_reviews"].groupBy("order_id", *spread).agg(
        _rows().alias("rev_rows"),
        N("review_score").alias("score_n"),
        F.sum("review_score").alias("score_sum"),
    )
    facts = orders.join(reviews, ["order_id", "spread"] if spread else "order_id", "left").withColumn("rev_rows", _or_one("rev_rows"))
    joined = _items_per_seller(silver["order_items"]).join(facts, "order_id")
    item_rows, copies, rev_rows = F.col("item_rows"), F.col("copies"), F.col("rev_rows")
    times = copies * rev_rows
    per_seller = joined.groupBy("seller_id").agg(
        F.sum(_times(F.col("price_sum"), times)).alias("price_sum"),
        F.sum(F.col("price_n") * times).alias("price_n"),
        N("order_id").alias("order_count"),
        F.sum(item_rows * times).alias("items_sold"),
        F.sum(item_rows * copies * F.col("score_sum")).alias("score_sum"),
        F.sum(item_rows * copies * F.col("score_n")).alias("score_n"),
        F.sum(item_rows * rev_rows * F.col("delivery_sum")).alias("delivery_sum"),
        F.sum(item_rows * rev_rows * F.col("delivery_n")).alias("delivery_n"),
        F.sum(item_rows * rev_rows * F.col("on_time")).alias("on_time"),
    )
    listings = _or_one("listings")
    return per_seller.join(_sellers_listed(silver["sellers"]), "seller_id", "left").select(
        "seller_id",
        "seller_city",
        "seller_state",
        amount(F.col("price_sum") * listings).alias("revenue"),
        "order_count",
        (F.col("items_sold") * listings).alias("items_sold"),
        mean_amount(F.col("price_sum"), F.col("price_n")).alias("avg_item_price"),
        mean(F.col("score_sum"), F.col("score_n"), 2).alias("avg_review_score"),
        mean(F.col("delivery_sum"), F.col("delivery_n"), 1).alias("avg_delivery_days"),
        (F.col("on_time") * listings).alias("on_time_deliveries"),
    )


def _tier(rank: Column) -> Column:
    return (
        F.when(rank <= TOP_SELLER_RANK, "Top Seller").when(rank <= MID_TIER_RANK, "Mid Tier").otherwise("Standard")
    )


def seller_performance(silver: Silver) -> DataFrame:
    """Seller KPIs with revenue rank and tier. The number of sellers grows with the data."""
    return rank_by_total(seller_totals(silver), "revenue", "revenue_rank").select(
        "seller_id",
        "seller_city",
        "seller_state",
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        "items_sold",
        "avg_item_price",
        "avg_review_score",
        "avg_delivery_days",
        "on_time_deliveries",
        "revenue_rank",
        _tier(F.col("revenue_rank")).alias("performance_tier"),
    )


def seller_performance_order_grain(silver: Silver) -> DataFrame:
    """Seller KPIs with every item counted once and review scores averaged per order."""
    orders = _revenue_orders(silver["orders"]).groupBy("order_id", _spread("order_id")).agg(
        F.bool_or("delivered_on_time").alias("on_time")
    )
    reviews = silver["order_reviews"].groupBy("order_id", _spread("order_id")).agg(
        N("review_score").alias("score_n"), F.sum("review_score").alias("score_sum")
    )
    facts = orders.join(reviews, ["order_id", "spread"], "left")
    joined = _items_per_seller(silver["order_items"]).join(facts, "order_id")
    per_seller = joined.groupBy("seller_id").agg(
        amount(F.sum("price_sum")).alias("revenue"),
        N("order_id").alias("order_count"),
        F.sum("item_rows").alias("items_sold"),
        mean_amount(F.sum("price_sum"), F.sum("price_n")).alias("avg_item_price"),
        mean(F.sum("score_sum"), F.sum("score_n"), 2).alias("avg_review_score"),
        F.count_if("on_time").alias("on_time_orders"),
    )
    return rank_by_total(per_seller, "revenue", "revenue_rank").select(
        "seller_id",
        F.col("revenue").cast("double").alias("total_revenue"),
        "order_count",
        "items_sold",
        "avg_item_price",
        "avg_review_score",
        "on_time_orders",
        "revenue_rank",
    )


def top_seller_cities(silver: Silver, n: int = 10) -> DataFrame:
    """The ``n`` seller cities with most revenue; names break ties."""
    return (
        seller_totals(silver)
        .groupBy("seller_city")
        .agg(F.sum("revenue").cast("double").alias("total_revenue"), _rows().alias("sellers"))
        .orderBy(F.desc("total_revenue"), "seller_city")
        .limit(n)
    )


# ---- Order status share (SQL) -----------------------------------------------------------


def order_status_share(bronze_orders: DataFrame) -> DataFrame:
    """Orders per raw status and their share of all orders, as a SQL query over a view."""
    return bronze_orders.sparkSession.sql(
        """
        SELECT order_status,
               count(*) AS order_count,
               CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct
        FROM {orders}
        GROUP BY order_status
        """,
        orders=bronze_orders,
    )


#: What the KPIs of ``GOLD`` read of the facts, of items before their category is known, and of products.
READ_COLUMNS = {
    "orders": ("order_id", "customer_id", "order_status", *DAY_KEYS, "delivery_days", "delivered_on_time"),
    "order_payments": ("order_id", "payment_value"),
    "order_items": ("order_id", "seller_id", "price", "freight_value"),
    CATEGORISED: ("order_id", "product_id", "price", "freight_value"),
    "products": ("product_id", "product_category_name"),
    "order_reviews": ("order_id", "review_score", "review_sentiment", "has_comment", "days_to_answer"),
}

GOLD = {
    "gold_daily_revenue": daily_revenue,
    "gold_revenue_by_category": revenue_by_category,
    "gold_revenue_by_state": revenue_by_state,
    "gold_customer_satisfaction": customer_satisfaction,
    "gold_seller_performance": seller_performance,
}
