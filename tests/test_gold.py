"""KPI plans against literal joins on random tables full of repeated and dangling keys."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests import naive
from tidemark.plans import gold

TYPES = {
    "orders": "order_id string, customer_id string, order_status string, order_date date, order_year int, "
    "order_month int, order_quarter int, delivery_days int, delivered_on_time boolean",
    "order_payments": "order_id string, payment_value double",
    "order_items": "order_id string, product_id string, seller_id string, price double, freight_value double",
    "products": "product_id string, product_category_name string",
    "customers": "customer_id string, customer_zip_code_prefix string, customer_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_city string, geolocation_lat double, geolocation_lng double",
    "sellers": "seller_id string, seller_city string, seller_state string",
    "order_reviews": "order_id string, review_score int, review_sentiment string, has_comment boolean, days_to_answer int",
}


def random_tables(seed, hot=False):
    rng = random.Random(seed)
    pick = rng.choice
    key = lambda n: "hot" if hot and rng.random() < 0.34 else f"k{rng.randrange(n)}"
    cents = lambda: pick([None, rng.randrange(1, 10**6) / 100])

    def order():
        day = pick([None, dt.date(2021, 1, 1) + dt.timedelta(rng.randrange(40))])
        return (key(40), key(12), pick(["delivered", "shipped", "canceled", "invoiced"]), day, day and day.year,
                day and day.month, day and (day.month + 2) // 3, pick([None, rng.randrange(30)]), pick([True, False]))

    def review():
        score = rng.randrange(1, 6)
        mood = "positive" if score > 3 else "neutral" if score == 3 else "negative"
        return (key(45), score, mood, pick([True, False]), pick([None, rng.randrange(9)]))

    return {
        "orders": [order() for _ in range(60)],
        "order_payments": [(key(45), cents()) for _ in range(90)],
        "order_items": [(key(45), pick([None, key(15)]), key(8), cents(), cents()) for _ in range(150)],
        "products": [(key(12), pick([None, "a", "b", "c"])) for _ in range(20)],
        "customers": [(key(10), pick([None, key(6)]), pick(["SP", "RJ", "MG"])) for _ in range(14)],
        "geolocation": [(key(5), f"c{i}", rng.randrange(-35000, 5000) / 1000, -50.5) for i in range(15)],
        "sellers": [(key(7), pick(["x", "y"]), "SP") for _ in range(9)],
        "order_reviews": [review() for _ in range(70)],
    }


def both(spark, seed, hot=False):
    rows = random_tables(seed, hot)
    columns = {t: [c.split()[0] for c in TYPES[t].split(", ")] for t in TYPES}
    return (
        {t: spark.createDataFrame(rows[t], TYPES[t]) for t in TYPES},
        {t: pd.DataFrame(rows[t], columns=columns[t]) for t in TYPES},
    )


@pytest.fixture(scope="module", params=[(1, False), (2, False), (3, True)], ids=["plain", "plain2", "hot"])
def tables(spark, request):
    return both(spark, *request.param)


def test_daily(tables):
    silver, frames = tables
    out = {r["order_date"]: tuple(r[c] for c in (
        "total_revenue", "order_count", "avg_order_value", "total_freight", "avg_delivery_days", "on_time_deliveries"))
        for r in gold.daily_revenue(silver).collect()}
    assert out == naive.daily(frames)


def test_category(tables):
    silver, frames = tables
    out = {r["product_category_name"]: tuple(r[c] for c in (
        "total_revenue", "order_count", "items_sold", "avg_item_price", "total_freight"))
        for r in gold.revenue_by_category(silver).collect()}
    assert out == naive.by_category(frames)


def test_state(tables):
    silver, frames = tables
    out = {r["customer_state"]: (r["total_revenue"], r["order_count"], r["avg_order_value"], r["state_lat"])
           for r in gold.revenue_by_state(silver).collect()}
    assert out == naive.by_state(frames)


def test_satisfaction(tables):
    silver, frames = tables
    rows = gold.customer_satisfaction(silver).collect()
    out = {(r["product_category_name"], r["order_year"], r["order_month"]): (
        r["avg_review_score"], r["total_reviews"], r["positive_reviews"], r["reviews_with_comments"], r["avg_days_to_answer"])
        for r in rows}
    assert out == naive.satisfaction(frames)
    for r in rows:
        score = r["avg_review_score"]
        assert r["satisfaction_level"] == ("High" if score >= 4 else "Medium" if score >= 3 else "Low")


def test_sellers(tables):
    silver, frames = tables
    rows = gold.seller_performance(silver).collect()
    out = {(r["seller_id"], r["seller_city"]): tuple(r[c] for c in (
        "total_revenue", "order_count", "items_sold", "avg_item_price", "avg_review_score", "avg_delivery_days",
        "on_time_deliveries")) for r in rows}
    assert out == naive.sellers(frames)
    known = sorted((r["total_revenue"] for r in rows if r["total_revenue"] is not None), reverse=True)
    for r in rows:
        want = len(known) + 1 if r["total_revenue"] is None else known.index(r["total_revenue"]) + 1
        assert r["revenue_rank"] == want


def test_order_grain_never_exceeds_fan_out(tables):
    silver, _ = tables
    per_day = lambda df: {r["order_date"]: r["total_freight"] or 0 for r in df.collect()}
    fan, single = per_day(gold.daily_revenue(silver)), per_day(gold.daily_revenue_order_grain(silver))
    assert fan.keys() == single.keys() and all(single[d] <= fan[d] for d in fan)


def test_previous_day_is_the_previous_existing_day(spark):
    day = lambda n: dt.date(2021, 1, n)
    rows = [("a", "c", "delivered", day(1)), ("b", "c", "delivered", day(5)), ("z", "c", "delivered", day(9)), ("n", "c", "delivered", None)]
    full = [(*r, 2021, 1, 1, 3, True) for r in rows]
    silver = {
        "orders": spark.createDataFrame(full, TYPES["orders"]),
        "order_payments": spark.createDataFrame([("a", 100.0), ("b", 0.0), ("z", 50.0)], TYPES["order_payments"]),
        "order_items": spark.createDataFrame([], TYPES["order_items"]),
    }
    out = [(r["order_date"], r["prev_day_revenue"], r["revenue_change_pct"])
           for r in gold.daily_revenue(silver).orderBy(F.asc_nulls_first("order_date")).collect()]
    assert out == [(None, None, None), (day(1), None, None), (day(5), 100.0, -100.0), (day(9), 0.0, None)]


def test_status_share(spark):
    df = spark.createDataFrame([("x",)] * 2 + [("y",)], "order_status string")
    assert {r["order_status"]: (r["order_count"], r["pct"]) for r in gold.order_status_share(df).collect()} == {
        "x": (2, 66.67), "y": (1, 33.33)}
