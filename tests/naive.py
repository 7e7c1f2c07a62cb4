"""KPI definitions by literal joins in pandas, for small frames."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd

PAID = {"delivered", "shipped", "invoiced"}


def half_up(total, count, places):
    if not count:
        return None
    step = Decimal(1).scaleb(-places)
    return float((Decimal(str(total)) / Decimal(int(count))).quantize(step, ROUND_HALF_UP))


def total(values):
    """Sum of money as a rounded float, None when nothing is there."""
    present = [Decimal(str(v)) for v in values if not pd.isna(v)]
    return (float(sum(present).quantize(Decimal("0.01"), ROUND_HALF_UP)), sum(present), len(present)) if present else (None, 0, 0)


def none(value):
    return None if pd.isna(value) else value


def paid(orders):
    return orders[orders.order_status.isin(PAID)]


def daily(t):
    freight = t["order_items"].groupby("order_id").freight_value.sum(min_count=1).rename("freight").reset_index()
    joined = paid(t["orders"]).merge(t["order_payments"], on="order_id", how="left").merge(freight, on="order_id", how="left")
    out = {}
    for day, g in joined.groupby("order_date", dropna=False):
        revenue, exact, n = total(g.payment_value)
        days = [d for d in g.delivery_days if not pd.isna(d)]
        out[none(day)] = (
            revenue, g.order_id.nunique(), half_up(exact, n, 2), total(g.freight)[0],
            half_up(sum(days), len(days), 1), int(g.delivered_on_time.sum()),
        )
    return out


def by_category(t):
    joined = t["order_items"].merge(t["products"], on="product_id", how="left").merge(paid(t["orders"]), on="order_id")
    out = {}
    for name, g in joined.groupby("product_category_name", dropna=False):
        revenue, exact, n = total(g.price)
        out[none(name)] = (revenue, g.order_id.nunique(), int(g.product_id.notna().sum()), half_up(exact, n, 2), total(g.freight_value)[0])
    return out


def by_state(t):
    geo = t["geolocation"].rename(columns={"geolocation_zip_code_prefix": "customer_zip_code_prefix"})
    joined = (
        paid(t["orders"]).merge(t["order_payments"], on="order_id", how="left")
        .merge(t["customers"], on="customer_id", how="left").merge(geo, on="customer_zip_code_prefix", how="left")
    )
    out = {}
    for name, g in joined.groupby("customer_state", dropna=False):
        revenue, exact, n = total(g.payment_value)
        lat = [Decimal(str(v)) for v in g.geolocation_lat if not pd.isna(v)]
        out[none(name)] = (revenue, g.order_id.nunique(), half_up(exact, n, 2), half_up(sum(lat), len(lat), 4))
    return out


def satisfaction(t):
    joined = (
        t["order_reviews"].merge(t["orders"], on="order_id", how="left")
        .merge(t["order_items"], on="order_id", how="left").merge(t["products"], on="product_id", how="left")
    )
    out = {}
    for key, g in joined.groupby(["product_category_name", "order_year", "order_month"], dropna=False):
        days = [d for d in g.days_to_answer if not pd.isna(d)]
        out[tuple(none(k) for k in key)] = (
            half_up(g.review_score.sum(), len(g), 2), len(g), int((g.review_score >= 4).sum()),
            int(g.has_comment.sum()), half_up(sum(days), len(days), 1),
        )
    return out


def sellers(t):
    joined = (
        t["order_items"].merge(t["sellers"], on="seller_id", how="left").merge(paid(t["orders"]), on="order_id")
        .merge(t["order_reviews"], on="order_id", how="left")
    )
    out = {}
    for key, g in joined.groupby(["seller_id", "seller_city"], dropna=False):
        revenue, exact, n = total(g.price)
        scores = [s for s in g.review_score if not pd.isna(s)]
        days = [d for d in g.delivery_days if not pd.isna(d)]
        out[tuple(none(k) for k in key)] = (
            revenue, g.order_id.nunique(), len(g), half_up(exact, n, 2), half_up(sum(scores), len(scores), 2),
            half_up(sum(days), len(days), 1), int(g.delivered_on_time.sum()),
        )
    return out
