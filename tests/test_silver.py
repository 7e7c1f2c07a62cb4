from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.config import METADATA_COLUMNS, TABLES
from tidemark.plans import silver
from tidemark.sources import star
from tidemark.sources.schemas import SOURCE_DDL


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SOURCE_DDL[table].replace("NOT NULL", ""))


def order(key="o1", customer="c1", status="delivered", bought="2021-01-01 10:00:00", arrived=None, promised="2021-01-06"):
    return (key, customer, status, bought, "bad", "2021-01-02", arrived, promised)


def test_orders_parse_and_derive(spark):
    rows = [
        order(status=" Delivered ", arrived="2021-01-05"),
        order("o2", arrived="2021-01-06 10:00:00"),
        order("o3", bought=None),
        order("o4", bought="not a date", status="\tshipped"),
        order(None), order("o6", customer=None),
    ]
    out = {r["order_id"]: r for r in silver.clean("orders", frame(spark, "orders", rows)).collect()}
    assert set(out) == {"o1", "o2", "o3", "o4"}
    first = out["o1"]
    assert first["order_status"] == "delivered"
    assert first["order_purchase_timestamp"] == dt.datetime(2021, 1, 1, 10)
    assert first["order_delivered_carrier_date"] == dt.datetime(2021, 1, 2)
    assert first["order_approved_at"] is None
    assert (first["order_year"], first["order_month"], first["order_quarter"]) == (2021, 1, 1)
    assert first["order_day_of_week"] == 6 and first["order_date"] == dt.date(2021, 1, 1)
    assert first["delivery_days"] == 4 and first["delivered_on_time"] is True
    # during the promised day is late; unknown delivery is false, not null
    assert out["o2"]["delivered_on_time"] is False and out["o2"]["delivery_days"] == 5
    assert out["o3"]["delivered_on_time"] is False and out["o3"]["order_date"] is None
    # trim removes spaces only
    assert out["o4"]["order_status"] == "\tshipped" and out["o4"]["order_year"] is None


def test_items(spark):
    rows = [("o", 1, "p", "s", "2021-01-01", 1.005, 0.0), ("o", 2, "p", "s", None, 10.0, -0.0),
            ("o", 3, "p", "s", None, None, 1.0), ("o", 4, "p", "s", None, 5.0, None)]
    out = {r["order_item_id"]: r for r in silver.clean("order_items", frame(spark, "order_items", rows)).collect()}
    assert set(out) == {1, 2, 4}
    assert out[1]["total_item_value"] == 1.01 and out[1]["is_free_shipping"]
    assert out[2]["is_free_shipping"] and not out[4]["is_free_shipping"] and out[4]["total_item_value"] is None


def test_payments_round_before_the_high_value_test(spark):
    rows = [("o", 1, " BOLETO ", 1, 1000.004), ("o", 2, "x", 2, 1000.006), ("o", 3, None, None, 5.0), ("o", 4, "x", 1, None)]
    out = {r["payment_sequential"]: r for r in silver.clean("order_payments", frame(spark, "order_payments", rows)).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1]["payment_type"] == "boleto" and out[1]["payment_value"] == 1000.0 and not out[1]["is_high_value"]
    assert out[2]["is_high_value"] and out[2]["is_installment"] and not out[3]["is_installment"]


def test_products_default_only_null_category(spark):
    rows = [("p1", None, 1, 1, 1, 1.0, 2.0, 3.0, 4.5), ("p2", "  ", 1, 1, 1, 1.0, None, 3.0, 4.0), (None, "x", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)]
    out = {r["product_id"]: r for r in silver.clean("products", frame(spark, "products", rows)).collect()}
    assert out["p1"]["product_category_name"] == "uncategorized" and out["p1"]["product_volume_cm3"] == 27.0
    assert out["p2"]["product_category_name"] == "" and out["p2"]["product_volume_cm3"] is None and len(out) == 2


def test_reviews(spark):
    def review(key, score, message=None):
        return (key, "o", score, " t ", message, "2021-01-01", "2021-01-04 09:00:00")

    rows = [review("a", 5, " good "), review("b", 3, "   "), review("c", 1), review("d", 0), review("e", 6), review("f", None), review(None, 4)]
    df = frame(spark, "order_reviews", rows)
    out = {r["review_id"]: r for r in silver.clean("order_reviews", df).collect()}
    assert {k: v["review_sentiment"] for k, v in out.items()} == {"a": "positive", "b": "neutral", "c": "negative"}
    assert [out[k]["has_comment"] for k in "abc"] == [True, False, False]
    assert out["a"]["review_comment_message"] == "good" and out["a"]["days_to_answer"] == 3
    reasons = {(r["review_id"], r["reject_reason"]) for r in silver.quarantine("order_reviews", df).collect()}
    wrong = "review_score outside 1..5"
    assert reasons == {("d", wrong), ("e", wrong), ("f", wrong), (None, "review_id is null")}


def test_geolocation_bounds_are_inclusive(spark):
    rows = [(" 1 ", -35.0, -74.0, " A ", "sp"), ("1", 5.0, -34.0, "a", "SP "), ("1", 5.1, -40.0, "a", "sp"),
            ("1", -10.0, -33.9, "a", "sp"), (None, -10.0, -40.0, "a", "sp"), ("2", None, -40.0, "a", "sp"), ("1", -1.0, -50.0, "b", "sp")]
    out = {(r["geolocation_zip_code_prefix"], r["geolocation_city"]): r
           for r in silver.clean("geolocation", frame(spark, "geolocation", rows)).collect()}
    assert set(out) == {("1", "a"), ("1", "b")}
    assert (out["1", "a"]["geolocation_lat"], out["1", "a"]["geolocation_lng"]) == (-15.0, -54.0)
    assert out["1", "a"]["geolocation_state"] == "SP"


@pytest.mark.parametrize("table", list(TABLES))
def test_kept_and_rejected_add_up(spark, table):
    bronze = star.bronze(spark, "/root/testdata/sf0.001", table)
    row = silver.row_accounting(table, bronze).first()
    assert row["rows_in"] == bronze.count() == row["rows_kept"] + row["rows_rejected"]
    assert silver.quarantine(table, bronze).count() == row["rows_rejected"]
    cleaned = silver.clean(table, bronze)
    assert not set(METADATA_COLUMNS) & set(cleaned.columns)
    if table != "geolocation":
        assert cleaned.count() == row["rows_kept"]


@pytest.mark.parametrize("table", list(TABLES))
def test_empty_tables_stay_empty(spark, table):
    assert silver.clean(table, frame(spark, table, [])).count() == 0


def test_filters_reach_the_scan(spark, tmp_path):
    frame(spark, "order_items", [("o", 1, "p", "s", None, 1.0, 0.0)]).write.parquet(str(tmp_path / "t"))
    plan = silver.clean("order_items", spark.read.parquet(str(tmp_path / "t"))).select("order_id", "price")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(price)" in text and "ReadSchema: struct<order_id:string,price:double>" in text
