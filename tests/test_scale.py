"""Plan shape and skew: what has to hold on tables that fit no single task."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.test_gold import TYPES
from tidemark.plans import gold, quality, silver
from tidemark.sources import star
from verification.queries import QUERIES as OWN_QUERIES

FOLDER = "/root/testdata/sf0.001"
# These write and read scratch tables while they are planned.
EAGER = {
    "bronze_load_audit", "snapshot_restore", "incremental_append", "header_drift_counts", "layer_runs", "dq_run_records",
    "gold_partial_rebuild", "quarantine_split", "dq_outcomes_concurrent", "bucketed_daily_revenue", "bucketed_revenue_by_category",
    "bucketed_customer_satisfaction", "bucketed_seller_performance", "load_outcomes", "sql_views", "isolated_failure",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - EAGER))
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = physical(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    # the training-data queries, where present, say in their own tests what stands for SQL
    assert set(OWN_QUERIES) - set(oracle_sql()) == {"dq_violation_samples"}


def hot_tables(spark, n=60_000):
    """A third of all orders, payments, items and reviews belong to one order and one customer."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i % 5000).cast("string")))
    customer = F.when(i % 3 == 1, "hot").otherwise(F.concat(F.lit("c"), (i % 900).cast("string")))
    base = spark.range(0, n, 1, 8)
    day = F.make_date(F.lit(2021), (i % 12 + 1).cast("int"), F.lit(1))
    return {
        "orders": base.select(
            key.alias("order_id"), customer.alias("customer_id"), F.lit("delivered").alias("order_status"),
            day.alias("order_date"), F.lit(2021).alias("order_year"), F.month(day).alias("order_month"),
            F.quarter(day).alias("order_quarter"), (i % 9).cast("int").alias("delivery_days"),
            (i % 2 == 0).alias("delivered_on_time")),
        "order_payments": base.select(key.alias("order_id"), F.lit(1.25).alias("payment_value")),
        "order_items": base.select(
            key.alias("order_id"), F.when(i % 3 == 1, "hot").otherwise(F.concat(F.lit("p"), (i % 700).cast("string"))).alias("product_id"),
            F.concat(F.lit("s"), i.cast("string")).alias("seller_id"), F.lit(2.5).alias("price"), F.lit(1.0).alias("freight_value")),
        "products": base.limit(700).select(F.concat(F.lit("p"), i.cast("string")).alias("product_id"), F.lit("a").alias("product_category_name"))
            .unionByName(spark.createDataFrame([("hot", "b")], TYPES["products"])),
        "customers": base.limit(900).select(
            F.when(i == 0, "hot").otherwise(F.concat(F.lit("c"), i.cast("string"))).alias("customer_id"),
            F.lit("z").alias("customer_zip_code_prefix"), F.lit("SP").alias("customer_state")),
        "geolocation": spark.createDataFrame([("z", "a", -10.0, -50.0), ("z", "b", -20.0, -40.0)], TYPES["geolocation"]),
        "sellers": base.limit(5).select(F.concat(F.lit("s"), i.cast("string")).alias("seller_id"), F.lit("x").alias("seller_city"), F.lit("SP").alias("seller_state")),
        "order_reviews": base.select(
            key.alias("order_id"), (i % 5 + 1).cast("int").alias("review_score"), F.lit("neutral").alias("review_sentiment"),
            (i % 2 == 0).alias("has_comment"), (i % 4).cast("int").alias("days_to_answer")),
    }


def test_hot_order_gives_exact_sums_without_building_the_pairs(spark):
    """20,000 copies of an order × 20,000 payments are counted, never joined row by row."""
    df = gold.daily_revenue(hot_tables(spark))
    rows = df.collect()
    n, hot = 60_000, 20_000
    pairs = hot * hot + sum((n // 3 * 2 / 5000) ** 2 for _ in range(5000))
    assert sum(r["total_revenue"] for r in rows) == pytest.approx(1.25 * pairs, rel=0.2)
    hot_share = 1.25 * hot * hot
    assert sum(r["total_revenue"] for r in rows) > hot_share
    joins = re.findall(r"number of output rows[^\n]*", physical(df))
    largest = max(max_rows(df._jdf.queryExecution().executedPlan()), 0)
    assert largest <= 2 * n, (largest, joins)


def max_rows(plan):
    """Largest output of any operator that reports its rows, read from the finished plan."""
    best, stack = 0, [plan]
    while stack:
        node = stack.pop()
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            best = max(best, metrics.apply("numOutputRows").value())
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            stack.append(node.plan())
        children = node.children()
        stack.extend(children.apply(k) for k in range(children.length()))
    return best


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("kpi", ["gold_revenue_by_category", "gold_revenue_by_state", "gold_seller_performance"])
def test_dominant_keys_are_split_when_nothing_can_be_broadcast(spark, conf, kpi):
    """One product, one customer and one order with very many sellers hold a third of the rows."""
    conf(**{k.replace(".", "__"): v for k, v in SKEW.items()})
    tables = hot_tables(spark)
    df = gold.seller_totals(tables) if kpi == "gold_seller_performance" else gold.GOLD[kpi](tables)
    rows = df.collect()
    assert "skew=true" in physical(df)
    conf(**{k.replace(".", "__"): v for k, v in {
        "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "10m"}.items()})
    plain = gold.seller_totals(tables) if kpi == "gold_seller_performance" else gold.GOLD[kpi](tables)
    assert sorted(map(str, rows)) == sorted(map(str, plain.collect()))


def test_row_copies_combine_before_the_shuffle(spark):
    df = spark.range(0, 90_000, 1, 8).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.md5(F.col("id").cast("string"))).alias("_row_hash"))
    text = physical(quality.duplicates.duplicate_summary(df))
    assert text.index("Exchange hashpartitioning") < text.rindex("partial_count")
    assert tuple(quality.duplicates.duplicate_summary(df).first()) == (90_000, 1, 29_999)


def test_one_scan_answers_null_staleness_and_volume(spark, tmp_path):
    star.bronze(spark, FOLDER, "orders").write.parquet(str(tmp_path / "o"))
    plan = physical(quality.profile_outcomes({"orders": spark.read.parquet(str(tmp_path / "o"))}, ["orders"], "2024-01-31"))
    assert plan.count("FileScan parquet") == 1
    assert "order_approved_at" not in plan  # only critical columns and the load time are read


def test_kpis_read_only_their_columns(spark, tmp_path):
    stored = {}
    for table in ("orders", "order_items", "order_payments"):
        silver.clean(table, star.bronze(spark, FOLDER, table)).write.parquet(str(tmp_path / table))
        stored[table] = spark.read.parquet(str(tmp_path / table))
    plan = physical(gold.daily_revenue(stored))
    assert "ReadSchema: struct<order_id:string,payment_value:double>" in plan
    assert "ReadSchema: struct<order_id:string,freight_value:double>" in plan
    assert "In(order_status, [delivered,invoiced,shipped])" in plan and plan.count("FileScan parquet") == 3
