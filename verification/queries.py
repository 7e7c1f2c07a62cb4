"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, ROW_HASH, TABLES
from tidemark.functions.clean import row_hash
from tidemark.operators import anomalies, drift, duplicates, profile
from tidemark.plans import audit, bronze, gold, quality, silver
from tidemark.plans.bucketed import BucketedSilver
from tidemark.session import scratch_path
from tidemark.sources import star
from tidemark.sources.files import TableStore, preview, table_shape, write_csv
from tidemark.sources.schemas import source_columns, source_schema
from verification.settings import AS_OF, CONTEXT, SCALED_DOWN, STATUS_TABLES

Query = Callable[[SparkSession, str], DataFrame]
BUCKETED_KPIS = ("gold_daily_revenue", "gold_revenue_by_category", "gold_customer_satisfaction", "gold_seller_performance")


def _silver(spark: SparkSession, folder: str) -> gold.Silver:
    return silver.CleanTables(lambda table: star.bronze(spark, folder, table))


def _kpi(build: Callable[[gold.Silver], DataFrame]) -> Query:
    return lambda spark, folder: build(_silver(spark, folder))


def _bucketed_kpi(name: str) -> Query:
    """A KPI over fact tables that were written in buckets by order."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables = BucketedSilver(spark, _silver(spark, folder), f"facts_{uuid.uuid4().hex[:12]}", buckets)
        return gold.GOLD[name](tables)

    return run


def _silver_table(table: str) -> Query:
    return lambda spark, folder: silver.clean(table, star.bronze(spark, folder, table))


def silver_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    parts = [silver.row_accounting(table, star.bronze(spark, folder, table)) for table in TABLES]
    return reduce(DataFrame.unionByName, parts)


def quarantine_reviews(spark: SparkSession, folder: str) -> DataFrame:
    rejected = silver.quarantine("order_reviews", star.bronze(spark, folder, "order_reviews"))
    return rejected.select("review_id", "order_id", "review_score", "reject_reason")


def order_status_share(spark: SparkSession, folder: str) -> DataFrame:
    return gold.order_status_share(star.bronze(spark, folder, "orders"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class StarBronze(Mapping[str, DataFrame]):
    """Bronze tables planned on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder, self._planned = spark, folder, {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._planned:
            self._planned[table] = star.bronze(self._spark, self._folder, table)
        return self._planned[table]

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


# ---- Loading ------------------------------------------------------------------------------


def row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    df = star.source(spark, folder, "orders")
    return df.select("order_id", row_hash(source_columns("orders")).alias(ROW_HASH))


def load_metadata(spark: SparkSession, folder: str) -> DataFrame:
    df = star.source(spark, folder, "order_payments")
    loaded = bronze.with_load_metadata(df, TABLES["order_payments"].source_file(), AS_OF)
    return loaded.select("order_id", LOADED_AT, "_source_file", "_pipeline_version", ROW_HASH)


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    changed = {
        "orders": lambda df: df.drop("order_status").withColumn("promo_code", F.lit("none")),
        "order_items": lambda df: df.withColumn("price", F.col("price").cast("string")),
    }
    parts = []
    for table, spec in TABLES.items():
        df = changed.get(table, lambda d: d)(star.source(spark, folder, table))
        report = drift.drift_report(df, source_schema(table), table, spec.critical)
        lists = ("missing_columns", "extra_columns", "type_mismatches", "critical_missing")
        parts.append(
            report.select("table_name", "row_count", "has_drift", *[F.array_join(n, ",").alias(n) for n in lists])
        )
    return _union(parts)


def header_drift_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Items written as CSV with a renamed column and unreadable prices, then read back."""
    path = scratch_path(spark, "items-csv")
    items = star.source(spark, folder, "order_items")
    damaged = items.withColumn("price", F.coalesce(F.col("price").cast("string"), F.lit("n/a")))
    write_csv(damaged.withColumnRenamed("freight_value", "freight"), path)
    text, found = bronze.read_source(spark, TABLES["order_items"], path)
    return drift.damage_report(text, source_schema("order_items"), TABLES["order_items"].bronze).withColumns(
        {
            "missing_columns": F.lit(",".join(found.missing_columns)),
            "extra_columns": F.lit(",".join(found.extra_columns)),
        }
    )


def load_status(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for table in STATUS_TABLES:
        spec = replace(TABLES[table], min_rows=TABLES[table].min_rows // SCALED_DOWN)
        parts.append(
            profile.table_profile(star.source(spark, folder, table), spec).select(
                "table_name", F.col("row_count").alias("rows_loaded"), F.col("min_rows").alias("rows_expected_min")
            )
        )
    return audit.load_status(_union(parts))


def bronze_load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All tables exported as CSV, loaded into bronze, and the audit log of that."""
    files, store = scratch_path(spark, "csv"), TableStore(spark, scratch_path(spark, "store"))
    star.export(spark, folder, files)
    bronze.load_all(store, files, CONTEXT)
    return bronze.read_audit(store).select("table_name", "load_status", "rows_loaded", "rows_expected_min")


def _orders_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, scratch_path(spark, "store"))


def _load_orders(store: TableStore, df: DataFrame, load_id: str, mode: str, as_of: str) -> None:
    path = scratch_path(store.spark, "orders-csv")
    write_csv(df, path)
    bronze.load_table(store, TABLES["orders"], path, replace(CONTEXT, as_of=as_of), mode, load_id)


def snapshot_restore(spark: SparkSession, folder: str) -> DataFrame:
    """A good load, a bad reload with damaged states, and the first version restored."""
    store, orders = _orders_store(spark), star.source(spark, folder, "orders")
    _load_orders(store, orders, "good", "overwrite", "2024-01-29 06:00:00")
    _load_orders(store, orders.withColumn("order_status", F.lit("lost")), "bad", "overwrite", "2024-01-30 06:00:00")
    bronze.restore(store, "orders", 0, CONTEXT)
    current = bronze.read_bronze(store, "orders")
    return current.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count"), F.countDistinct("order_id").alias("orders")
    )


def incremental_append(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in two loads, the second appended; the current version holds both."""
    store, orders = _orders_store(spark), star.source(spark, folder, "orders")
    even = F.col("order_id").cast("bigint") % 2 == 0
    _load_orders(store, orders.where(even), "first", "overwrite", "2024-01-29 06:00:00")
    _load_orders(store, orders.where(~even), "second", "append", "2024-01-30 06:00:00")
    return bronze.read_bronze(store, "orders").groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))


def _event_audit(spark: SparkSession, folder: str) -> DataFrame:
    """An audit log in which every (event type, day) is one load of a table of that name."""
    events = star.read(spark, folder, "events")
    day = F.to_date("ts").alias("day")
    grouped = events.groupBy("event_type", day).agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.count_if(F.col("user_id") % 97 == 0).alias("faults"),
        F.max("ts").alias("ingestion_timestamp"),
    )
    return grouped.select(
        F.concat_ws("-", "event_type", F.col("day").cast("string")).alias("audit_id"),
        F.col("event_type").alias("table_name"),
        F.when(F.col("faults") * 50 > F.col("rows_loaded"), "FAILED")
        .when(F.col("rows_loaded") < 66, "PARTIAL")
        .otherwise("SUCCESS")
        .alias("load_status"),
        "rows_loaded",
        F.lit(66).cast("bigint").alias("rows_expected_min"),
        F.lit(None).cast("string").alias("schema_drift_detected"),
        F.lit(None).cast("string").alias("error_message"),
        "ingestion_timestamp",
        F.concat(F.lit("load-"), F.date_format("day", "yyyyMMdd")).alias("load_id"),
        F.when(F.day("day") % 7 == 1, "overwrite").otherwise("append").alias("write_mode"),
    )


# ---- Checks -------------------------------------------------------------------------------


def _findings(outcome: DataFrame) -> DataFrame:
    return outcome.select("check_name", "table_name", "rows_scanned", F.inline("findings")).drop("sample_records")


def _check(outcomes: Callable[..., DataFrame], *args: object, name: str | None = None) -> Query:
    """Findings of one check over all tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        outcome = outcomes(StarBronze(spark, folder), tuple(TABLES), *args)
        return _findings(outcome.where(F.col("check_name") == name) if name else outcome)

    return run


def dup_rows(spark: SparkSession, folder: str) -> DataFrame:
    tables = StarBronze(spark, folder)
    return _union(
        [
            duplicates.duplicate_summary(tables[t]).select(
                F.lit(spec.bronze).alias("table_name"), "row_count", "extra_rows"
            )
            for t, spec in TABLES.items()
        ]
    )


def dup_row_sample(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.bronze(spark, folder, "orders")
    return duplicates.duplicate_sample(orders).select(*source_columns("orders"), ROW_HASH)


def null_row_sample(spark: SparkSession, folder: str) -> DataFrame:
    tables = StarBronze(spark, folder)
    return _union(
        [
            profile.null_rows(tables[t], spec).select(F.lit(t).alias("table_name"), "column_name", ROW_HASH)
            for t, spec in TABLES.items()
        ]
    )


def revenue_anomaly_days(spark: SparkSession, folder: str) -> DataFrame:
    tables = StarBronze(spark, folder)
    days = anomalies.unusual_days(anomalies.revenue_days(tables["order_payments"], tables["orders"]))
    return days.select("order_date", "daily_revenue", "day_count", F.round("z_score", 4).alias("z_score"))


def _value_columns(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, list[str]]]:
    tables = StarBronze(spark, folder)
    return {
        "order_payments": (tables["order_payments"], ["payment_value"]),
        "order_items": (tables["order_items"], ["price", "freight_value"]),
        "events": (star.read(spark, folder, "events"), ["value"]),
        "customer": (star.read(spark, folder, "customer"), ["c_acctbal"]),
    }


def _values(make: Callable[[dict], DataFrame], *names: str, found: str | None = None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        profiles = make(_value_columns(spark, folder))
        kept = profiles.where(F.col(found) > 0) if found else profiles
        return kept.select("table_name", "column_name", *names)

    return run


def outlier_values(spark: SparkSession, folder: str) -> DataFrame:
    """The five furthest values of either kind of outlier in every value column."""
    profiles = anomalies.value_profiles(_value_columns(spark, folder))
    return _union(
        [
            profiles.select("table_name", "column_name", F.lit(kind).alias("test"), F.posexplode(f"{kind}_top").alias("place", "value"))
            for kind in anomalies.OUTLIERS
        ]
    ).withColumn("place", F.col("place") + 1)


def _run(use: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: use(quality.outcomes(StarBronze(spark, folder), AS_OF))


def _without_samples(outcome: DataFrame) -> DataFrame:
    return quality.violations(outcome, CONTEXT).drop("sample_records")


def dq_violation_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The violations table with sample rows; their JSON text has no SQL counterpart."""
    tables = StarBronze(spark, folder)
    return quality.violations(quality.outcomes(tables, AS_OF), CONTEXT, quality.samples(tables))


def dq_strict_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _without_samples(quality.strict_outcomes(StarBronze(spark, folder), AS_OF))


# ---- Over time ----------------------------------------------------------------------------


def rolling_volume(spark: SparkSession, folder: str) -> DataFrame:
    per_day = star.read(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return quality.rolling_volume(per_day, drop_pct=5.0)


def cross_batch_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders loaded once, and a part of them delivered again a day later."""
    orders = star.source(spark, folder, "orders")
    again = orders.where(F.col("order_id").cast("bigint") % 50 == 3)
    file = TABLES["orders"].source_file()
    loads = bronze.with_load_metadata(orders, file, "2024-01-30 06:00:00").unionByName(
        bronze.with_load_metadata(again, file, "2024-01-31 06:00:00")
    )
    return duplicates.cross_batch_duplicates(loads)


def _violation_history(spark: SparkSession, folder: str) -> DataFrame:
    """A violations table in which every quarter of orders is one run of a null check."""
    quarter = F.date_trunc("quarter", "o_orderdate").alias("check_timestamp")
    counted = star.read(spark, folder, "orders").groupBy(quarter, "o_orderpriority").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("o_orderkey") % 5 == 3).alias("violation_count")
    )
    return counted.where(F.col("violation_count") > 0).select(
        F.lit("null_check").alias("check_name"),
        F.col("o_orderpriority").alias("table_name"),
        F.when(F.col("violation_count") * 5 > F.col("total"), "CRITICAL").otherwise("WARNING").alias("severity"),
        "violation_count",
        "check_timestamp",
    )


def open_critical(spark: SparkSession, folder: str) -> DataFrame:
    runs = star.read(spark, folder, "orders").select(F.date_trunc("quarter", "o_orderdate").alias("run_timestamp"))
    return quality.open_critical(_violation_history(spark, folder), runs).select(
        "check_name", "table_name", "check_timestamp", "violation_count"
    )


def _first(df: DataFrame) -> DataFrame:
    return preview(df, order=df.columns)


QUERIES: dict[str, Query] = {
    **{name: _kpi(build) for name, build in gold.GOLD.items()},
    **{name.replace("gold_", "bucketed_"): _bucketed_kpi(name) for name in BUCKETED_KPIS},
    "order_status_share": order_status_share,
    "top_seller_cities": _kpi(gold.top_seller_cities),
    "top_categories": _kpi(gold.top_categories),
    "daily_revenue_order_grain": _kpi(gold.daily_revenue_order_grain),
    "state_revenue_order_grain": _kpi(gold.revenue_by_state_order_grain),
    "seller_performance_order_grain": _kpi(gold.seller_performance_order_grain),
    **{f"silver_{table}": _silver_table(table) for table in TABLES},
    "silver_run_summary": silver_run_summary,
    "quarantine_reviews": quarantine_reviews,
    "row_hash": row_hashes,
    "load_metadata": load_metadata,
    "schema_drift": schema_drift,
    "header_drift_counts": header_drift_counts,
    "load_status": load_status,
    "load_status_by_outcome": lambda spark, folder: audit.by_outcome(load_status(spark, folder)),
    "bronze_load_audit": bronze_load_audit,
    "last_load_status": lambda spark, folder: audit.last_status(_event_audit(spark, folder)),
    "audit_log_view": lambda spark, folder: audit.log_view(_event_audit(spark, folder)).drop(
        "schema_drift_detected", "error_message"
    ),
    "load_history": lambda spark, folder: audit.history(_event_audit(spark, folder)),
    "current_loads": lambda spark, folder: audit.version_loads(_event_audit(spark, folder)),
    "snapshot_restore": snapshot_restore,
    "incremental_append": incremental_append,
    "table_shapes": lambda spark, folder: _union(
        [table_shape(df, TABLES[t].bronze) for t, df in star.all_bronze(spark, folder).items()]
    ),
    "table_preview": lambda spark, folder: _first(_silver(spark, folder)["customers"]),
    "dup_rows": dup_rows,
    "dup_row_sample": dup_row_sample,
    "dup_key_conflicts": lambda spark, folder: duplicates.key_conflicts(
        star.bronze(spark, folder, "order_payments"), TABLES["order_payments"].business_key
    ),
    "duplicate_check": _check(quality.duplicate_outcomes),
    "null_check_a": _check(quality.profile_outcomes, AS_OF, name="null_check"),
    "null_check_b": _check(quality.strict_profile_outcomes, AS_OF, name="strict_null_check"),
    "null_row_sample": null_row_sample,
    "staleness_a": _check(quality.profile_outcomes, AS_OF, name="staleness_check"),
    "staleness_b": _check(quality.strict_profile_outcomes, AS_OF, name="strict_staleness_check"),
    "volume_check": _check(quality.profile_outcomes, AS_OF, name="volume_check"),
    "revenue_anomaly_days": revenue_anomaly_days,
    "value_outliers_z": _values(anomalies.z_outliers, "value_count", "z_outliers"),
    "value_outliers_iqr": _values(anomalies.value_profiles, "q1", "q3", "iqr_outliers"),
    "outlier_values": outlier_values,
    "zero_values": _values(anomalies.value_statistics, "zero_values", found="zero_values"),
    "negative_values": _values(anomalies.value_statistics, "negative_values", found="negative_values"),
    "dq_outcomes": _run(
        lambda o: o.select(
            "check_name", "table_name", "status", "rows_scanned", F.size("findings").cast("bigint").alias("findings")
        )
    ),
    "dq_violations": _run(_without_samples),
    "dq_violation_samples": dq_violation_samples,
    "dq_summary": _run(lambda o: quality.summary(o, CONTEXT)),
    "dq_check_rollup": _run(quality.rollup),
    "dq_severity_counts": _run(lambda o: quality.severity_counts(quality.violations(o, CONTEXT))),
    "dq_strict_violations": dq_strict_violations,
    "rolling_volume": rolling_volume,
    "cross_batch_duplicates": cross_batch_duplicates,
    "violation_trend": lambda spark, folder: quality.violation_trend(_violation_history(spark, folder)),
    "open_critical": open_critical,
}
