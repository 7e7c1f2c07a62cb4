"""Registered queries over whole runs: layers, rebuilds, splits, streams, findings over time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, ROW_HASH, TABLES, TableSpec
from tidemark.functions import exact
from tidemark.operators import distinct_bitmaps
from tidemark.plans import bronze, gold, pipeline, quality, rebuild, registry, silver
from tidemark.session import scratch_path, stage
from tidemark.sources import star
from tidemark.sources.files import TableStore, write_csv
from tidemark.streaming import checks
from verification.settings import AS_OF, CONTEXT

EVENTS = TableSpec("events", 1_000_000, ("user_id", "value"))


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, scratch_path(spark, "store"))


def money_extremes(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of amounts with many decimals, amounts above 1e16, and amounts that no sum can hold."""
    key = F.col("l_orderkey") % 11
    amount = (
        F.when(key == 0, F.lit(0.00004)).when(key == 1, F.lit(12345678901234568.0)).when(key == 2, F.lit(float("nan")))
        .when(key == 3, F.lit(1e30)).when(key == 4, F.lit(0.1234567)).otherwise(F.col("l_extendedprice"))
    )
    rows = star.read(spark, folder, "lineitem").select("l_returnflag", amount.alias("amount"))
    return rows.groupBy("l_returnflag").agg(
        exact.amount(F.sum(exact.money("amount")), 7).cast("string").alias("total"),
        F.count("amount").alias("amounts"), exact.left_out("amount").alias("left_out"),
    )


def dq_outcomes_concurrent(spark: SparkSession, folder: str) -> DataFrame:
    """The standard run with every scan as a job of its own, side by side."""
    tables = {t: star.bronze(spark, folder, t) for t in TABLES}
    return quality.isolated_outcomes(spark, tables, AS_OF).select(
        "check_name", "table_name", "status", "rows_scanned", F.size("findings").cast("bigint").alias("findings")
    )


def dq_run_records(spark: SparkSession, folder: str) -> DataFrame:
    """Both check families under one run id, the standard one recorded twice."""
    store, tables = _store(spark), {t: star.bronze(spark, folder, t) for t in TABLES}
    standard = stage(quality.outcomes(tables, AS_OF), "standard")
    strict = stage(quality.strict_outcomes(tables, AS_OF), "strict")
    for outcomes, family in ((standard, pipeline.STANDARD), (strict, pipeline.STRICT), (standard, pipeline.STANDARD)):
        pipeline.record_run(store, CONTEXT, outcomes, None, family)
    found = store.read("quality", "dq_violations").groupBy("run_id", "family").agg(F.count(F.lit(1)).alias("violations"))
    summary = store.read("quality", "dq_summary").select("run_id", "family", "total_checks", "passed", "failed", "overall_status")
    return summary.join(found, ["run_id", "family"])


def gold_partial_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """All months built without some payments, then just the months that those touch built again."""
    store = _store(spark)
    tables = silver.CleanTables(lambda table: star.bronze(spark, folder, table))
    late = (F.col("order_id").cast("bigint") % 40 == 3) & (F.col("payment_sequential") == 1)
    early = {**{t: tables[t] for t in ("orders", "order_items")}, "order_payments": tables["order_payments"].where(~late)}
    rebuild.build(store, early)
    rebuild.rebuild(store, tables, tables["order_payments"].where(late))
    return rebuild.daily_revenue(store)


def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table and outcome, read back from the two tables of one write each."""
    store, parts = _store(spark), []
    for table, spec in TABLES.items():
        pipeline.split_table(store, table, star.bronze(spark, folder, table))
        kept = store.read("silver", spec.silver).select(F.lit(silver.KEPT).alias("outcome"))
        rejected = store.read("quarantine", spec.silver).select(F.col("reject_reason").alias("outcome"))
        both = kept.unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(both.select(F.lit(spec.silver).alias("table_name"), "outcome", "row_count"))
    return reduce(DataFrame.unionByName, parts)


def layer_runs(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files loaded, all silver tables cleaned with quarantine, all KPIs built: the status rows."""
    files, store = scratch_path(spark, "csv"), _store(spark)
    star.export(spark, folder, files)
    bronze.load_all(store, files, CONTEXT)
    layers = {"silver": pipeline.run_silver(store, quarantine=True), "gold": pipeline.run_gold(store)}
    return reduce(
        DataFrame.unionByName, [rows.withColumn("layer", F.lit(layer)).drop("seconds", "error") for layer, rows in layers.items()]
    )


def rolling_volume_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Events per calendar day without those of each month's ninth day."""
    day = F.to_date("ts").alias("day")
    per_day = star.read(spark, folder, "events").where(F.dayofmonth("ts") != 9).groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))
    return quality.rolling_volume_by_calendar(per_day, drop_pct=5.0)


def finding_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Critical null findings over quarterly runs: since when, in a row, reopened, open."""
    from verification.queries import _violation_history

    critical = _violation_history(spark, folder).where(F.col("severity") == "CRITICAL")
    runs = star.read(spark, folder, "orders").select(F.date_trunc("quarter", "o_orderdate").alias("run_timestamp"))
    return quality.finding_spans(critical, runs, "check_name", "table_name")


def monthly_distinct_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders shipped per month and flag, from stored daily bitmaps."""
    lines = star.read(spark, folder, "lineitem")
    daily = stage(distinct_bitmaps.daily_bitmaps(lines, F.to_date("l_shipdate"), "l_orderkey", "l_returnflag"), "bitmaps")
    return distinct_bitmaps.distinct_over(daily, F.trunc("day", "month"), ["l_returnflag"]).withColumnRenamed("period", "month")


def stream_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Events arriving in three files, the later two with rows of earlier ones; checked batch by batch."""
    events = star.read(spark, folder, "events").withColumn("value", F.when(F.col("event_id") % 97 != 0, F.col("value")))
    part, again = F.col("event_id") % 3, F.col("event_id") % 30 == 0
    inbox, root = scratch_path(spark, "inbox"), scratch_path(spark, "stream-checks")
    hashed = events.withColumn(ROW_HASH, F.md5(F.concat_ws("|", "event_id", "user_id", "event_type")))
    for number in range(3):
        rows = hashed.where((part == number) | (again if number else F.lit(False)))
        loaded = F.lit(f"2024-01-{28 + number} 06:00:00").cast("timestamp")
        rows.withColumn(LOADED_AT, loaded).coalesce(1).write.mode("append").parquet(inbox)
    schema = spark.read.parquet(inbox).schema
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(inbox)
    checks.check_stream(source, EVENTS, root)
    return checks.outcomes(spark, EVENTS, root, AS_OF).select(
        "check_name", "table_name", "status", "rows_scanned", F.inline_outer("findings")
    ).select("check_name", "table_name", "status", "rows_scanned", "column_name", "severity", "violation_count")


def load_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Loads that go wrong or astray: a missing file, a missing critical column, a drifted header, no declared schema."""
    files, store = scratch_path(spark, "csv"), _store(spark)
    sources = {t: star.source(spark, folder, t) for t in ("orders", "customers", "sellers")}
    write_csv(sources["orders"].drop("order_status"), f"{files}/{TABLES['orders'].source_file()}")
    write_csv(sources["customers"].withColumnRenamed("customer_city", "town"), f"{files}/{TABLES['customers'].source_file()}")
    write_csv(sources["sellers"], f"{files}/{TABLES['sellers'].source_file()}")
    write_csv(star.read(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), f"{files}/coupons.csv")
    for table in ("orders", "customers", "sellers", "products"):  # no file of products
        bronze.load_table(store, TABLES[table], f"{files}/{TABLES[table].source_file()}", CONTEXT)
    bronze.load_table(store, TableSpec("coupons", 1, ("s_suppkey",)), f"{files}/coupons.csv", CONTEXT)
    report = F.from_json("schema_drift_detected", "has_drift boolean, missing_columns array<string>, extra_columns array<string>")
    log = bronze.read_audit(store).withColumn("report", report)
    reason = F.when(F.col("error_message").contains("critical columns missing"), "critical").when(F.col("error_message").contains("not found"), "no file")
    inferred = store.read("bronze", "bronze_coupons").schema["s_suppkey"].dataType.simpleString()
    return log.select(
        "table_name", "load_status", "rows_loaded", reason.alias("reason"), F.array_join("report.missing_columns", ",").alias("missing_columns"),
        F.array_join("report.extra_columns", ",").alias("extra_columns"),
        F.when(F.col("table_name") == "bronze_coupons", F.lit(inferred)).alias("inferred_type"),
    )


def sql_views(spark: SparkSession, folder: str) -> DataFrame:
    """Written tables as SQL views, and a query over two of them."""
    store = _store(spark)
    for table in ("orders", "order_payments"):
        store.overwrite(silver.clean(table, star.bronze(spark, folder, table)), "silver", TABLES[table].silver)
    store.register("silver", ["silver_orders", "silver_order_payments"])
    return spark.sql(
        """SELECT order_status, count(*) AS payments, count_if(is_high_value) AS high_value
           FROM silver_orders JOIN silver_order_payments USING (order_id) GROUP BY order_status"""
    )


def isolated_failure(spark: SparkSession, folder: str) -> DataFrame:
    """A standard run in which the duplicates of one table cannot be counted."""
    tables = {t: star.bronze(spark, folder, t) for t in TABLES}
    tables["customers"] = tables["customers"].withColumn(ROW_HASH, F.expr("raise_error('unreadable')").cast("string"))
    found = quality.isolated_outcomes(spark, tables, AS_OF)
    return found.select("check_name", "table_name", "status", F.size("findings").cast("bigint").alias("findings"))


def dq_sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The sample rows of the standard findings, read back from their JSON."""
    tables = {t: star.bronze(spark, folder, t) for t in TABLES}
    rows = quality.samples(tables).select(
        "check_name", "table_name", "column_name", F.explode(F.from_json("sample_records", "array<string>")).alias("row")
    )
    return rows.select("check_name", "table_name", "column_name", F.get_json_object("row", "$._row_hash").alias("row_hash"))


def registered_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The registered checks and one more over all tables, with limits from a table."""
    free = registry.Check(
        "free_freight",
        lambda df, spec: {"freight_value": F.count_if(F.col("freight_value") == 0)} if "freight_value" in df.columns else {},
        lambda values, limit: [(values["freight_value"] > limit, quality.finding("freight_value", "INFO", values["freight_value"], F.lit("items without freight")))],
    )
    # the least number of rows is three quarters of the orders, for every table but one
    orders = star.read(spark, folder, "orders").agg((F.count(F.lit(1)) * 0.75).alias("limit_value"))
    limits = orders.select(F.lit("least_rows").alias("check_name"), F.lit(None).cast("string").alias("table_name"), "limit_value").unionByName(
        spark.createDataFrame([("least_rows", "bronze_sellers", 1.0), ("null_share", "bronze_orders", 0.4)], registry.LIMITS_DDL)
    )
    tables = {t: star.bronze(spark, folder, t) for t in TABLES}
    found = registry.outcomes(tables, TABLES, limits, [*registry.CHECKS.values(), free])
    return found.select("check_name", "table_name", "status", "rows_scanned", F.inline_outer("findings")).select(
        "check_name", "table_name", "status", "rows_scanned", "column_name", "violation_count"
    )


QUERIES = {
    f.__name__: f
    for f in (
        money_extremes, dq_outcomes_concurrent, dq_run_records, gold_partial_rebuild, quarantine_split, layer_runs,
        rolling_volume_calendar, finding_spans, monthly_distinct_orders, stream_checks, load_outcomes, sql_views,
        isolated_failure, dq_sample_rows, registered_checks,
    )
}
GOLD_NAMES = tuple(gold.GOLD)
