"""The load audit log and what is read from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import RunContext, TableSpec
from tidemark.sources.schemas import AUDIT_DDL

READABLE = ("SUCCESS", "PARTIAL")
MAX_MESSAGE = 2000


def audit_row(
    spark: SparkSession,
    ctx: RunContext,
    spec: TableSpec,
    status: str,
    load_id: str,
    write_mode: str,
    source_file: str,
    rows_loaded: int | None = None,
    drift_json: str | None = None,
    error: str | None = None,
) -> DataFrame:
    """One load attempt as a one-row DataFrame."""
    instant = spark.range(1).select(F.lit(ctx.as_of).cast("timestamp").alias("t"))
    row = {
        "audit_id": f"{load_id}-{spec.name}",
        "pipeline_name": ctx.pipeline_name,
        "pipeline_version": ctx.pipeline_version,
        "table_name": spec.bronze,
        "source_file": source_file,
        "load_status": status,
        "rows_loaded": rows_loaded,
        "rows_expected_min": spec.min_rows,
        "schema_drift_detected": drift_json,
        "error_message": error[:MAX_MESSAGE] if error else None,
        "environment": ctx.environment,
        "load_id": load_id,
        "write_mode": write_mode,
    }
    own = {"ingestion_timestamp": F.col("t"), "committed_at": F.current_timestamp()}
    types = dict(part.replace("NOT NULL", "").split() for part in AUDIT_DDL.split(","))
    columns = [
        own[name].alias(name) if name in own else F.lit(row[name]).cast(kind).alias(name)
        for name, kind in types.items()
    ]
    return instant.select(*columns)


def load_status(rows: DataFrame) -> DataFrame:
    """SUCCESS or PARTIAL from (table_name, rows_loaded, rows_expected_min)."""
    short = F.col("rows_loaded") < F.coalesce("rows_expected_min", F.lit(0))
    return rows.withColumn("load_status", F.when(short, "PARTIAL").otherwise("SUCCESS"))


def by_outcome(statuses: DataFrame) -> DataFrame:
    """Tables per load status; the list holds one entry per configured table."""
    return statuses.groupBy("load_status").agg(
        F.count(F.lit(1)).alias("tables"),
        F.array_join(F.array_sort(F.collect_set("table_name")), ",").alias("table_names"),
    )


def log_view(audit: DataFrame) -> DataFrame:
    """The audit log as shown to people, oldest attempt first."""
    return audit.select(
        "table_name", "load_status", "rows_loaded", "rows_expected_min",
        "schema_drift_detected", "error_message", "ingestion_timestamp",
    ).orderBy("ingestion_timestamp", "table_name")


def _order(audit: DataFrame) -> list[str]:
    """Reported time, then commit time: runs may repeat with one reported time."""
    committed = ["committed_at"] if "committed_at" in audit.columns else []
    return ["ingestion_timestamp", *committed, "audit_id"]


def last_status(audit: DataFrame, table: str | None = None) -> DataFrame:
    """Newest load status of one table, or of every table."""
    rows = audit if table is None else audit.where(F.col("table_name") == table)
    newest = F.max_by(F.struct("load_status", "rows_loaded"), F.struct(*_order(audit)))
    return (
        rows.groupBy("table_name")
        .agg(newest.alias("last"), F.max("ingestion_timestamp").alias("loaded_at"))
        .select("table_name", "last.load_status", "last.rows_loaded", "loaded_at")
    )


def history(audit: DataFrame) -> DataFrame:
    """Readable loads per table with their version number, first load = 0.

    The log has one row per load of a table, so a table's loads fit one task.
    """
    order = Window.partitionBy("table_name").orderBy(*_order(audit))
    return audit.where(F.col("load_status").isin(*READABLE)).select(
        "table_name",
        (F.row_number().over(order) - 1).alias("version"),
        "load_id",
        "write_mode",
        "load_status",
        "rows_loaded",
        "ingestion_timestamp",
    )


def version_loads(audit: DataFrame, table: str | None = None, version: int | None = None) -> DataFrame:
    """The loads that make up a version: the last overwrite up to it and all appends after.

    Of one table or of every table; the newest version when none is given.
    """
    upto = history(audit)
    if table is not None:
        upto = upto.where(F.col("table_name") == table)
    if version is not None:
        upto = upto.where(F.col("version") <= version)
    base = F.max(F.when(F.col("write_mode") == "overwrite", F.col("version"))).over(Window.partitionBy("table_name"))
    return upto.withColumn("base", F.coalesce(base, F.lit(0))).where(F.col("version") >= F.col("base")).drop("base")
