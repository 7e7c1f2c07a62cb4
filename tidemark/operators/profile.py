"""One-scan table profile: what the null, staleness and volume checks need."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, METADATA_COLUMNS, ROW_HASH, TableSpec

NULLS_TYPE = "array<struct<column_name:string,null_count:bigint>>"


def present_critical(df: DataFrame, spec: TableSpec) -> list[str]:
    """Critical columns the table has; a missing one is schema drift, reported by the loader."""
    return [name for name in spec.critical if name in df.columns]


def table_profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: table_name, row_count, latest load time, null count per critical column."""
    nulls = [
        F.struct(F.lit(name).alias("column_name"), F.count_if(F.col(name).isNull()).alias("null_count"))
        for name in present_critical(df, spec)
    ]
    latest = F.max(LOADED_AT) if LOADED_AT in df.columns else F.lit(None).cast("timestamp")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        latest.alias("latest"),
        F.array(*nulls).cast(NULLS_TYPE).alias("nulls"),
    ).select(
        F.lit(spec.bronze).alias("table_name"),
        F.lit(spec.min_rows).cast("bigint").alias("min_rows"),
        F.lit(LOADED_AT in df.columns).alias("has_load_time"),
        "row_count",
        "latest",
        "nulls",
    )


def null_rows(df: DataFrame, spec: TableSpec, limit: int = 5) -> DataFrame:
    """For each critical column the first ``limit`` rows (by row hash) where it is null.

    The filter reaches the file statistics, and the row-number limit is applied inside each
    task before the shuffle, so a column that is mostly null still sends ``limit`` rows a task.
    """
    columns = present_critical(df, spec)
    if not columns:
        return df.limit(0).withColumn("column_name", F.lit("")).select("column_name", *df.columns)
    any_null = F.col(columns[0]).isNull()
    for name in columns[1:]:
        any_null = any_null | F.col(name).isNull()
    missing = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in columns]))
    ties = [F.col(c) for c in df.columns if c not in METADATA_COLUMNS]
    order = [F.col(ROW_HASH)] if ROW_HASH in df.columns else ties
    first = F.row_number().over(Window.partitionBy("column_name").orderBy(*order))
    return (
        df.where(any_null)
        .withColumn("column_name", F.explode(missing))
        .withColumn("position", first)
        .where(F.col("position") <= limit)
        .select("column_name", *df.columns)
    )


def as_sample(rows: DataFrame, *keys: str) -> DataFrame:
    """At most a handful of rows as one JSON text per key; callers limit the rows."""
    body = [c for c in rows.columns if c not in keys]
    one = rows.select(*keys, F.to_json(F.struct(*body)).alias("row"))
    return one.groupBy(*keys).agg(F.to_json(F.array_sort(F.collect_list("row"))).alias("sample_records"))
