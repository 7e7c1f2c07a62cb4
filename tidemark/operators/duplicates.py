"""Repeated rows and conflicting business keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, ROW_HASH


def _hash_key() -> Column:
    """The row hash as 16 bytes: half of what its hex text costs in a shuffle."""
    return F.coalesce(F.unhex(ROW_HASH), F.encode(ROW_HASH, "UTF-8"))


def _copies(df: DataFrame) -> DataFrame:
    return df.groupBy(_hash_key().alias("hash_key")).agg(F.count(F.lit(1)).alias("copies"))


def repeated_rows(df: DataFrame) -> DataFrame:
    """One row per row hash that occurs more than once: (hash_key, copies)."""
    return _copies(df).where(F.col("copies") > 1)


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: row_count, duplicate_groups, extra_rows (rows beyond the first of each group).

    Copies combine before the shuffle, so a row repeated very often is still one record.
    """
    return _copies(df).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("copies") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_rows"),
    )


def duplicate_sample(df: DataFrame, limit: int = 5) -> DataFrame:
    """The first ``limit`` rows, by row hash, among rows that are repeated.

    Only ``limit`` hashes are sent to the second scan; without duplicates adaptive execution
    drops that scan.
    """
    chosen = repeated_rows(df).orderBy("hash_key").limit(limit).select("hash_key")
    keyed = df.withColumn("hash_key", _hash_key())
    order = ["hash_key"] + ([LOADED_AT] if LOADED_AT in df.columns else [])
    return keyed.join(F.broadcast(chosen), "hash_key", "left_semi").orderBy(*order).limit(limit).drop("hash_key")


def key_conflicts(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Business keys that occur in several rows with different content: (keys, row_count).

    Different content shows as a smallest and a largest row hash that differ, which combines
    before the one shuffle; a distinct count would shuffle every hash. The hash is compared as
    two numbers of 64 bits, since extremes of text are planned as two sorts of the table.
    """
    halves = {
        name: F.when(F.col(ROW_HASH).isNotNull(), F.xxhash64(F.lit(seed), ROW_HASH))
        for seed, name in enumerate(("first", "second"))
    }
    bounds = [f(part).alias(f"{name}_{label}") for name, part in halves.items() for label, f in (("low", F.min), ("high", F.max))]
    differ = (F.col("first_low") != F.col("first_high")) | (F.col("second_low") != F.col("second_high"))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"), *bounds)
        .where((F.col("row_count") > 1) & differ)
        .select(*keys, "row_count")
    )


def cross_batch_duplicates(df: DataFrame) -> DataFrame:
    """Rows delivered again in a later load, per (first, last) load time."""
    return (
        df.groupBy(_hash_key().alias("hash_key"))
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(LOADED_AT).alias("first_loaded"),
            F.max(LOADED_AT).alias("last_loaded"),
        )
        .where(F.col("first_loaded") < F.col("last_loaded"))
        .groupBy("first_loaded", "last_loaded")
        .agg(F.count(F.lit(1)).alias("repeated_rows"), F.sum(F.col("copies") - 1).alias("extra_rows"))
    )
