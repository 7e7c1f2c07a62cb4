"""Positions in a global order without a single-task sort.

Values are first reduced to (value, count) and dealt into ranges whose bounds Spark samples from
the data, so ranges are even however narrow the values lie. Ranges are ordered and summed in one
small step while the values inside a range are ordered in parallel.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

def value_counts(df: DataFrame, value: str, *by: str) -> DataFrame:
    """(by, value, n) for every distinct non-null value. Equal values combine before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def value_positions(counts: DataFrame, value: str, *by: str, descending: bool = False) -> DataFrame:
    """(by, value, n, before, total) from ``value_counts``.

    ``before`` counts the rows that come earlier in the order, ``total`` all rows, both within
    ``by`` (names of a short list, such as column names).
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal (by, value) are one row, so no value lies in two ranges. Written once: ranges that are
    # sampled again would have other bounds.
    ranged = counts.repartitionByRange(parts, *by, value).withColumn("bucket", F.spark_partition_id())
    counted = stage(ranged, "ranges")
    direction = F.desc if descending else F.asc
    earlier = (Window.unboundedPreceding, -1)
    # One row per range (and name): as many as there are shuffle partitions.
    buckets = counted.groupBy(*by, "bucket").agg(F.sum("n").alias("bucket_n"))
    listed = Window.partitionBy(*by)
    buckets = buckets.select(
        *by,
        "bucket",
        F.sum("bucket_n").over(listed.orderBy(direction("bucket")).rowsBetween(*earlier)).alias("offset"),
        F.sum("bucket_n").over(listed).alias("total"),
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(direction(value)).rowsBetween(*earlier)
    return (
        counted.withColumn("local", F.sum("n").over(inside))
        .join(F.broadcast(buckets), [*by, "bucket"])
        .select(
            *by,
            value,
            "n",
            (F.coalesce("offset", F.lit(0)) + F.coalesce("local", F.lit(0))).alias("before"),
            "total",
        )
    )


def at_fraction(fraction: Fraction, value: str) -> Column:
    """Aggregate over ``value_positions``: the smallest value that covers ``fraction`` of the rows."""
    wanted = F.call_function(
        "div",
        F.col("total") * F.lit(fraction.numerator) + F.lit(fraction.denominator - 1),
        F.lit(fraction.denominator),
    )
    hit = (F.col("before") < wanted) & (wanted <= F.col("before") + F.col("n"))
    return F.max(F.when(hit, F.col(value)))


def rank_by_total(df: DataFrame, value: str, rank_name: str) -> DataFrame:
    """Adds the rank by ``value`` descending (ties share, gaps follow, nulls last).

    ``df`` is staged first because both the ranking and the result read it.
    """
    staged = stage(df, "ranked")
    positions = value_positions(value_counts(staged, value), value, descending=True).select(
        value, (F.col("before") + 1).cast("int").alias(rank_name)
    )
    last = F.coalesce(staged.agg(F.count(value).alias("n")).select("n").scalar(), F.lit(0)) + 1
    return staged.join(positions, value, "left").withColumn(
        rank_name, F.coalesce(F.col(rank_name), last.cast("int"))
    )
