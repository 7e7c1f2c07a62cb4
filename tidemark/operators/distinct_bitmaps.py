"""Mergeable exact distinct counts: bitmaps per period and bucket of ids.

A bitmap holds the ids of one bucket of 64 consecutive whole numbers, as one BIGINT. Bitmaps are built
once per day, stored, and combined for any longer period with a bitwise or, so distinct ids over a month
need no second look at the rows. A bitmap is no wider than an id: where the ids of a day lie far apart,
bitmaps take the room of the ids and not of the numbers between them.

Ids of a day rarely meet in one task, so a table of groups before the shuffle would be as large as the
task's input. Each batch of rows drops its repeated ids instead, and the tables of groups are built behind
the shuffle, where a task holds one of ``spark.sql.shuffle.partitions`` parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _without_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of one batch once, so an id with very many rows is one row a batch."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        yield from rows.group_by(rows.column_names, use_threads=False).aggregate([]).to_batches()


def _dealt(df: DataFrame, *by: str) -> DataFrame:
    """All rows of one group in one part; the number of parts stays as set, however small they are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def daily_bitmaps(df: DataFrame, day: Column, id_column: str, *by: str) -> DataFrame:
    """(by, day, bucket, ids): the bitmaps of whole-number ids; null ids take no part.

    A bucket has the numbers from 64 times its own; negative ids have buckets of their own.
    """
    ids = df.select(*by, day.alias("day"), F.col(id_column).cast("bigint").alias("id")).where("id IS NOT NULL")
    seen = ids.mapInArrow(_without_repeats, ids.schema).withColumn("bucket", F.shiftright("id", 6))
    key = [*by, "day", "bucket"]
    return _dealt(seen, *key).groupBy(*key).agg(F.bit_or(F.expr("shiftleft(1L, cast(id & 63 AS INT))")).alias("ids"))


def distinct_over(bitmaps: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, period, distinct_ids) from stored bitmaps, for any period made of whole days."""
    key = [*by, "period", "bucket"]
    merged = _dealt(bitmaps.select(*by, period.alias("period"), "bucket", "ids"), *key).groupBy(*key).agg(F.bit_or("ids").alias("ids"))
    return merged.groupBy(*by, "period").agg(F.sum(F.bit_count("ids")).cast("bigint").alias("distinct_ids"))
