"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tidemark.session import stage

__all__ = ["documents", "map_rows", "numbered", "remainder", "stage", "table", "worker_cache"]

#: Rows handed to Python at a time; long texts make larger batches heavy.
ROWS_PER_BATCH = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def remainder(column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % F.lit(by)


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[list], Iterable]], schema: str | StructType, rows: int = ROWS_PER_BATCH
) -> DataFrame:
    """Rows of ``df`` through Python, a slice of at most ``rows`` at a time.

    ``make()`` is called once in each task and returns a function from the list of column lists
    to an iterable of output column lists; its caches live as long as the task.
    """
    target = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in target.fields]
    kinds = [to_arrow_type(f.dataType) for f in target.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = work([column.to_pylist() for column in part.columns])
                arrays = [pa.array(values, type=kind) for values, kind in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, target)


def worker_cache(key: str, make: Callable):
    """An object kept by a Python worker from task to task; it must only save repeated work.

    Only the latest one is kept, so stages that follow each other do not add up their memory.
    """
    kept = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if kept.get("key") != key:
        kept.update(key=None, value=None)
        kept.update(key=key, value=make())
    return kept["value"]


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """Adds the global position (from 0) in ``order`` without sorting everything in one task.

    Rows are range-partitioned and sorted within partitions; only one count per partition meets
    the others. ``df`` should be a staged table, because the bounds are sampled from it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    placed = stage(placed, "numbered")
    part = F.shiftright("_row", 33)
    within = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    sizes = {r["_part"]: r["_n"] for r in counts.collect()}  # one row per partition
    start, starts = 0, []
    for key in sorted(sizes):
        starts.append((int(key), start))
        start += sizes[key]
    if not starts:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_row")
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in starts for x in pair]), part)
    return placed.withColumn(name, (offset + within).cast("long")).drop("_row")
