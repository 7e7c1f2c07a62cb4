"""Quality checks on a stream: each micro-batch is profiled once, duplicates are seen across batches.

Two queries read the same source. The first writes a profile row per batch (rows, nulls, newest load
time); the second keeps row hashes as keyed state and writes how many rows of the batch were seen
for the first time. Rows beyond those are repeats, of the same batch or of any earlier one, and no
earlier load is read again. Results are written per batch number, so a batch that is replayed after a
failure replaces its own row. Outcomes of all batches so far come from those few rows.

The state holds a hash per distinct row. With ``keep`` (an interval on the load time) hashes older
than that are dropped, so the state is bounded by what arrives in that time; a repeat that comes
later than that is then taken for new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, ROW_HASH, QualityPolicy, TableSpec
from tidemark.operators import profile
from tidemark.plans import quality

PROFILE_DDL = f"""table_name STRING, min_rows BIGINT, has_load_time BOOLEAN, row_count BIGINT, latest TIMESTAMP,
    nulls {profile.NULLS_TYPE}, batch BIGINT"""
FIRSTS_DDL = "first_rows BIGINT, batch BIGINT"


def _replace(df: DataFrame, folder: str, batch: int) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def check_stream(source: Callable[[], DataFrame], spec: TableSpec, root: str, keep: str | None = None) -> None:
    """Run both queries over everything that is there and not yet seen.

    ``source`` makes the streaming DataFrame of the table, with row hash and load time.
    """

    def profiled(batch: DataFrame, number: int) -> None:
        _replace(profile.table_profile(batch, spec), f"{root}/profiles", number)

    def counted(batch: DataFrame, number: int) -> None:
        _replace(batch.agg(F.count(F.lit(1)).alias("first_rows")), f"{root}/firsts", number)

    hashes = source().select(ROW_HASH, LOADED_AT)
    firsts = (
        hashes.withWatermark(LOADED_AT, keep).dropDuplicatesWithinWatermark([ROW_HASH])
        if keep else hashes.select(ROW_HASH).dropDuplicates([ROW_HASH])
    )
    queries = [
        frame.writeStream.foreachBatch(action).option("checkpointLocation", f"{root}/checkpoints/{name}").trigger(availableNow=True).start()
        for name, frame, action in (("profiles", source(), profiled), ("firsts", firsts, counted))
    ]
    for query in queries:
        query.awaitTermination()


def outcomes(spark: SparkSession, spec: TableSpec, root: str, as_of: str, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Duplicate, null, staleness and volume outcomes over all batches seen so far."""
    profiles = spark.read.schema(PROFILE_DDL).parquet(f"{root}/profiles")
    firsts = spark.read.schema(FIRSTS_DDL).parquet(f"{root}/firsts")
    # one row per batch on either side
    nulls = profiles.select(F.explode("nulls").alias("n")).groupBy("n.column_name").agg(F.sum("n.null_count").alias("null_count"))
    listed = nulls.agg(F.array_sort(F.collect_list(F.struct("column_name", "null_count"))).cast(profile.NULLS_TYPE).alias("nulls"))
    whole = profiles.agg(
        F.first("table_name").alias("table_name"), F.first("min_rows").alias("min_rows"), F.bool_and("has_load_time").alias("has_load_time"),
        F.sum("row_count").alias("row_count"), F.max("latest").alias("latest"),
    ).withColumn("nulls", listed.select("nulls").scalar())
    first_rows = firsts.agg(F.sum("first_rows").alias("n")).select("n").scalar()
    repeated = whole.select("table_name", "row_count", (F.col("row_count") - first_rows).alias("extra_rows"))
    return quality.outcomes_of_profiles(whole, as_of, policy).unionByName(quality.repeat_outcomes(repeated, policy))
