"""Statistical checks: unusual days and unusual values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import QualityPolicy, StrictPolicy
from tidemark.functions.clean import parse_date
from tidemark.functions.exact import amount, money
from tidemark.jobs import run_jobs
from tidemark.operators.furthest import Limits, unusual
from tidemark.operators.selection import quantiles
from tidemark.session import stage


def revenue_days(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Raw revenue per purchase date: (order_date, daily_revenue). An unknown date is a day too.

    Both sides are reduced per order first, so repeated orders weigh in without multiplying rows.
    """
    paid = payments.groupBy("order_id").agg(F.sum(money("payment_value")).alias("paid"))
    dated = orders.groupBy("order_id", parse_date("order_purchase_timestamp").alias("order_date")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    total = F.sum(F.col("copies") * F.col("paid"))
    return (
        dated.join(paid, "order_id")
        .groupBy("order_date")
        .agg(amount(total, 4).cast("double").alias("daily_revenue"))
    )


def scored_days(days: DataFrame) -> DataFrame:
    """Adds day_count, mean, spread and z_score over all days.

    There is one row per calendar day, so statistics over all of them fit one task. A zero or
    unknown deviation counts as 1, and 0.01 is the least divisor.
    """
    everything = Window.partitionBy()
    value = F.col("daily_revenue")
    deviation = F.stddev("daily_revenue").over(everything)
    return days.withColumns(
        {
            "day_count": F.count(F.lit(1)).over(everything),
            "mean_revenue": F.coalesce(F.avg("daily_revenue").over(everything), F.lit(0.0)),
            "spread": F.greatest(F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0)), F.lit(0.01)),
        }
    ).withColumn("z_score", F.abs((value - F.col("mean_revenue")) / F.col("spread")))


def unusual_days(days: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Days beyond the z limit; none while the history is too short."""
    return scored_days(days).where(
        (F.col("day_count") >= policy.min_history_days) & (F.col("z_score") > policy.revenue_z)
    )


OUTLIERS = ("z_outliers", "iqr_outliers")
QUARTILES = (Fraction(1, 4), Fraction(3, 4))
#: Values shown of each kind of outlier.
SHOWN = 5


# ---- Fixed values: what counts as an outlier, a zero and a negative value -----------------
def _value_tests(policy: StrictPolicy) -> dict[str, str]:
    z, iqr = policy.value_z, policy.iqr_multiplier
    return {
        "z_outliers": f"deviation > 0 AND abs(try_divide(value - mean, deviation)) > {z}",
        "iqr_outliers": f"q3 > q1 AND (value > q3 + {iqr} * (q3 - q1) OR value < q1 - {iqr} * (q3 - q1))",
        "zero_values": "value = 0",
        "negative_values": "value < 0",
    }


def _long_values(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, value) for every row and value column, from one scan."""
    each = ", ".join(f"struct('{c}' AS column_name, cast(`{c}` AS DOUBLE) AS value)" for c in columns)
    return df.select(F.lit(table).alias("table_name"), F.expr(f"inline(array({each}))"))


def value_statistics(sources: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per value column: value_count, mean, deviation, zero_values, negative_values.

    One aggregate per table that combines before the shuffle; no value is shuffled.
    """
    return _statistics({table: _long_values(table, df, columns) for table, (df, columns) in sources.items()})


def _statistics(values: Mapping[str, DataFrame]) -> DataFrame:
    value = F.col("value")
    parts = [
        long.groupBy("table_name", "column_name").agg(
            F.count("value").alias("value_count"),
            F.avg("value").alias("mean"),
            F.stddev("value").alias("deviation"),
            F.count_if(value == 0).alias("zero_values"),
            F.count_if(value < 0).alias("negative_values"),
        )
        for long in values.values()
    ]
    return reduce(DataFrame.unionByName, parts)


def z_outliers(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]], policy: StrictPolicy = StrictPolicy()
) -> DataFrame:
    """One row per value column: value_count and z_outliers. Two scans, no shuffle of values."""
    by = ["table_name", "column_name"]
    values = {table: _long_values(table, df, columns) for table, (df, columns) in sources.items()}
    # One row per value column.
    known = F.broadcast(stage(_statistics(values), "statistics"))
    test = F.count_if(F.expr(_value_tests(policy)["z_outliers"])).alias("z_outliers")
    parts = [
        long.join(known, by).groupBy(*by).agg(F.max("value_count").alias("value_count"), test)
        for long in values.values()
    ]
    return reduce(DataFrame.unionByName, parts)


def _scanned(table: str, df: DataFrame, columns: Sequence[str], policy: StrictPolicy) -> tuple[list[tuple], list[DataFrame]]:
    """One row of statistics per column, and the staged counts and furthest values of the table."""
    known, limits = [], {}
    for column, p in quantiles(df, columns, QUARTILES).items():
        q1, q3 = p.quantiles
        known.append((table, column, p.count, p.mean, p.deviation, q1, q3))
        if p.count:
            fence, spread = policy.iqr_multiplier * (q3 - q1), q3 > q1
            limits[column] = Limits(p.mean, p.deviation, policy.value_z, q1 - fence if spread else None, q3 + fence if spread else None)
    found = [stage(unusual(df, limits, SHOWN), "unusual").withColumn("table_name", F.lit(table))] if limits else []
    return known, found


def value_profiles(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]], policy: StrictPolicy = StrictPolicy()
) -> DataFrame:
    """One row per value column about its values: {table name: (table, columns)} in.

    value_count, mean, deviation, exact quartiles, how many values are z-score outliers, outside
    the IQR fences, zero or negative, and the ``SHOWN`` furthest outliers of either kind
    (``<kind>_top``). Nulls and NaN are no values. Quartiles are selected in place, and one more
    scan counts the tests and keeps the furthest values; no value is shuffled beyond those.
    """
    spark = next(iter(sources.values()))[0].sparkSession
    scans = {table: lambda table=table: _scanned(table, *sources[table], policy) for table in sources}
    parts, known = [], []
    for result in run_jobs(spark, scans):  # tables side by side: each is a few scans, one after the other
        if result.failure is not None:
            raise result.failure
        rows, unusual_values = result.value
        known += rows
        parts += unusual_values
    # one row per value column of the configuration
    listed = spark.createDataFrame(
        known, "table_name string, column_name string, value_count bigint, mean double, deviation double, q1 double, q3 double"
    )
    tests = _value_tests(policy)
    if not parts:
        none = {name: F.lit(0).cast("bigint") for name in tests} | {f"{name}_top": F.array().cast("array<double>") for name in OUTLIERS}
        return listed.withColumns(none)
    of = lambda name, column: F.max(F.when(F.col("test") == name, F.col(column)))
    found = reduce(DataFrame.unionByName, parts).groupBy("table_name", "column_name").agg(
        *[F.coalesce(of(name, "n"), F.lit(0)).alias(name) for name in tests],
        *[of(name, "top").alias(f"{name}_top") for name in OUTLIERS],
    )
    return listed.join(found, ["table_name", "column_name"], "left").fillna({name: 0 for name in tests})
