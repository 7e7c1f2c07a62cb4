"""A bounded top-n aggregate: the values furthest out, kept while they are counted.

Every task keeps the ``n`` furthest values of each (column, test) beside its counts and sends just
those; partial results are cut to ``n`` again while they meet. One scan, no sort of the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.selection import number

PART_DDL = "column_name string, test string, n bigint, value double, distance double"


@dataclass(frozen=True)
class Limits:
    """What is unusual in one column: beyond ``z`` deviations of the mean, outside [low, high]."""

    mean: float
    deviation: float | None
    z: float
    low: float | None
    high: float | None

    def distances(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Per test how far out each value lies; values that are not unusual have NaN."""
        found = {}
        usual = np.full(len(x), np.nan)
        away = np.abs(x - self.mean)
        found["z_outliers"] = np.where(away / self.deviation > self.z, away, np.nan) if self.deviation else usual
        outside = usual if self.low is None else np.where((x > self.high) | (x < self.low), np.maximum(x - self.high, self.low - x), np.nan)
        found["iqr_outliers"] = outside
        found["zero_values"] = np.where(x == 0, 0.0, np.nan)
        found["negative_values"] = np.where(x < 0, -x, np.nan)
        return found


class Furthest:
    """Counts and the ``n`` furthest values: largest distance first, then the smaller value."""

    def __init__(self, n: int) -> None:
        self.n, self.count = n, 0
        self.value, self.distance = np.zeros(0), np.zeros(0)

    def add(self, x: np.ndarray, distance: np.ndarray) -> None:
        hit = ~np.isnan(distance)
        self.count += int(hit.sum())
        value, distance = np.concatenate([self.value, x[hit]]), np.concatenate([self.distance, distance[hit]])
        if len(value) > 64 * self.n:  # most fall away without a sort
            least = np.partition(distance, -self.n)[-self.n]
            value, distance = value[distance >= least], distance[distance >= least]
        order = np.lexsort((value, -distance))[: self.n]
        self.value, self.distance = value[order], distance[order]


def unusual(df: DataFrame, limits: Mapping[str, Limits], n: int) -> DataFrame:
    """(column_name, test, n, top): how many values fail each test and the ``n`` furthest of them."""
    columns = list(limits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[str, str], Furthest] = {}
        for batch in batches:
            for at, column in enumerate(columns):
                x = batch.column(at).drop_null().to_numpy(zero_copy_only=False)
                for test, distance in limits[column].distances(x).items():
                    kept.setdefault((column, test), Furthest(n)).add(x, distance)
        rows = [
            (column, test, k.count if i == 0 else 0, value, distance)
            for (column, test), k in kept.items()
            for i, (value, distance) in enumerate(zip(k.value.tolist(), k.distance.tolist()))
        ]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["column_name", "test", "n", "value", "distance"]
        )

    parts = df.select(*[number(c).alias(c) for c in columns]).mapInArrow(scan, PART_DDL)
    by = ["column_name", "test"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("distance"), "value"))
    # counts ride on each task's first row; the place limit is applied inside the tasks too
    counts = parts.groupBy(*by).agg(F.sum("n").alias("n"))
    top = (
        parts.withColumn("place", place).where(F.col("place") <= n).groupBy(*by)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("top"))
    )
    return counts.join(top, by, "left")
