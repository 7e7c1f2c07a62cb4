"""Silver facts in buckets by order, so that the KPIs join and group them without a shuffle.

A fact table is shuffled by ``order_id`` once, when it is written; every KPI that joins orders,
items, payments and reviews by order then reads matching buckets side by side. Items are also
kept with their product category, because joining products would deal them anew by product.

Buckets are files of the catalog's tables: ``bucketBy`` with the rows of a bucket sorted, one file
each, since rows are dealt by the same hash before the write. Spark reads buckets as partitions of
the join only if both tables have the same number of them. One order's rows lie in one bucket and
are reduced there, so an order with very many rows costs the scan of its bucket, not a shuffle.

``GoldFacts`` serves one run of all KPIs. It keeps only the columns they read and deals no rows before
the write: every task writes a file per bucket. Columns packed in files take a quarter of what rows
take in a shuffle, and the tables that several KPIs join are written once.
"""

from __future__ import annotations

import math
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import gold
from tidemark.session import scratch_path
from tidemark.sources.files import PARQUET_CODEC

KEY = "order_id"
FACTS = ("orders", "order_items", "order_payments", "order_reviews", gold.CATEGORISED)
# ---- Fixed values: rows of a bucket in large tables, and the fewest worth a task of their own
BUCKET_ROWS, LEAST_ROWS = 1_000_000, 250_000


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = KEY, deal: bool = True) -> DataFrame:
    """Write ``df`` as the catalog table ``name`` in sorted buckets by ``key`` and read it back.

    An earlier table of that name is replaced only after the new files are complete. Without ``deal``
    rows are not shuffled before the write: a bucket has a file per task that holds rows of it, and
    as order inside such files is no order of the bucket, they are not sorted.
    """
    spark = df.sparkSession
    fresh = f"{name}_next"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    writer = (df.repartition(buckets, key) if deal else df).write.format("parquet").option("path", path)
    writer = writer.option("compression", PARQUET_CODEC).bucketBy(buckets, key)
    (writer.sortBy(key) if deal else writer).saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    return spark.table(name)


class BucketedSilver(Mapping[str, DataFrame]):
    """Silver tables whose facts are written in buckets on first use; other tables pass through."""

    bucketed_by = KEY

    def __init__(self, spark: SparkSession, silver: gold.Silver, prefix: str, buckets: int, root: str | None = None) -> None:
        self._spark, self._silver, self._prefix, self._buckets = spark, silver, prefix, buckets
        self._root = root or scratch_path(spark, "bucketed")
        self._written: dict[str, DataFrame] = {}

    def _fact(self, table: str) -> DataFrame:
        if table == gold.CATEGORISED:
            return gold.items_with_category(self._silver["order_items"], self._silver["products"])
        return self._silver[table]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in FACTS:
            return self._silver[table]
        if table not in self._written:
            name = f"{self._prefix}_{table}"
            self._written[table] = write_bucketed(self._fact(table), name, f"{self._root}/{table}", self._buckets)
        return self._written[table]

    def __iter__(self) -> Iterator[str]:
        return iter((*self._silver, gold.CATEGORISED))

    def __len__(self) -> int:
        return len(self._silver) + 1


class GoldFacts(Mapping[str, DataFrame]):
    """Silver tables for one run of the KPIs: facts in buckets by order, written on first use, once for all.

    KPIs may ask side by side: the first one writes a fact, the others wait for it. A fact that cannot
    be written fails the KPIs that read it. Leaving the context drops what was written.
    """

    bucketed_by = KEY

    def __init__(self, spark: SparkSession, silver: gold.Silver) -> None:
        self._spark, self._silver = spark, silver
        self._prefix, self._root = f"facts_{uuid.uuid4().hex}", scratch_path(spark, "facts")
        self._locks = {name: threading.Lock() for name in ("", *FACTS)}
        self._buckets: int | None = None
        self._written: dict[str, DataFrame] = {}

    def _fact(self, table: str) -> DataFrame:
        if table != gold.CATEGORISED:
            return self._narrow(self._silver[table], table)
        products = self._narrow(self._silver["products"], "products")
        return gold.items_with_category(self._narrow(self._silver["order_items"], table), products)

    @staticmethod
    def _narrow(df: DataFrame, table: str) -> DataFrame:
        # a KPI that needs a column which is not there fails by itself
        return df.select(*[name for name in gold.READ_COLUMNS[table] if name in df.columns])

    def buckets(self) -> int:
        """Enough buckets for the largest fact; all facts have the same number."""
        with self._locks[""]:
            if self._buckets is None:
                rows = 0
                for table in FACTS:
                    if table != gold.CATEGORISED:  # about as many rows as items
                        with suppress(Exception):  # the KPIs that read this table report it
                            rows = max(rows, self._silver[table].count())
                least = min(self._spark.sparkContext.defaultParallelism, math.ceil(rows / LEAST_ROWS))
                self._buckets = max(1, least, math.ceil(rows / BUCKET_ROWS))
            return self._buckets

    def __getitem__(self, table: str) -> DataFrame:
        if table not in FACTS:
            return self._silver[table]
        with self._locks[table]:
            if table not in self._written:
                # another attempt takes another name and folder
                name = f"{self._prefix}_{table}_{uuid.uuid4().hex[:8]}"
                self._written[table] = write_bucketed(self._fact(table), name, f"{self._root}/{name}", self.buckets(), deal=False)
            return self._written[table]

    def __iter__(self) -> Iterator[str]:
        return iter((*self._silver, gold.CATEGORISED))

    def __len__(self) -> int:
        return len(self._silver) + 1

    def __enter__(self) -> GoldFacts:
        return self

    def __exit__(self, *failure: object) -> None:
        for table in self._spark.catalog.listTables(pattern=f"{self._prefix}*"):
            self._spark.sql(f"DROP TABLE IF EXISTS {table.name}")
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._root)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
