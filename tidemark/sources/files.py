"""CSV sources and path-addressed tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.schemas import PLATFORM_DDL

# ---- Fixed values: dialect of the source files -------------------------------------------
CSV_DIALECT = {"header": "true", "encoding": "UTF-8", "escape": '"', "nullValue": ""}
# ---- Fixed values: how files are packed. A packed CSV file is read by one task, so it has few rows.
CSV_PACKING = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}
#: Row hashes are hexadecimal text, which snappy leaves at one byte a digit.
PARQUET_CODEC = "zstd"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multiline: bool = True,
    infer: bool = False,
    same_header: bool = False,
) -> DataFrame:
    """A CSV file: with a declared schema (by position), inferred, or as text by header name.

    A file with quoted line breaks cannot be split over tasks; pass ``multiline=False`` for
    tables without free text. With ``same_header`` a file whose header differs from the schema
    ends the job; otherwise its values would be taken by position.
    """
    reader = spark.read.options(**CSV_DIALECT).option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", str(not same_header).lower())
    elif infer:
        reader = reader.option("inferSchema", "true")
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise FileNotFoundError(f"source file not found: {path}") from error
        raise


def write_csv(df: DataFrame, path: str) -> None:
    """Write packed files in the same dialect, keeping surrounding spaces."""
    options = CSV_DIALECT | CSV_PACKING | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**options).csv(path)


@dataclass(frozen=True)
class TableStore:
    """Tables at ``<root>/<layer>/<name>``, in any file format Spark can write.

    Bronze tables keep every load in its own ``load_id=`` folder; the audit log says which
    loads make up a version. Other layers are plain overwrite or append tables.
    """

    spark: SparkSession
    root: str
    table_format: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        reader = self.spark.read.format(self.table_format)
        if self.table_format == "parquet" and name in PLATFORM_DDL:
            reader = reader.schema(StructType.fromDDL(PLATFORM_DDL[name]))
        return reader.load(self.path(layer, name))

    def _writer(self, df: DataFrame, table_format: str | None = None) -> DataFrameWriter:
        kind = table_format or self.table_format
        writer = df.write.format(kind)
        return writer.option("compression", PARQUET_CODEC) if kind == "parquet" else writer

    def overwrite(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace a table. Files are complete before they take the old ones' place."""
        path = self.path(layer, name)
        if self.table_format == "delta":
            df.write.format("delta").mode("overwrite").option("overwriteSchema", "true").save(path)
            return
        fresh = self._fresh(path)
        self._writer(df).save(fresh)
        self._publish(fresh, path)

    def _fresh(self, path: str) -> str:
        return f"{path}__{uuid.uuid4().hex}"

    def _publish(self, fresh: str, path: str) -> None:
        """Rename a finished folder to ``path``; what was there goes after that."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        files = hadoop(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = hadoop(f"{fresh}_old")
        files.mkdirs(hadoop(path).getParent())
        replaced = files.exists(hadoop(path)) and files.rename(hadoop(path), old)
        if not files.rename(hadoop(fresh), hadoop(path)):
            if replaced:
                files.rename(old, hadoop(path))
            raise OSError(f"cannot rename {fresh} to {path}")
        if replaced:
            files.delete(old, True)

    def replace_rows(self, df: DataFrame, layer: str, name: str, *key: str) -> None:
        """Put the rows of ``df`` in place of all rows with its values of ``key``, in one commit.

        The table lies in a folder per key, so nothing of it is read and other keys are not touched;
        two runs with different keys can write at the same time.
        """
        self._writer(df.coalesce(1)).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *key
        ).save(self.path(layer, name))

    def remove_rows(self, layer: str, name: str, **key: str) -> None:
        """Remove the folder of one key of a table that ``replace_rows`` writes."""
        part = "/".join(f"{column}={value}" for column, value in key.items())
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(layer, name)}/{part}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write_split(self, df: DataFrame, by: str, kept: str, layer: str, rest_layer: str, name: str) -> None:
        """One write of ``df`` into two tables: rows whose ``by`` is ``kept``, and all others.

        ``by`` names folders: the kept rows' table lacks it, the other table has it. Both are
        published after the write.
        """
        fresh = self._fresh(self.path(rest_layer, name))
        self._writer(df, "parquet").partitionBy(by).save(fresh)
        part = f"{fresh}/{by}={kept}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        files = hadoop(part).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if files.exists(hadoop(part)):
            self._publish(part, self.path(layer, name))
        else:  # no row is kept: an empty table
            self.overwrite(df.drop(by).limit(0), layer, name)
        if files.globStatus(hadoop(f"{fresh}/{by}=*")):
            self._publish(fresh, self.path(rest_layer, name))
        else:
            files.delete(hadoop(fresh), True)
            self.overwrite(df.limit(0), rest_layer, name)

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        writer = self._writer(df).mode("append")
        if self.table_format == "delta":
            writer = writer.option("mergeSchema", "true")
        writer.save(self.path(layer, name))

    def append_new(self, df: DataFrame, layer: str, name: str, *key: str) -> None:
        """Append the rows whose key the table does not hold yet, so a repeated run adds nothing."""
        if self.exists(layer, name):
            df = df.join(self.read(layer, name).select(*key), list(key), "left_anti").select(*df.columns)
        self.append(df.coalesce(1), layer, name)

    def exists(self, layer: str, name: str) -> bool:
        try:
            self.read(layer, name)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in (error.getCondition() or ""):
                return False
            raise
        return True

    def write_load(self, df: DataFrame, name: str, load_id: str) -> None:
        """Write one load; it stays invisible until the audit log lists it."""
        self._writer(df).mode("overwrite").save(f"{self.path('bronze', name)}/load_id={load_id}")

    def read_loads(self, name: str, load_ids: list[str]) -> DataFrame:
        """Exactly these loads of a bronze table, without the folder column."""
        if not load_ids:
            raise FileNotFoundError(f"no readable load of {name}")
        reader = self.spark.read.format(self.table_format)
        if self.table_format == "parquet":
            reader = reader.option("mergeSchema", "true")
        return reader.load([f"{self.path('bronze', name)}/load_id={load_id}" for load_id in load_ids])

    def register(self, layer: str, names: list[str]) -> None:
        """Temporary SQL views named like the tables."""
        for name in names:
            self.read(layer, name).createOrReplaceTempView(name)


def preview(df: DataFrame, rows: int = 3, order: Sequence[str] = ()) -> DataFrame:
    """Some rows for a quick look; the first ones by ``order`` if columns are named."""
    return (df.orderBy(*order) if order else df).limit(rows)


def table_shape(df: DataFrame, table: str) -> DataFrame:
    """One row: row count, number of columns and the load metadata columns."""
    metadata = [name for name in df.columns if name.startswith("_")]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(metadata)).alias("metadata_columns"),
    )
