"""Source files to bronze tables: one write job and one audit row per table."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LOADED_AT, METADATA_COLUMNS, ROW_HASH, SOURCE_FILE, TABLES, VERSION, RunContext, TableSpec
from tidemark.functions.clean import row_hash, row_hash_strict
from tidemark.jobs import run_jobs
from tidemark.operators import drift
from tidemark.plans import audit
from tidemark.sources.files import TableStore, read_csv
from tidemark.sources.schemas import SOURCE_DDL, source_schema

log = logging.getLogger(__name__)
AUDIT_TABLE = "bronze_ingestion_audit"
#: Two commits to one folder of files would remove each other's unfinished files.
_ONE_COMMIT = threading.Lock()


class CriticalColumnsMissing(ValueError):
    """The source lacks columns without which a table is not loaded."""


def with_load_metadata(
    df: DataFrame, source_file: str, loaded_at: str, version: str = "1.0.0", strict_hash: bool = False
) -> DataFrame:
    """Add load time, file name, pipeline version and row hash. Only source columns are hashed."""
    columns = [name for name in df.columns if name not in METADATA_COLUMNS]
    hashed = row_hash_strict(columns) if strict_hash else row_hash(columns)
    return df.withColumns(
        {
            LOADED_AT: F.lit(loaded_at).cast("timestamp"),
            SOURCE_FILE: F.lit(source_file),
            VERSION: F.lit(version),
            ROW_HASH: hashed,
        }
    )


def read_source(spark: SparkSession, spec: TableSpec, path: str) -> tuple[DataFrame, drift.Drift]:
    """A source file as text by header name, and its drift from the declared columns.

    With a declared schema Spark would map columns by position, so a renamed or moved column
    would pass unseen; names are therefore taken from the header. A table without a declared
    schema gets inferred types.
    """
    if spec.name not in SOURCE_DDL:
        inferred = read_csv(spark, path, multiline=spec.multiline, infer=True)
        missing = tuple(name for name in spec.critical if name not in inferred.columns)
        return inferred, drift.Drift(spec.bronze, missing_columns=missing, critical_missing=missing)
    text = read_csv(spark, path, multiline=spec.multiline)
    if len(text.inputFiles()) > 1:  # names come from one file; the others must have the same header
        text = read_csv(spark, path, text.schema, multiline=spec.multiline, same_header=True)
    return text, drift.header_drift(text, source_schema(spec.name), spec.bronze, spec.critical)


def load_table(
    store: TableStore,
    spec: TableSpec,
    source_path: str,
    ctx: RunContext,
    write_mode: str = "overwrite",
    load_id: str | None = None,
) -> str:
    """Load one source file. Returns SUCCESS, PARTIAL or FAILED; the audit log has the details.

    Rows and unreadable values are counted while writing, so the data is read once. The job is
    one stage from file to table, so a task that runs again counts once.
    """
    spark, load_id = store.spark, load_id or uuid.uuid4().hex
    source_file = source_path.rstrip("/").rsplit("/", 1)[-1]
    rows = report = error = None
    try:
        text, found = read_source(spark, spec, source_path)
        if found.critical_missing:
            raise CriticalColumnsMissing(f"critical columns missing: {', '.join(found.critical_missing)}")
        # Inferred columns are what they are declared to be.
        expected = source_schema(spec.name) if spec.name in SOURCE_DDL else text.schema
        counts = Observation()
        observed = text.observe(
            counts,
            F.count(F.lit(1)).alias("rows"),
            *[count.alias(f"bad_{name}") for name, count in drift.damage_counts(text, expected).items()],
        )
        loaded = with_load_metadata(drift.conform(observed, expected), source_file, ctx.as_of, ctx.pipeline_version)
        store.write_load(loaded, spec.bronze, load_id)
        seen = counts.get
        rows = seen["rows"]
        bad = [f"{name[4:]}: {count} unreadable values" for name, count in sorted(seen.items()) if name != "rows" and count]
        found = drift.Drift(
            found.table, found.missing_columns, found.extra_columns, tuple(bad), found.critical_missing
        )
        if found.has_drift:
            log.warning(found.summary())
            report = spark.range(1).select(found.json().alias("report")).first()["report"]
        status = "PARTIAL" if rows < spec.min_rows else "SUCCESS"
    except Exception as failure:  # a failed load is an audit row; the other tables still load
        status, rows, error = "FAILED", None, str(failure)
        log.error("%s: %s", spec.bronze, failure)
    try:
        row = audit.audit_row(
            spark, ctx, spec, status, load_id, write_mode, source_file, rows, report, error
        )
        with _ONE_COMMIT:
            store.append(row.coalesce(1), "audit", AUDIT_TABLE)
    except Exception as failure:  # the log must not turn a good load into a failed one
        log.critical("audit row for %s not written: %s", spec.bronze, failure)
    return status


def load_all(
    store: TableStore,
    source_folder: str,
    ctx: RunContext,
    write_mode: str = "overwrite",
    tables: Iterable[str] = TABLES,
) -> dict[str, str]:
    """Load every table, going on past failures. Returns the status per bronze table.

    Tables are loaded side by side, so the last tasks of one do not hold up the others.
    """
    loads = {
        TABLES[table].bronze: lambda spec=TABLES[table]: load_table(
            store, spec, f"{source_folder}/{spec.source_file()}", ctx, write_mode
        )
        for table in tables
    }
    statuses = {}
    for load in run_jobs(store.spark, loads):
        if load.failure is not None:
            raise load.failure
        statuses[load.name] = load.value
    return statuses


def read_audit(store: TableStore) -> DataFrame:
    return store.read("audit", AUDIT_TABLE)


def read_bronze(store: TableStore, table: str, version: int | None = None) -> DataFrame:
    """A bronze table as of its newest or an earlier version."""
    name = TABLES[table].bronze
    # One id per load of this table: a short list, never data.
    ids = [row["load_id"] for row in audit.version_loads(read_audit(store), name, version).select("load_id").collect()]
    return store.read_loads(name, ids)


def restore(store: TableStore, table: str, version: int, ctx: RunContext) -> str:
    """Make an earlier version current again by writing it as a new load."""
    spec, load_id = TABLES[table], uuid.uuid4().hex
    counts = Observation()
    earlier = read_bronze(store, table, version).observe(counts, F.count(F.lit(1)).alias("rows"))
    store.write_load(earlier, spec.bronze, load_id)
    rows = counts.get["rows"]
    row = audit.audit_row(
        store.spark, ctx, spec, "PARTIAL" if rows < spec.min_rows else "SUCCESS", load_id, "overwrite",
        f"version {version}", rows,
    )
    store.append(row.coalesce(1), "audit", AUDIT_TABLE)
    return load_id
